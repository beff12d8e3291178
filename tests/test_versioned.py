"""Merged tables: same rows as the log, whatever breaks off or is played again; few files."""

import pytest
from pyspark.sql import functions as F

from riskline.sources.versioned import VersionedTable


def rows(spark, values, bucket=None):
    df = spark.createDataFrame(values, "k string, v int, seq long").coalesce(1)
    return df if bucket is None else df.withColumn("b", F.pmod(F.col("v"), F.lit(bucket)))


def content(df):
    return sorted(tuple(r[c] for c in ("k", "v", "seq")) for r in df.collect())


def test_merging_keeps_all_rows_and_few_files(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ("b",))
    assert table.read() is None and table.compact(5).version == 0
    expected = []
    for n in range(60):
        part = [(f"k{n}", n, n), (f"x{n}", n + 1, n)]
        table.write(rows(spark, part, 2), n)
        expected += part
        if n % 15 == 14:
            before = content(table.read())
            state = table.compact(n - 1)
            table.clean()
            assert state.covered == n - 1 and content(table.read()) == before == sorted(expected)
    assert table.files() < 60  # 120 were written
    assert content(table.read(before=50)) == sorted(expected[:100])
    assert content(table.read().where("b = 1")) == sorted(r for r in expected if r[1] % 2)
    assert len(table.manifests()) == 2


def test_work_that_broke_off_changes_nothing(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(4):
        table.write(rows(spark, [(f"k{n}", n, n)]), n)
    want = content(table.read())

    def broken(state):
        raise OSError("the writer was lost")

    with monkeypatch.context() as m:
        m.setattr(table, "_publish", broken)
        with pytest.raises(OSError):
            table.compact(2)
    assert table.manifest().covered == -1 and content(table.read()) == want
    table.compact(2)
    assert content(table.read()) == want
    assert len(table._list("_base")) == 2
    table.clean()
    assert len(table._list("_base")) == 1 and content(table.read()) == want


def test_replay_and_second_writer(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(3):
        table.write(rows(spark, [(f"k{n}", n, n)]), n)
    table.write(rows(spark, [("k2", 2, 2)]), 2)  # played again before the merge
    want = content(table.read())
    state = table.compact(1)
    table.write(rows(spark, [("k1", 1, 1)]), 1)  # and after it
    assert content(table.read()) == want == [("k0", 0, 0), ("k1", 1, 1), ("k2", 2, 2)]
    with pytest.raises(RuntimeError):  # another writer published the same version
        table._publish(state)
    assert content(table.read(before=1)) == [("k0", 0, 0)]
    table.compact(2)
    table.clean()
    assert content(table.read()) == want


def test_upsert_log_becomes_its_current_table(spark, tmp_path):
    log = VersionedTable(spark, str(tmp_path / "labels"), key=("k",), order=("seq",))
    expected = {}
    for n in range(12):
        part = [(f"k{n % 5}", n, 100 - n if n % 4 == 0 else 100 + n), ("late", n, 50 - n)]
        log.write(rows(spark, part), n)
        for k, v, seq in part:
            if k not in expected or expected[k][1] <= seq:
                expected[k] = (v, seq)
        assert {k: (v, s) for k, v, s in content(log.read())} == expected
        if n % 3 == 2:
            log.compact(n)
            log.clean()
            assert {k: (v, s) for k, v, s in content(log.read())} == expected
    base = spark.read.parquet(f"{log.path}/{log.manifest().base}")
    assert base.count() == len(expected)
