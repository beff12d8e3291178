import random

import pytest

from helpers import at, brute_features, frame, tx
from riskline import constants as C
from riskline.operators.features import history_for, online_features


def run(spark, rows, **kw):
    out = online_features(frame(spark, rows), **kw).collect()
    return {r["transaction_id"]: r for r in out}


def test_future_row_ignored_and_velocity(spark):
    rows = [tx("t1", at(-2)), tx("t2", at(0), merchant="m2", device="d2"), tx("t3", at(5))]
    f = run(spark, rows)["t2"]
    assert f["transactions_last_5m"] == 1.0
    assert f["user_average_amount"] == 100.0
    assert f["new_merchant"] == 1.0 and f["new_device"] == 1.0


def test_first_row_is_not_novel(spark):
    f = run(spark, [tx("t1", at(0))])["t1"]
    assert f["new_merchant"] == f["new_country"] == f["new_device"] == f["ip_changed"] == 0.0
    assert f["user_average_amount"] == 100.0 and f["user_median_amount"] == 100.0


def test_window_edges(spark):
    rows = [
        tx("edge5", at(-5)),            # exactly t - 5 min: inside
        tx("old5", at(-5, micro=-1)),   # one microsecond older: outside 5 min
        tx("same", at(0), amount=7.0),  # equal timestamp: never history
        tx("t", at(0)),
        tx("edge30", at(days=-30)),     # exactly t - 30 d: inside
        tx("old30", at(days=-30, micro=-1)),
    ]
    f = run(spark, rows)["t"]
    assert f["transactions_last_5m"] == 1.0
    assert f["transactions_last_1h"] == 2.0
    assert f["user_average_amount"] == 100.0  # 'same' (7.0) excluded, 'edge30' included, 'old30' not
    r = run(spark, rows)
    assert r["edge5"]["transactions_last_24h"] == 1.0  # old5 one microsecond earlier


def test_latest_prior_without_coordinates_gives_zero_speed(spark):
    rows = [tx("a", at(-10), lat=None, lon=None), tx("b", at(0), lat=35.6762, lon=139.6503)]
    assert run(spark, rows)["b"]["travel_speed_kmh"] == 0.0


def test_impossible_travel_and_tie_break(spark):
    rows = [tx("a1", at(-10)), tx("a2", at(-10), ip="192.0.2.9"),
            tx("b", at(0), lat=35.6762, lon=139.6503, device="d9")]
    f = run(spark, rows)["b"]
    assert f["impossible_travel"] == 1.0 and f["travel_speed_kmh"] > 900
    assert f["ip_changed"] == 1.0  # equal times: latest prior row is a2 (greater id), whose ip differs
    rows2 = [tx("a1", at(-10), ip="192.0.2.9"), tx("a2", at(-10)), tx("b", at(0))]
    assert run(spark, rows2)["b"]["ip_changed"] == 0.0


def test_burst_rows(spark):
    rows = [tx(f"p{i}", at(-4, seconds=i)) for i in range(8)] + [tx("t", at(0))]
    assert run(spark, rows)["t"]["transactions_last_5m"] == 8.0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force_random_histories(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(160):
        user = f"u{rnd.randint(1, 4)}"
        when = at(minutes=rnd.randint(0, 60 * 24 * 45) * rnd.choice([1, 1, 1, 0]) + rnd.randint(0, 3))
        geo = rnd.choice([(40.7128, -74.0060), (51.5072, -0.1276), (None, None)])
        rows.append(tx(f"t{i:03d}", when, amount=round(rnd.uniform(1, 500), 2), user=user,
                       merchant=f"m{rnd.randint(1, 6)}", country=rnd.choice(["US", "GB", "TR"]),
                       device=f"d{rnd.randint(1, 3)}", ip=f"192.0.2.{rnd.randint(1, 3)}", lat=geo[0], lon=geo[1]))
    expected = brute_features(rows)
    got = run(spark, rows, bucket_days=31)  # small buckets: many halo copies, same answer
    for tid, exp in expected.items():
        for k, v in exp.items():
            assert got[tid][k] == pytest.approx(v, rel=1e-9, abs=1e-9), (tid, k)


def test_history_for_matches_window_definition(spark):
    rows = [tx("a", at(-10)), tx("b", at(days=-31)), tx("c", at(0)), tx("d", at(5))]
    df = frame(spark, rows)
    hist = history_for(df.where("transaction_id = 'c'"), df).collect()
    assert sorted(r["transaction_id"] for r in hist) == ["a"]


def rows_by_task(df):
    from pyspark.sql import functions as F

    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


@pytest.mark.parametrize("scan", ["online", "offline"])
def test_rows_of_a_task_do_not_grow_with_the_table(spark, scan, monkeypatch):
    """Adaptive execution does not join partitions again, however few bytes they were shuffled in."""
    from riskline.operators import segments
    from riskline.operators.features import offline_features

    monkeypatch.setattr(segments, "TASK_ROWS", 100)
    rows = [tx(f"t{i:04d}", at(i % 50), user=f"u{i % 997:03d}") for i in range(4000)]
    find = {"online": online_features, "offline": offline_features}[scan]
    sizes = rows_by_task(find(frame(spark, rows)).select("transaction_id", "user_median_amount"))
    assert sum(sizes) == len(rows) and len(sizes) >= 30 and max(sizes) <= 250


def test_distinct_counts_without_rows_of_their_own(spark):
    from riskline.plans.catalog import transactions

    rows = [tx("a", at(0), user=None, merchant="m1"), tx("b", at(1), user=None, merchant="m2"),
            tx("c", at(2), user=None, merchant="m1"), tx("d", at(60 * 24), user=None, merchant=None),
            tx("e", at(60 * 24 + 1), user="u", merchant="m3"), tx("f", at(60 * 24 + 2), user="u", merchant="m3")]
    got = run(spark, rows)
    assert [got[t]["unique_merchants_last_24h"] for t in "abcdef"] == [0.0, 1.0, 2.0, 2.0, 0.0, 1.0]
    assert [got[t]["transactions_last_24h"] for t in "abcdef"] == [0.0, 1.0, 2.0, 3.0, 0.0, 1.0]
    plan = online_features(transactions(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1  # the history copies alone


@pytest.mark.parametrize("source", ["events", "orders"])
def test_source_rows_of_a_task_are_bounded(spark, source, monkeypatch, tmp_path):
    """One row group is one task of the scan, whatever it holds; the rows stay, null and repeated keys too."""
    from riskline.plans.catalog import transactions
    from riskline.sources import adapter

    key, user, amount, ts = {"events": ("event_id", "user_id", "value", "ts"),
                             "orders": ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")}[source]
    rows = [(None if i % 4 == 0 else i // 2, i % 7, float(i), at(i // 2)) for i in range(4000)]
    table = spark.createDataFrame(rows, f"{key} long, {user} long, {amount} double, {ts} timestamp").coalesce(1)
    table.write.parquet(f"{tmp_path}/{source}.parquet")
    whole = transactions(spark, str(tmp_path), source)
    assert rows_by_task(whole) == [4000]
    monkeypatch.setattr(adapter, "SOURCE_ROWS", 100)
    dealt = transactions(spark, str(tmp_path), source)
    sizes = rows_by_task(dealt)
    assert sum(sizes) == 4000 and max(sizes) <= 200
    assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect()))
