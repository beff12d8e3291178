"""The corpus pipeline stage by stage against plain Python, and the registered queries against their SQL twins."""

import os

import duckdb
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

import corpus_pipeline as CP
from riskline.llm.queries import QUERIES, TWINS

from .fixtures import awkward, empty, table
from .test_near import expected as near_expected
from .test_suffix import expected as suffix_expected
from .test_tokens import check_packing

DOCS = ("doc_id", "text", "lang", "source", "n_chars")


def stage(name):
    return dict(CP.STAGES)[name]


def rows_of(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def test_repeats_are_cut_by_one_python_process_a_task(spark):
    """A column function after the cut would hold a second Python worker per core, as large as the first."""
    tail = "é" * 30  # 60 bytes: the second text keeps a first byte of its own, a whole é and no half of one
    rows = [(1, "a" + tail), (2, "b" + tail), (3, "c" * 9 + tail[:24] + "è" * 5), (None, "b" + tail)]
    made = CP.cut_repeats(spark, table(spark, rows), "")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "EvalPython" not in plan
    assert rows_of(made) == sorted(((d, b.decode(errors="ignore")) for d, _, _, _, b in suffix_expected(rows)), key=str)


def test_stages_one_by_one(spark):
    rows = awkward() + [(901, "42 + 1 = 43!"), (902, "...")]
    docs = table(spark, rows)
    named = docs.withColumnRenamed("n", "müßig name")  # carried through all stages

    first = stage("language")(spark, named, None)
    assert first.columns == named.columns
    left = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    assert rows_of(first) == sorted(left, key=str)

    second = stage("exact_dedup")(spark, first, None)
    assert second.columns == named.columns
    import re

    norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t)
    best = {}
    for d, t in left:
        if d is not None:
            best[norm(t)] = min(d, best.get(norm(t), d))
    kept = sorted({(d, t) for d, t in left if d is not None and best[norm(t)] == d} | {(d, t) for d, t in left if d is None}, key=str)
    assert rows_of(second) == kept

    third = stage("near_dedup")(spark, second, None)
    stays = {d for d, _, _, k in near_expected(kept) if k}
    assert rows_of(third) == [(d, t) for d, t in kept if d in stays or d is None]
    assert third.columns == named.columns

    fourth = stage("repeated_passages")(spark, third, None)
    assert fourth.columns == named.columns
    cut = rows_of(fourth)
    want = sorted(((d, b.decode("utf-8", errors="ignore")) for d, _, _, _, b in suffix_expected(rows_of(third))), key=str)
    assert cut == want
    assert all(r["n_chars"] == len(r["text"]) and r["müßig name"] == "d" for r in fourth.collect())

    used, least = check_packing(cut, stage("packing")(spark, fourth, None).collect(), 2048)
    assert used <= least * 1.01 + 1


@pytest.mark.parametrize("langs", ["cast(null as string)", "'und'", "if(doc_id % 2 = 0, 'und', lang)"])
def test_language_stage_keeps_every_text_with_a_letter(spark, langs):
    rows = awkward() + [(901, "42 + 1 = 43!"), (902, "...")]
    docs = table(spark, rows)
    got = stage("language")(spark, docs.withColumn("lang", F.expr(langs)), None)
    assert got.columns == docs.columns
    assert rows_of(got) == sorted(((d, t) for d, t in rows if t and any(c.isalpha() for c in t)), key=str)


def test_exact_stage_decides_by_row(spark):
    rows = [(5, "text A"), (3, "text B"), (5, "text  B"), (7, "text C"), (7, "text C")]
    docs = table(spark, rows).withColumn("source", F.expr("if(lang = 'en', 's9', source)"))  # the rows of 7 differ
    got = stage("exact_dedup")(spark, docs, None)
    assert got.columns == docs.columns and rows_of(got) == [(3, "text B"), (5, "text A"), (7, "text C")]
    assert [(r["lang"], r["source"]) for r in got.where("doc_id = 7").collect()] == [("en", "s9")]
    swapped = docs.orderBy(F.desc("lang"))
    assert sorted(map(str, got.collect())) == sorted(map(str, stage("exact_dedup")(spark, swapped, None).collect()))


def test_empty_table(spark):
    docs = empty(spark)
    for _, f in CP.STAGES[:-1]:
        docs = f(spark, docs, None)
        assert docs.columns == empty(spark).columns and docs.count() == 0
    assert CP.STAGES[-1][1](spark, docs, None).count() == 0


def test_run(spark, small_dir):
    got = CP.run(spark, small_dir)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < got.select("doc_id").distinct().count() <= spark.read.parquet(f"{small_dir}/documents.parquet").count()
    assert os.path.exists(path("byte_bpe_50k.json"))


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_sql(spark, small_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small_dir}/{t}.parquet'")
    frame = QUERIES[name](spark, small_dir)
    want = con.sql(TWINS[name])
    columns = sorted(frame.columns)
    assert columns == sorted(want.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)
    assert got == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({TWINS[name]})").fetchall(), key=str)


@pytest.mark.parametrize("name", ["op2_bpe", "op5_suffix_dedup", "op4_minhash_dedup", "op9_packing", "op1_url_filter"])
def test_query_columns(spark, small_dir, name):
    want = {
        "op1_url_filter": ["page_id", "host", "path", "rule", "verdict"],
        "op2_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op4_minhash_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
        "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op9_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    }[name]
    frame = QUERIES[name](spark, small_dir)
    assert frame.columns[: len(want)] == want and frame.count() > 0


def test_rows_without_an_id_all_stay(spark):
    rows = [(None, "same text", "p"), (None, "same text", "q"), (None, "same text", "q"), (None, "a b c", "p"), (1, "a b c", "p"), (2, "a  b c", "p"), (1, "a b c", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    exact = stage("exact_dedup")(spark, docs, None)
    want = sorted([(None, "same text", "p"), (None, "same text", "q"), (None, "same text", "q"), (None, "a b c", "p"), (1, "a b c", "p")], key=str)
    assert exact.columns == docs.columns and sorted(map(tuple, exact.collect()), key=str) == want
    near = stage("near_dedup")(spark, exact, None)
    assert sorted(map(tuple, near.collect()), key=str) == want
    cut = stage("repeated_passages")(spark, near, None)
    assert sorted(map(tuple, cut.collect()), key=str) == want


def test_language_stage_keeps_the_named_languages(spark):
    docs = table(spark, awkward() + [(902, "...")])
    kept = stage("language")(spark, docs, None)
    none, every = (CP.detect_language(spark, docs, None, languages=x) for x in (("xx",), ("en", "fr", "und")))
    assert none.count() == 0 and rows_of(every) == rows_of(kept)
    one, other = (CP.detect_language(spark, docs, None, languages=(x,)) for x in ("en", "fr"))
    assert one.count() + other.count() == kept.count()
