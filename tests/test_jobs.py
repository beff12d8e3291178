"""Daily files, the retraining job with its registry, model info, stored replies, latency."""

import pytest
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators.readmodels import latency_p95
from riskline.plans.scoring import first_write_wins, replies
from riskline.plans.training import CandidateConfig, load_model, model_info, rank_candidates, retrain_job
from riskline.sources.tables import path_exists, read_daily, write_table


def test_daily_files(spark, tmp_path):
    """One file per day; days come from the names and filter the files."""
    for day, rows in (("2024-01-01", 3), ("2024-01-02", 5), ("2024-02-10", 7)):
        spark.range(rows).coalesce(1).write.parquet(str(tmp_path / f"tmp-{day}"))
        part = next((tmp_path / f"tmp-{day}").glob("part-*.parquet"))
        (tmp_path / "daily" / day[:7]).mkdir(parents=True, exist_ok=True)
        part.rename(tmp_path / "daily" / day[:7] / f"{day}.parquet")
    folder = str(tmp_path / "daily")
    got = {str(r["day"]): r["count"] for r in read_daily(spark, folder).groupBy("day").count().collect()}
    assert got == {"2024-01-01": 3, "2024-01-02": 5, "2024-02-10": 7}
    assert read_daily(spark, folder, "2024-01-02", "2024-01-31").count() == 5
    assert read_daily(spark, folder, first_day="2025-01-01").count() == 0


def test_write_table_replaces_only_its_partitions(spark, tmp_path):
    """S03."""
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("day", F.col("id") % 2)
    write_table(rows, path, ["day"])
    write_table(rows.where("day = 1").withColumn("id", F.col("id") + 100), path, ["day"])
    got = spark.read.parquet(path)
    assert got.where("day = 0").count() == 5 and got.where("day = 1").agg(F.min("id")).first()[0] == 101


def test_retraining_appends_versions(spark, small_dir, tmp_path):
    """The first version is the champion, the next one is held against it."""
    registry = str(tmp_path / "registry")
    cfg = CandidateConfig(lr_max_iter=5, include=("logistic_regression", "logistic_undersampled"))
    first = retrain_job(spark, small_dir, registry, cfg).first()
    second = retrain_job(spark, small_dir, registry, CandidateConfig(lr_max_iter=3, include=("logistic_regression",))).first()
    versions = spark.read.parquet(f"{registry}/model_versions").orderBy("created_at").collect()
    assert [(v["model_version"], v["status"]) for v in versions] == [
        (first["model_version"], "champion"), (second["model_version"], "challenger")]
    bundle = f"{registry}/{first['model_version']}"
    model = load_model(spark, bundle)
    assert model.version == first["model_version"] and 0 < model.review_threshold < model.block_threshold < 1
    info = model_info(spark, bundle).first()
    assert info["source"] == "bundle" and info["model_version"] == model.version and info["features"] == C.MODEL_FEATURES
    assert 0 < spark.read.parquet(f"{bundle}/reference_sample").count() <= 2000
    assert path_exists(spark, f"{bundle}/report")


def test_a_broken_bundle_is_an_error(spark, tmp_path):
    assert load_model(spark, str(tmp_path / "none")) is None
    spark.range(3).write.parquet(str(tmp_path / "bad" / "metadata"))
    with pytest.raises(Exception):  # noqa: B017
        load_model(spark, str(tmp_path / "bad"))


def test_model_info_without_a_bundle(spark):
    row = model_info(spark, None).first()
    assert (row["model_version"], row["source"]) == (C.BOOTSTRAP_VERSION, "bootstrap")


def test_candidates_are_ranked_by_cost_then_pr_auc(spark):
    cards = spark.createDataFrame([("a", 5.0, 0.9, 1.0), ("b", 4.0, 0.2, 1.0), ("c", 4.0, 0.3, 1.0)],
                                  "candidate string, expected_cost double, pr_auc double, recall double")
    assert [r["candidate"] for r in rank_candidates(cards).orderBy("place").collect()] == ["c", "b", "a"]


def test_replies_and_first_write(spark):
    """A replay is answered with what is stored."""
    stored = spark.createDataFrame([("t1", 1.0, 1)], "transaction_id string, amount double, source_seq long")
    incoming = spark.createDataFrame([("t1", 9.0, 7), ("t2", 2.0, 8), ("t2", 3.0, 9)], stored.schema)
    got = {r["transaction_id"]: (r["reply"], r["amount"]) for r in replies(incoming, stored).collect()}
    assert got == {"t1": ("stored", 1.0), "t2": ("new", 2.0)}
    assert [r["transaction_id"] for r in first_write_wins(incoming, stored).collect()] == ["t2"]


def test_latency_percentile(spark):
    rows = [(60_000_000 * (i % 10), float(i)) for i in range(200)] + [(0, None)]
    df = spark.createDataFrame(rows, "us long, processing_time_ms double").withColumn("created_at", F.timestamp_micros("us"))
    got = {r["window_us"]: (r["predictions"], r["p95_ms"]) for r in latency_p95(df).collect()}
    early = sorted(float(i) for i in range(200) if i % 10 < 5)
    at = 0.95 * (len(early) - 1)
    want = early[int(at)] + (at - int(at)) * (early[int(at) + 1] - early[int(at)])
    assert got[0][0] == len(early) and got[0][1] == pytest.approx(want) and set(got) == {0, 300_000_000}
