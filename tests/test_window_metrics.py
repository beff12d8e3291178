"""Window sketches: merged windows against rows, the stream against the batch, null and empty input."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskline.operators import window_metrics as WM

START = datetime(2024, 1, 1)
SCHEMA = "timestamp timestamp, user_id string, cents long"
QUANTILES = {"p05": 0.05, "p50": 0.5, "p95": 0.95}


def rows_of(n=6000):
    """Two hours; one five-minute window holds a third of the rows, values repeat and are skewed."""
    at = lambda i: 1000 + i % 200 if i % 3 == 0 else i * 7200 // n
    return [(START + timedelta(seconds=at(i)), f"u{i * i % 997}", (i * 7919 % 1013) ** 2) for i in range(n)]


def hours(spark, rows, minutes=60):
    return WM.merge_windows(WM.window_sketches(spark.createDataFrame(rows, SCHEMA), "cents", "user_id"), minutes)


def test_merged_windows_are_within_the_stated_bounds(spark):
    rows = rows_of()
    read = WM.read_windows(hours(spark, rows), QUANTILES).collect()
    assert [r["n"] for r in sorted(read)] == [sum(1 for t, _, _ in rows if (t - START).seconds // 3600 == h) for h in (0, 1)]
    for h, r in enumerate(sorted(read)):
        inside = [x for x in rows if (x[0] - START).seconds // 3600 == h]
        ids = len({u for _, u, _ in inside})
        assert abs(r["ids"] - ids) <= WM.IDS_ERROR * ids
        for name, q in QUANTILES.items():
            below, upto = sum(v < r[name] for *_, v in inside), sum(v <= r[name] for *_, v in inside)
            slack = WM.RANK_ERROR * len(inside)
            assert below <= q * len(inside) + slack and upto >= q * len(inside) - slack


def test_bounds_report_tells_a_wrong_quantile(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    read = WM.read_windows(hours(spark, rows_of()), QUANTILES)

    def report(r):
        return WM.within_bounds(r, df, "cents", "user_id", 60, QUANTILES).collect()

    assert all(r["ids_ok"] and r["p05_ok"] and r["p50_ok"] and r["p95_ok"] for r in report(read))
    wrong = report(read.withColumn("p50", F.col("p95")).withColumn("ids", F.col("ids") * 2))
    assert len(wrong) == 2 and not any(r["ids_ok"] or r["p50_ok"] for r in wrong) and all(r["p95_ok"] for r in wrong)


def test_merging_in_steps_counts_the_same(spark):
    once = hours(spark, rows_of(), 120).collect()
    twice = WM.merge_windows(WM.merge_windows(hours(spark, rows_of(), 30), 60), 120)
    got = WM.read_windows(twice, QUANTILES).first()
    assert got["n"] == once[0]["n"] == 6000
    assert got["ids"] == WM.read_windows(hours(spark, rows_of(), 120), QUANTILES).first()["ids"]  # a union does not depend on the order


def test_null_and_empty_input(spark):
    made = [(None, "a", 1), (START, None, None), (START, "b", None), (START + timedelta(days=1), "c", 5)]
    read = {r["window_us"]: r for r in WM.read_windows(hours(spark, made), {"p50": 0.5}).collect()}
    a, b = (read[k] for k in sorted(read))
    assert (a["n"], a["ids"], a["p50"]) == (2, 1, None) and (b["n"], b["ids"], b["p50"]) == (1, 1, 5)
    assert WM.read_windows(hours(spark, []), {"p50": 0.5}).count() == 0


@pytest.mark.parametrize("late", [False, True])
def test_stream_equals_batch(spark, tmp_path, late):
    """Closed windows hold what a batch counts; a row older than the watermark is left out."""
    rows = sorted(rows_of(900))
    end = [(START + timedelta(days=1), "end", 0)]
    parts = [rows[:300], rows[300:600], rows[600:], end, *([[(START, "late", 1)]] if late else []), end]
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    for i, part in enumerate(parts):  # the file source orders by modification time
        made = os.path.join(folder, f"{i:02d}.csv")
        with open(made, "w") as f:
            f.writelines(f"{t.isoformat()}Z,{u},{v}\n" for t, u, v in part)
        os.utime(made, (1_700_000_000 + 10 * i,) * 2)
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).csv(folder)
    out = str(tmp_path / "out")
    WM.start_window_metrics(events, out, str(tmp_path / "ckpt"), "cents", "user_id", available_now=True).awaitTermination(300)
    got = spark.read.parquet(out)
    want = WM.window_sketches(spark.createDataFrame(rows, SCHEMA), "cents", "user_id")
    columns = ["window_us", "n", "ids", "p50"]
    got, want = (sorted(map(tuple, WM.read_windows(x, {"p50": 0.5}).select(columns).collect())) for x in (got, want))
    assert got == want and sum(r[1] for r in got) == 900  # windows under QUANTILE_K rows are exact
