"""Stream = batch on time-ordered input, arrival semantics on any other; nothing is lost; replay is idempotent."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators.validate import split_valid, validate_payloads
from riskline.plans.catalog import transactions
from riskline.plans.scoring import alerts_from, score_batch
from riskline.sources.adapter import COMPRESSED_SCALE, payloads_from_transactions
from riskline.streaming.pipeline import BatchScorer, explain_job, file_payload_stream, start_scoring, valid_events


def write_files(folder, chunks):
    """One file per micro-batch; the file source orders by modification time, so the times are set apart."""
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(chunks):
        path = os.path.join(folder, f"part-{i:03d}.jsonl")
        with open(path, "w") as fh:
            fh.write("".join(line + "\n" for line in lines))
        os.utime(path, (1_700_000_000 + 10 * i,) * 2)


def run_stream(spark, chunks):
    root = tempfile.mkdtemp(prefix="riskline-stream-")
    src = os.path.join(root, "in")
    write_files(src, chunks)
    for q in start_scoring(file_payload_stream(spark, src, max_files_per_trigger=1), os.path.join(root, "out"),
                           os.path.join(root, "ckpt"), available_now=True):
        q.awaitTermination(600)
    return os.path.join(root, "out")


@pytest.fixture(scope="module")
def payloads(spark, small_dir):
    tx = transactions(spark, small_dir, "events", COMPRESSED_SCALE)
    return payloads_from_transactions(tx).join(tx.select("source_seq", "us"), "source_seq").orderBy("us", "source_seq").persist()


def quarters(payloads):
    lines = [r["payload"] for r in payloads.collect()]  # tiny fixture only
    size = -(-len(lines) // 4)
    return [lines[i:i + size] for i in range(0, len(lines), size)]


@pytest.fixture(scope="module")
def ordered(spark, payloads):
    return run_stream(spark, quarters(payloads))


@pytest.fixture(scope="module")
def shuffled(spark, payloads):
    """The last quarter first, the first quarter last and given twice; the events span far more than any watermark."""
    a, b, c, d = quarters(payloads)
    return run_stream(spark, [d, b, c, a, a])


def table(spark, out, name):
    return spark.read.parquet(os.path.join(out, name))


def features_of(df, prefix=""):
    return {r["transaction_id"]: r for r in df.select("transaction_id", *[F.col(prefix + f).alias(f) for f in C.ONLINE_FEATURES]).collect()}


def assert_same_features(got, want):
    assert got.keys() == want.keys()
    for k in got:
        for f in C.ONLINE_FEATURES:
            assert abs(got[k][f] - want[k][f]) <= 1e-6 * max(1.0, abs(want[k][f])), (k, f, got[k][f], want[k][f])


def test_stream_equals_batch(spark, payloads, ordered):
    good, _ = split_valid(validate_payloads(payloads.select("source_seq", "payload")))
    batch = score_batch(good)
    streamed = table(spark, ordered, "predictions")
    cols = ["transaction_id", "fraud_probability", "decision", "risk_score"]
    a = {r["transaction_id"]: r for r in streamed.select(*cols).collect()}
    b = {r["transaction_id"]: r for r in batch.select(*cols).collect()}
    assert a.keys() == b.keys() and len(a) > 500
    for k in a:
        assert (a[k]["decision"], a[k]["risk_score"]) == (b[k]["decision"], b[k]["risk_score"]), k
        assert abs(a[k]["fraud_probability"] - b[k]["fraud_probability"]) < 1e-9, k
    assert_same_features(features_of(streamed, "feature_snapshot."), features_of(batch))


def test_alerts_have_the_ids_of_the_batch(spark, payloads, ordered):
    good, _ = split_valid(validate_payloads(payloads.select("source_seq", "payload")))
    want = {r["transaction_id"]: r["alert_id"] for r in alerts_from(score_batch(good)).collect()}
    got = {r["transaction_id"]: r["alert_id"] for r in table(spark, ordered, "alerts").collect()}
    assert got == want and None not in got.values() and len(set(got.values())) == len(got) > 0


def test_any_arrival_order_loses_nothing(spark, payloads, shuffled):
    """Every valid distinct id is scored once, with the history that had arrived, however late it came."""
    checked = validate_payloads(payloads.select("source_seq", "payload"))
    good, _ = split_valid(checked)
    a, b, c, d = quarters(payloads)
    arrival = spark.createDataFrame([(p, i) for i, part in enumerate((d, b, c, a)) for p in part], "payload string, arrival int")
    order = checked.where("valid").join(arrival.dropDuplicates(["payload"]), "payload").select("transaction_id", "arrival")
    rows = [r.asDict() for r in good.join(order, "transaction_id").collect()]
    got = {r["transaction_id"]: r for r in table(spark, shuffled, "predictions").collect()}
    assert len(got) == table(spark, shuffled, "predictions").count() == len({r["transaction_id"] for r in rows})
    for r in rows:
        past = [h for h in rows if h["user_id"] == r["user_id"] and h["arrival"] <= r["arrival"]
                and r["us"] - C.HISTORY_DAYS * C.DAY_US <= h["us"] < r["us"]]
        snap = got[r["transaction_id"]]["feature_snapshot"]
        assert snap["transactions_last_24h"] == sum(h["us"] >= r["us"] - C.DAY_US for h in past)
        mean = sum(h["amount"] for h in past) / len(past) if past else r["amount"]
        assert snap["user_average_amount"] == pytest.approx(mean, rel=1e-9)
        assert snap["new_device"] == float(bool(past) and r["device_id"] not in {h["device_id"] for h in past})
    alerts = table(spark, shuffled, "alerts")
    assert alerts.where("alert_id is null").count() == 0 and alerts.select("alert_id").distinct().count() == alerts.count()


def test_dead_letters_written(spark, payloads, ordered):
    dlq = table(spark, ordered, "dead_letters")
    _, bad = split_valid(validate_payloads(payloads.select("source_seq", "payload")))
    assert dlq.count() == bad.count() > 0
    assert dlq.where(F.col("error").contains("malformed_json")).count() > 0


def event(tid, us, user="u1", amount=10.0):
    return (tid, user, "m1", us, amount)


def events(spark, rows):
    frame = spark.createDataFrame(rows, "transaction_id string, user_id string, merchant_id string, us long, amount double")
    return frame.select(
        "transaction_id", "user_id", "merchant_id", F.timestamp_micros("us").alias("timestamp"), "us", "amount",
        F.lit("USD").alias("currency"), F.lit("grocery").alias("merchant_category"), F.lit("US").alias("country"),
        F.lit("d1").alias("device_id"), F.lit("192.0.2.1").alias("ip_address"), F.lit("web").alias("channel"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        F.lit(None).cast("long").alias("source_seq"))


def test_replay_duplicates_and_very_late_events(spark, tmp_path):
    day, start = C.DAY_US, 1_704_067_200_000_000 + 200 * C.DAY_US
    sink = BatchScorer(str(tmp_path / "out"))
    first = events(spark, [event("a", start), event("b", start + day), event("a", start, amount=99.0)])
    second = events(spark, [event("c", start + 2 * day), event("b", start + day), event("old", start - 90 * day)])
    for batch_id, batch in enumerate((first, second)):
        sink(batch, batch_id)
    before = sorted(map(str, table(spark, sink.root, "predictions").collect()))
    sink(second, 1)  # the micro-batch is replayed after a failure
    assert sorted(map(str, table(spark, sink.root, "predictions").collect())) == before
    sink(events(spark, [event("a", start), event("old", start - 90 * day)]), 2)  # known ids only
    sink(events(spark, []), 3)
    rows = {r["transaction_id"]: r["feature_snapshot"] for r in table(spark, sink.root, "predictions").collect()}
    assert sorted(rows) == ["a", "b", "c", "old"] and table(spark, sink.root, "predictions").count() == 4
    assert rows["c"]["user_average_amount"] == 10.0 and rows["c"]["new_merchant"] == 0.0  # duplicates left no trace
    assert rows["old"]["user_average_amount"] == 10.0
    assert table(spark, sink.root, "transactions").count() == 4


def test_explain_job_takes_what_is_pending(spark, ordered):
    assert explain_job(spark, ordered).count() == 0
    sink = BatchScorer(tempfile.mkdtemp(prefix="riskline-pending-"), explain_alerts=False)
    rows = [event(f"t{i}", 1_704_067_200_000_000 + i * 1_000_000, amount=1.0 if i < 9 else 900.0) for i in range(12)]
    sink(events(spark, rows), 0)
    pending = {r["transaction_id"] for r in explain_job(spark, sink.root).collect()}
    assert pending == {r["transaction_id"] for r in table(spark, sink.root, "alerts").collect()} != set()


def test_valid_events_keeps_the_contract_columns(spark, payloads):
    from riskline.streaming.pipeline import EVENT_COLUMNS, checked_stream

    assert valid_events(checked_stream(payloads.select("payload"))).columns == EVENT_COLUMNS


def test_drift_job_on_sink(spark, ordered):
    from riskline.streaming.pipeline import drift_job

    reference = table(spark, ordered, "transactions").join(
        table(spark, ordered, "predictions").select("transaction_id", "fraud_probability"),
        "transaction_id").select("amount", "country", "fraud_probability")
    reports = os.path.join(tempfile.mkdtemp(prefix="riskline-drift-"), "drift_reports")
    rep = drift_job(spark, ordered, reference, report_path=reports).first()
    assert rep["rows"] >= 100 and rep["amount_psi"] == pytest.approx(0.0, abs=1e-9)
    assert spark.read.parquet(reports).count() == 1
