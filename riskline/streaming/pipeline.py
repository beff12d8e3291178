"""Structured Streaming scorer.

    readStream (text / Kafka)                        S04
      -> contract validation                         X01  (dead letters: second query)
      -> foreachBatch: first write wins              X02  (inside the batch and against the stored ids)
      -> features against what has arrived           X03  (``operators.features.arrival_features``)
      -> probability + policy (same columns as batch) X04
      -> tables                                      S06  (+ S05 event projection, X05 explanations)

The stored tables are the state: there is no watermark and no state store, so an event of any age is scored, against
the rows of its user that arrived before it (earlier micro-batches, or the same one with a smaller event time).
Duplicates are removed before features are computed and never enter a history.  Stored ids are partitioned by a
bucket of the transaction id, stored transactions by a bucket of the user id; a micro-batch reads only the buckets it
touches, of the transactions only the horizon before its oldest event.

Every table is written under ``batch_id=<id>`` with dynamic partition overwrite, and a micro-batch reads only smaller
batch ids, so a replayed micro-batch (after a failure) rewrites the same partitions with the same rows.  With
``compact_every`` the finished micro-batches are merged now and then (``sources.versioned``), so files stay few.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.functions.policy import Policy
from riskline.operators.attribution import explain_pending
from riskline.operators.features import arrival_features
from riskline.operators.validate import validate_payloads
from riskline.plans.scoring import alerts_from, explanations_for, first_write_wins, prediction_rows, score_features
from riskline.sources.versioned import VersionedTable

TOPIC_TRANSACTIONS = "transactions.v1"
TOPIC_PREDICTIONS = "fraud_predictions.v1"
TOPIC_ALERTS = "fraud_alerts.v1"
TOPIC_LABELS = "confirmed_labels.v1"
TOPIC_DLQ = "transactions.dlq.v1"


def file_payload_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S04 (file source): one JSON payload per line; ``source_seq`` is not known, so it is null."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.col("value").alias("payload"))


def kafka_payload_stream(spark: SparkSession, servers: str, topic: str = TOPIC_TRANSACTIONS) -> DataFrame:
    """S04 (Kafka, earliest offsets).  Needs the Kafka connector on the classpath."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest").load()
            .select(F.col("value").cast("string").alias("payload"), F.col("offset").alias("source_seq")))


def checked_stream(payloads: DataFrame) -> DataFrame:
    df = payloads if "source_seq" in payloads.columns else payloads.withColumn("source_seq", F.lit(None).cast("long"))
    return validate_payloads(df)


def dead_letters(checked: DataFrame) -> DataFrame:
    """X01 rejects: original payload and error codes."""
    return checked.where(~F.col("valid")).select(
        F.lit(TOPIC_DLQ).alias("topic"), F.col("payload").alias("original_payload"),
        F.array_join("errors", "|").alias("error"))


EVENT_COLUMNS = ["transaction_id", "user_id", "merchant_id", "timestamp", "us", "amount", "currency",
                 "merchant_category", "country", "device_id", "ip_address", "channel", "latitude", "longitude",
                 "source_seq"]
BUCKETS = 64
#: The scorer's tables and what they are partitioned by, besides the micro-batch.
TABLES: dict[str, tuple[str, ...]] = {
    "transactions": ("user_bucket",), "predictions": (), "alerts": (), "outbox": (), "explanations": (), "transaction_ids": ("id_bucket",)}


def valid_events(checked: DataFrame) -> DataFrame:
    """The valid events in the contract schema, with ``us``."""
    return checked.where(F.col("valid")).withColumn("us", F.unix_micros("timestamp")).select(*EVENT_COLUMNS)


def bucket_of_text(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def event_projection(scored: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Outgoing events (topic, event_key, compact JSON payload) for the business topics."""
    txn_cols = [c for c in C.TRANSACTION_KEYS if c in scored.columns]
    parts = [
        scored.select(F.lit(TOPIC_TRANSACTIONS).alias("topic"), F.col("transaction_id").alias("event_key"),
                      F.to_json(F.struct(*txn_cols)).alias("payload")),
        scored.select(F.lit(TOPIC_PREDICTIONS).alias("topic"), F.col("transaction_id").alias("event_key"),
                      F.to_json(F.struct("transaction_id", "fraud_probability", "risk_score", "decision",
                                         "model_version", "rule_reasons")).alias("payload")),
        scored.where(F.col("decision") != "APPROVE").select(
            F.lit(TOPIC_ALERTS).alias("topic"), F.col("transaction_id").alias("event_key"),
            F.to_json(F.struct("transaction_id", "decision", "risk_score", "rule_reasons")).alias("payload")),
    ]
    if labels is not None:
        parts.append(labels.select(F.lit(TOPIC_LABELS).alias("topic"), F.col("transaction_id").alias("event_key"),
                                   F.to_json(F.struct("transaction_id", "is_fraud", "source", "confirmed_us"))
                                   .alias("payload")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class BatchScorer:
    """``foreachBatch`` function: dedup, score and store one micro-batch of valid events."""

    root: str
    policy: Policy = field(default_factory=Policy)
    horizon_days: int = C.HISTORY_DAYS
    explain_alerts: bool = True

    #: Micro-batches after which the tables are merged; 0: never.
    compact_every: int = 0

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def _table(self, spark: SparkSession, table: str) -> VersionedTable:
        return VersionedTable(spark, self.path(table), TABLES[table])

    def _write(self, df: DataFrame, table: str, batch_id: int) -> None:
        self._table(df.sparkSession, table).write(df, batch_id)

    def _stored(self, spark: SparkSession, table: str, bucket: str, buckets: list[int], batch_id: int
                ) -> DataFrame | None:
        """Rows of earlier micro-batches in the given buckets; None before the first one."""
        stored = self._table(spark, table).read(before=batch_id)
        return None if stored is None else stored.where(F.col(bucket).isin(buckets))

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Merge the finished micro-batches up to ``upto`` in every table."""
        for table in TABLES:
            target = self._table(spark, table)
            target.compact(upto)
            target.clean()

    def fresh(self, batch: DataFrame, batch_id: int, buckets: list[int]) -> DataFrame:
        """First write wins: one row per id, none that is stored."""
        ids = self._stored(batch.sparkSession, "transaction_ids", "id_bucket", buckets, batch_id)
        return first_write_wins(batch, ids, order_cols=("source_seq", "us", "amount", "user_id"))

    def history(self, batch: DataFrame, batch_id: int, buckets: list[int], since_us: int) -> DataFrame | None:
        """Stored rows of the batch's users within the horizon before its oldest event."""
        stored = self._stored(batch.sparkSession, "transactions", "user_bucket", buckets, batch_id)
        if stored is None:
            return None
        near = stored.where(F.col("us") >= F.lit(since_us - self.horizon_days * C.DAY_US))
        return near.join(batch.select("user_id").distinct(), "user_id", "left_semi").select(*EVENT_COLUMNS)

    @staticmethod
    def keyed(batch: DataFrame) -> DataFrame:
        return batch.withColumn("id_bucket", bucket_of_text(F.col("transaction_id"))).withColumn(
            "user_bucket", bucket_of_text(F.col("user_id")))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = self.keyed(batch).persist()
        try:
            # at most BUCKETS small integers each
            touched = batch.agg(F.collect_set("id_bucket").alias("ids"), F.collect_set("user_bucket").alias("users"),
                                F.min("us").alias("since")).first()
            if touched["since"] is None:
                return
            fresh = self.fresh(batch, batch_id, touched["ids"])
            history = self.history(batch, batch_id, touched["users"], touched["since"])
            self.store(fresh.select(*EVENT_COLUMNS), history, batch_id)
        finally:
            batch.unpersist()

    def store(self, fresh: DataFrame, history: DataFrame | None, batch_id: int) -> None:
        """Score new rows against themselves and their history, and write the micro-batch's part of every table."""
        feats = arrival_features(fresh, history, horizon_days=self.horizon_days)
        scored = score_features(feats, self.policy).persist()
        try:
            rows = scored.withColumn("user_bucket", bucket_of_text(F.col("user_id")))
            self._write(rows.select(*EVENT_COLUMNS, "user_bucket"), "transactions", batch_id)
            self._write(prediction_rows(scored), "predictions", batch_id)
            self._write(alerts_from(scored), "alerts", batch_id)
            self._write(event_projection(scored), "outbox", batch_id)
            if self.explain_alerts:
                self._write(explanations_for(scored.where(F.col("decision") != "APPROVE")), "explanations", batch_id)
            # last: an id counts as stored once its rows are
            self._write(scored.select("transaction_id", bucket_of_text(F.col("transaction_id")).alias("id_bucket")),
                        "transaction_ids", batch_id)
        finally:
            scored.unpersist()
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            # not the present one: it may be played again
            self.compact(fresh.sparkSession, batch_id - 1)


def stored_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Rows of one of the scorer's tables, merged or not; None before the first micro-batch."""
    return VersionedTable(spark, os.path.join(root, table), TABLES[table]).read()


def explain_job(spark: SparkSession, root: str, recomputed: DataFrame | None = None) -> DataFrame:
    """Explanations of the stored alerts that have none yet, from their snapshot or from recomputed features."""
    alerts, done = stored_table(spark, root, "alerts"), stored_table(spark, root, "explanations")
    if done is not None:
        alerts = alerts.join(done.select("transaction_id").distinct(), "transaction_id", "left_anti")
    return explain_pending(alerts, stored_table(spark, root, "predictions"), recomputed)


def drift_job(spark: SparkSession, sink_root: str, reference: DataFrame, model_version: str = C.BOOTSTRAP_VERSION,
              as_of_us: int | None = None, report_path: str | None = None) -> DataFrame:
    """R04 over the sink's tables (last day before ``as_of_us``), appended to a report table."""
    from riskline.operators.drift import drift_report

    tx = stored_table(spark, sink_root, "transactions").select("transaction_id", "us", "amount", "country")
    pr = stored_table(spark, sink_root, "predictions").select("transaction_id", "fraud_probability")
    joined = tx.join(pr, "transaction_id")
    if as_of_us is None:
        as_of_us = joined.agg(F.max("us")).first()[0]
    current = joined.where(F.col("us") >= F.lit(as_of_us - C.DAY_US))
    report = drift_report(reference, current, model_version, as_of_us - C.DAY_US, as_of_us)
    if report_path is not None:
        report.write.mode("append").parquet(report_path)
    return report


def start_scoring(payloads: DataFrame, sink_root: str, checkpoint: str, policy: Policy = Policy(),
                  available_now: bool = False, processing_time: str | None = None):
    """Start the scoring query (and a dead-letter query on the same source); returns both handles."""
    checked = checked_stream(payloads)
    w = valid_events(checked).writeStream.foreachBatch(BatchScorer(sink_root, policy)).option(
        "checkpointLocation", os.path.join(checkpoint, "scoring"))
    d = (dead_letters(checked).writeStream.format("parquet").option("path", os.path.join(sink_root, "dead_letters"))
         .option("checkpointLocation", os.path.join(checkpoint, "dead_letters")))
    if available_now:
        w, d = w.trigger(availableNow=True), d.trigger(availableNow=True)
    elif processing_time:
        w, d = w.trigger(processingTime=processing_time), d.trigger(processingTime=processing_time)
    return w.start(), d.start()
