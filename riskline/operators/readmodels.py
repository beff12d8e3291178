"""Read models over the scored tables.

All time-relative queries take an explicit ``as_of_us`` (no wall clock), so the
same call gives the same answer on recompute and matches its SQL twin.  Future
dated rows are not cut off (no upper bound), as in the reproduced service.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskline import constants as C

FEED_MAX_LIMIT = 500
ALERTS_MAX_LIMIT = 1000
RECENT_ROWS = 10


@dataclass(frozen=True)
class FeedFilter:
    hours: int = 24
    limit: int = 100
    offset: int = 0
    decision: str | None = None
    min_risk: int = 0
    max_risk: int = 100
    country: str | None = None
    merchant_category: str | None = None
    min_amount: float | None = None

    def __post_init__(self) -> None:
        if not 1 <= self.hours <= 24 * 365:
            raise ValueError("hours must be within 1..8760")
        if not 1 <= self.limit <= FEED_MAX_LIMIT:
            raise ValueError("limit must be within 1..500")
        if self.offset < 0:
            raise ValueError("offset must be >= 0")
        if not (0 <= self.min_risk <= 100 and 0 <= self.max_risk <= 100):
            raise ValueError("risk bounds must be within 0..100")
        if self.min_risk > self.max_risk:
            raise ValueError("the risk range is empty")
        if self.decision is not None and self.decision not in C.DECISIONS:
            raise ValueError("unknown decision")
        if self.country is not None and len(self.country) != 2:
            raise ValueError("country must have two letters")
        if self.min_amount is not None and self.min_amount < 0:
            raise ValueError("min_amount must be >= 0")


def scored_rows(txns: DataFrame, predictions: DataFrame) -> DataFrame:
    """Transactions with their prediction (inner)."""
    return txns.join(predictions, "transaction_id", "inner")


def with_cases(rows: DataFrame, alert_state: DataFrame, labels: DataFrame) -> DataFrame:
    """Left to alert state and latest labels; meant for a page, so neither side is wide."""
    alerts = alert_state.select("transaction_id", F.col("status").alias("case_status"), "resolution")
    lab = labels.select("transaction_id", F.col("is_fraud").alias("label_is_fraud"))
    return rows.join(alerts, "transaction_id", "left").join(lab, "transaction_id", "left")


def _feed_filtered(joined: DataFrame, f: FeedFilter, as_of_us: int) -> DataFrame:
    cond = (
        (F.col("us") >= F.lit(as_of_us - f.hours * C.HOUR_US))
        & (F.col("risk_score") >= f.min_risk)
        & (F.col("risk_score") <= f.max_risk)
    )
    if f.decision is not None:
        cond &= F.col("decision") == f.decision
    if f.country is not None:
        cond &= F.col("country") == f.country.upper()
    if f.merchant_category is not None:
        cond &= F.col("merchant_category") == f.merchant_category
    if f.min_amount is not None:
        cond &= F.col("amount") >= f.min_amount
    return joined.where(cond)


def feed_rows(scored: DataFrame, f: FeedFilter, as_of_us: int) -> DataFrame:
    """Q01 page of scored rows: newest first (ties by id), offset / limit -> top-k, no global sort."""
    rows = _feed_filtered(scored, f, as_of_us)
    return rows.orderBy(F.col("us").desc(), F.col("transaction_id")).offset(f.offset).limit(f.limit)


def feed_page(page: DataFrame, alert_state: DataFrame, labels: DataFrame) -> DataFrame:
    """Q01 page with its case data: the page is taken first, state and labels have one row per transaction."""
    return with_cases(page, alert_state, labels).select(
        "transaction_id", F.col("us").alias("timestamp_us"), "user_id", "merchant_id", "merchant_category",
        "amount", "currency", "country", "risk_score", "fraud_probability", "decision", "model_version",
        "case_status", "resolution",
        F.when(F.col("label_is_fraud"), F.lit("FRAUD")).when(F.col("label_is_fraud").isNotNull(), F.lit("LEGITIMATE"))
        .alias("confirmed_label"),
    )


def feed_total(scored: DataFrame, f: FeedFilter, as_of_us: int) -> DataFrame:
    """Q01 total count for the same filter."""
    return _feed_filtered(scored, f, as_of_us).agg(F.count(F.lit(1)).alias("total"))


def overview(txns: DataFrame, predictions: DataFrame, as_of_us: int, hours: int = 24) -> DataFrame:
    """Q02 + Q09 KPI tiles: one row (total, per-decision counts) over the last ``hours``."""
    since = F.col("us") >= F.lit(as_of_us - hours * C.HOUR_US)
    j = txns.where(since).select("transaction_id").join(predictions.select("transaction_id", "decision"),
                                                        "transaction_id", "left")
    return j.agg(
        F.count(F.lit(1)).alias("transactions_24h"),
        F.count(F.when(F.col("decision") == "APPROVE", 1)).alias("approved"),
        F.count(F.when(F.col("decision") == "MANUAL_REVIEW", 1)).alias("manual_review"),
        F.count(F.when(F.col("decision") == "BLOCK", 1)).alias("blocked"),
    )


def decisions_since(txns: DataFrame, predictions: DataFrame, as_of_us: int, hours: int = 24) -> DataFrame:
    """Q02 grouped form: decision -> count (scored rows only)."""
    since = F.col("us") >= F.lit(as_of_us - hours * C.HOUR_US)
    return (txns.where(since).select("transaction_id")
            .join(predictions.select("transaction_id", "decision"), "transaction_id")
            .groupBy("decision").agg(F.count(F.lit(1)).alias("transactions")))


def risk_distribution(predictions: DataFrame) -> DataFrame:
    """Q03: risk score histogram (order is presentation; the aggregate is what is computed)."""
    return predictions.groupBy("risk_score").agg(F.count(F.lit(1)).alias("count"))


def model_performance(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """Q04: BLOCK is the positive call.  Empty -> status awaiting_labels."""
    j = labels.select("transaction_id", "is_fraud").join(
        predictions.select("transaction_id", "decision"), "transaction_id")
    pos = F.col("decision") == "BLOCK"
    agg = j.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("is_fraud") & pos, 1)).alias("tp"),
        F.count(F.when(~F.col("is_fraud") & pos, 1)).alias("fp"),
        F.count(F.when(F.col("is_fraud") & ~pos, 1)).alias("fn"),
    )
    precision = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))
    recall = F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    return agg.select(
        F.when(F.col("n") > 0, F.lit("available")).otherwise(F.lit("awaiting_labels")).alias("status"),
        F.col("n").alias("labeled_transactions"),
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(2 * precision * recall / F.greatest(precision + recall, F.lit(1e-12)), 6).alias("f1"),
    )


def recent_user_rows(scored: DataFrame, targets: DataFrame, n: int = RECENT_ROWS,
                     bucket_us: int = C.DAY_US) -> DataFrame:
    """Q05 earlier activity: the n latest other rows of the user at or before t (inclusive).

    Exact and skew-safe without a per-user partition:
      * in-bucket candidates: rows of the same (user, time bucket) within n rows
        before / after the target in (us, id) order (rows after only count on
        an equal timestamp) -- a bounded frame per (user, bucket);
      * earlier buckets: each bucket's last n rows ("tail"); the n latest rows
        before bucket b lie in the tails of the n most recent non-empty earlier
        buckets, gathered by a frame over one aggregated row per (user, bucket).
    Only the buckets that hold a target, and the tails of users that hold one, reach a window.
    ``targets`` has transaction_id, user_id and us.
    """
    row = F.struct(
        F.col("us").alias("us"), F.col("transaction_id").alias("id"), F.col("amount").alias("amount"),
        F.col("currency").alias("currency"), F.col("country").alias("country"),
        F.col("merchant_id").alias("merchant_id"), F.col("risk_score").alias("risk_score"),
        F.col("decision").alias("decision"),
    )
    rows = scored.select("user_id", "us", "transaction_id", row.alias("r"),
                         F.floor(F.col("us") / F.lit(bucket_us)).cast("long").alias("_b"))
    asked = targets.select("user_id", F.floor(F.col("us") / F.lit(bucket_us)).cast("long").alias("_b")).distinct()
    w = Window.partitionBy("user_id", "_b").orderBy("us", "transaction_id")
    near = rows.join(asked, ["user_id", "_b"], "left_semi").select("user_id", "_b", "transaction_id", "us",
                       F.collect_list("r").over(w.rowsBetween(-n, n)).alias("near")
                       ).join(targets.select("transaction_id"), "transaction_id", "left_semi")
    newest = Window.partitionBy("user_id", "_b").orderBy(F.col("us").desc(), F.col("transaction_id").desc())
    tails = (rows.join(asked.select("user_id").distinct(), "user_id", "left_semi").withColumn("_k", F.row_number().over(newest)).where(F.col("_k") <= n)
             .groupBy("user_id", "_b").agg(F.collect_list("r").alias("tail")))
    before = Window.partitionBy("user_id").orderBy("_b").rowsBetween(-n, -1)
    prior = tails.select("user_id", "_b", F.flatten(F.collect_list("tail").over(before)).alias("prior"))
    j = near.join(prior, ["user_id", "_b"], "left")
    cand = F.concat(
        F.filter("near", lambda r: (r["us"] <= F.col("us")) & (r["id"] != F.col("transaction_id"))),
        F.coalesce(F.col("prior"), F.array().cast("array<struct<us:bigint,"
                   "id:string,amount:double,currency:string,country:string,merchant_id:string,risk_score:int,"
                   "decision:string>>")),
    )
    ordered = F.array_sort(
        cand,
        lambda a, b: F.when(a["us"] > b["us"], -1).when(a["us"] < b["us"], 1)
        .when(a["id"] > b["id"], -1).when(a["id"] < b["id"], 1).otherwise(0),
    )
    out = j.select("transaction_id", F.posexplode(F.slice(ordered, 1, n)).alias("pos", "r"))
    return out.select(
        "transaction_id", (F.col("pos") + 1).cast("long").alias("recent_rank"),
        F.col("r.id").alias("recent_transaction_id"), F.col("r.us").alias("recent_us"),
        F.col("r.amount").alias("amount"), F.col("r.country").alias("country"),
        F.col("r.merchant_id").alias("merchant_id"), F.col("r.risk_score").alias("risk_score"),
        F.col("r.decision").alias("decision"),
    )


def investigation(scored: DataFrame, alert_state: DataFrame, explanations: DataFrame | None,
                  labels: DataFrame) -> DataFrame:
    """Q05 header rows for a set of transactions (the alerts): statuses and case data."""
    has_expl = (explanations.select("transaction_id").distinct().withColumn("_has_expl", F.lit(True))
                if explanations is not None else None)
    base = alert_state.join(scored.select("transaction_id", "risk_score", "decision", "feature_snapshot"),
                            "transaction_id")
    if has_expl is not None:
        base = base.join(has_expl, "transaction_id", "left")
    else:
        base = base.withColumn("_has_expl", F.lit(None).cast("boolean"))
    base = base.join(labels.select("transaction_id", F.col("is_fraud").alias("label_is_fraud")),
                     "transaction_id", "left")
    snap = F.col("feature_snapshot").isNotNull()
    return base.select(
        "transaction_id", "alert_id", "status", "resolution", "risk_score", "decision",
        F.when(snap, F.lit("available")).otherwise(F.lit("unavailable")).alias("feature_snapshot_status"),
        F.when(F.col("_has_expl"), F.lit("complete")).when(snap, F.lit("fallback"))
        .otherwise(F.lit("unavailable")).alias("explanation_status"),
        F.when(F.col("label_is_fraud"), F.lit("FRAUD")).when(F.col("label_is_fraud").isNotNull(), F.lit("LEGITIMATE"))
        .alias("confirmed_label"),
    )


def alerts_list(alert_state: DataFrame, explanations: DataFrame | None, limit: int = 100) -> DataFrame:
    """Q06: newest alerts first (top-k, limit <= 1000) with explanation status."""
    if not 1 <= limit <= ALERTS_MAX_LIMIT:
        raise ValueError("limit must be within 1..1000")
    top = alert_state.orderBy(F.col("created_us").desc(), F.col("alert_id").desc()).limit(limit)
    if explanations is not None:
        done = explanations.select("transaction_id").distinct().withColumn("_done", F.lit(True))
        top = top.join(done, "transaction_id", "left")
    else:
        top = top.withColumn("_done", F.lit(None).cast("boolean"))
    return top.select(
        "alert_id", "transaction_id", "severity", "status", "created_us",
        F.when(F.col("_done"), F.lit("complete")).otherwise(F.lit("pending")).alias("explanation_status"),
    )


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Q07 point lookup (pushed down to the scan as an equality filter)."""
    return df.where(F.col(key) == F.lit(value))


def decisions_per_minute(txns: DataFrame, predictions: DataFrame) -> DataFrame:
    """Q08: decisions per minute (tumbling 1-minute windows on event time)."""
    j = txns.select("transaction_id", "timestamp").join(predictions.select("transaction_id", "decision"),
                                                        "transaction_id")
    g = j.groupBy(F.window("timestamp", "1 minute").alias("w"), "decision").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.unix_micros(F.col("w.start")).alias("minute_us"), "decision", "n")


def latency_p95(predictions: DataFrame, minutes: int = 5) -> DataFrame:
    """Q08: 95th percentile of ``processing_time_ms`` per tumbling window of ``created_at``; rows without one are left out.

    Exact: values are first counted per window, so a busy window is combined map-side.
    """
    timed = predictions.where(F.col("processing_time_ms").isNotNull()).select(
        F.unix_micros(F.window("created_at", f"{minutes} minutes")["start"]).alias("window_us"), "processing_time_ms")
    counted = timed.groupBy("window_us", "processing_time_ms").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("window_us").agg(
        F.sum("n").alias("predictions"),
        F.expr("percentile(processing_time_ms, 0.95, n)").alias("p95_ms"))


def errors_by_type(rejects: DataFrame, component: str = "validator") -> DataFrame:
    """Q08 errors by component and type, from a dead-letter table with an ``errors`` array."""
    return (rejects.select(F.explode("errors").alias("error_type"))
            .groupBy(F.lit(component).alias("component"), "error_type")
            .agg(F.count(F.lit(1)).alias("errors")))


BEHAVIOUR_SIGNALS = ["transactions_last_1m", "new_merchant", "new_country", "new_device", "ip_changed",
                     "travel_speed_kmh", "impossible_travel"]


def behaviour_signals(scored: DataFrame, targets: DataFrame) -> DataFrame:
    """Q09: seven behaviour signals of the snapshot as long-form rows (unpivot)."""
    t = scored.join(targets.select("transaction_id"), "transaction_id", "left_semi")
    cols = [F.round(F.col(f"feature_snapshot.{s}"), 1 if s == "travel_speed_kmh" else 6).alias(s)
            for s in BEHAVIOUR_SIGNALS]
    wide = t.select("transaction_id", *cols)
    return wide.unpivot("transaction_id", BEHAVIOUR_SIGNALS, "signal", "value")
