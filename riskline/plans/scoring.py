"""D09 end-to-end batch scoring, J04 idempotency, D06 alerts, S07 dimensions.

``score_batch`` is one logical plan: features -> probability -> policy ->
prediction rows.  The same column functions run inside the streaming query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.functions import policy as P
from riskline.functions.reasons import reason_factors
from riskline.operators.features import online_features, snapshot


def with_heuristic_probability(features: DataFrame) -> DataFrame:
    return features.withColumn(
        "fraud_probability",
        P.heuristic_probability(
            F.col("amount_vs_user_average"), F.col("transactions_last_5m"), F.col("new_device"),
            F.col("new_country"), F.col("impossible_travel"),
        ),
    ).withColumn("model_version", F.lit(C.BOOTSTRAP_VERSION))


def apply_policy(scored: DataFrame, policy: P.Policy = P.Policy()) -> DataFrame:
    """D01 + D02 + D04 + D05 on a frame holding fraud_probability and the features."""
    feats = {n: F.col(n) for n in C.ONLINE_FEATURES if n in scored.columns}
    for n in ("impossible_travel", "transactions_last_5m", "amount_vs_user_average", "new_device"):
        feats.setdefault(n, F.lit(None).cast("double"))
    p = P.checked_probability(F.col("fraud_probability"))
    return (
        scored.withColumn("fraud_probability", p)
        .withColumn("rule_reasons", P.rule_reasons(feats, policy))
        .withColumn("risk_score", P.risk_score(F.col("fraud_probability")))
        .withColumn("decision", P.decision(F.col("fraud_probability"), F.col("rule_reasons"), policy))
    )


def score_batch(txns: DataFrame, policy: P.Policy | None = None, model=None,
                horizon_days: int = C.HISTORY_DAYS, with_snapshot: bool = True) -> DataFrame:
    """Transactions (with ``us``) -> one prediction row per transaction.

    ``model`` is a ``riskline.plans.training.TrainedModel`` or None (bootstrap heuristic).
    Keeps the transaction columns, adds the 19 features, fraud_probability,
    risk_score, decision, rule_reasons, model_version and feature_snapshot.
    ``with_snapshot=False`` is for decision-only outputs: the two 24 h distinct counts
    and the median (read by neither the bootstrap model nor the policy) are skipped.
    """
    if policy is None:  # D07: the model's thresholds unless the caller passes a policy
        policy = (P.Policy() if model is None
                  else P.Policy.resolve(model.review_threshold, model.block_threshold))
    needs_all = with_snapshot or model is not None
    feats = online_features(txns, horizon_days=horizon_days, distinct_counts=needs_all, medians=needs_all)
    return score_features(feats, policy, model, with_snapshot)


def score_features(feats: DataFrame, policy: P.Policy = P.Policy(), model=None, with_snapshot: bool = True
                   ) -> DataFrame:
    """Probability, policy and snapshot on rows that already hold the features (batch and stream)."""
    scored = with_heuristic_probability(feats) if model is None else model.score(feats)
    out = apply_policy(scored, policy)
    return out.withColumn("feature_snapshot", snapshot()) if with_snapshot else out


def prediction_rows(scored: DataFrame) -> DataFrame:
    """Project the prediction contract (Prediction + snapshot)."""
    return scored.select(
        "transaction_id", "fraud_probability", "risk_score", "decision", "model_version",
        "rule_reasons", "feature_snapshot", F.col("timestamp").alias("created_at"),
    )


def alert_id(transaction_id: Column) -> Column:
    """60 bits of the transaction id's MD5: the same id in batch and stream, whatever the source."""
    return F.conv(F.substring(F.md5(transaction_id), 1, 15), 16, 10).cast("long")


def alerts_from(scored: DataFrame) -> DataFrame:
    """Non-APPROVE predictions become OPEN alerts."""
    return scored.where(F.col("decision") != "APPROVE").select(
        alert_id(F.col("transaction_id")).alias("alert_id"),
        "transaction_id",
        P.alert_severity(F.col("decision")).alias("severity"),
        F.lit("OPEN").alias("status"),
        F.col("timestamp").alias("created_at"),
        F.col("us").alias("created_us"),
    )


def explanations_for(scored: DataFrame, limit: int = C.REASON_LIMIT) -> DataFrame:
    """E01 as rows: one row per kept factor (transaction_id, position, feature, impact, direction)."""
    feats = {n: F.col(n) for n in C.ONLINE_FEATURES}
    return scored.select(
        "transaction_id", F.posexplode(reason_factors(feats, limit)).alias("pos", "factor")
    ).select(
        "transaction_id",
        (F.col("pos") + 1).cast("long").alias("position"),
        F.col("factor.feature").alias("feature"),
        F.col("factor.impact").alias("impact"),
        F.col("factor.direction").alias("direction"),
    )


def first_write_wins(incoming: DataFrame, stored: DataFrame | None, key: str = "transaction_id",
                     order_cols: tuple[str, ...] = ("source_seq",)) -> DataFrame:
    """Keep the first arrival per key inside the batch and drop keys already stored.

    An aggregate (``min_by`` with map-side partial aggregation), so a key
    replayed millions of times is combined before the shuffle, not in one task.
    """
    others = [c for c in incoming.columns if c != key]
    first = incoming.groupBy(key).agg(
        F.min_by(F.struct(*others), F.struct(*order_cols)).alias("_first")).select(key, "_first.*")
    if stored is None:
        return first
    return first.join(stored.select(key), key, "left_anti")


def replies(incoming: DataFrame, stored: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per incoming key with ``reply``: the stored row where there is one, else the first arrival."""
    first = first_write_wins(incoming, None, key).select(*incoming.columns)
    new = first.join(stored.select(key), key, "left_anti").withColumn("reply", F.lit("new"))
    known = stored.select(*incoming.columns).join(first.select(key), key, "left_semi").withColumn("reply", F.lit("stored"))
    return new.unionByName(known)


def user_dimension(txns: DataFrame) -> DataFrame:
    """S07 users: insert-if-new == first time seen."""
    return txns.groupBy("user_id").agg(F.min("us").alias("created_us"))


def merchant_dimension(txns: DataFrame) -> DataFrame:
    """S07 merchants: latest category / country wins (by event time, then id)."""
    return txns.groupBy("merchant_id").agg(
        F.min("us").alias("created_us"),
        F.max_by(F.struct("merchant_category", "country"), F.struct("us", "transaction_id")).alias("latest"),
    ).select("merchant_id", F.col("latest.merchant_category").alias("category"),
             F.col("latest.country").alias("country"), "created_us")
