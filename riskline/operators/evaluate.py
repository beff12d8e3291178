"""Model evaluation as aggregations.

Inputs are DataFrames with ``label`` (0/1), ``amount`` and ``probability``.
Nothing row-sized leaves the executors: the threshold search aggregates once
into <= 60 probability buckets and prices all 168 pairs on that tiny table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators.ordering import prefix_sums_with_totals


@dataclass(frozen=True)
class CostConfig:
    false_positive_cost: float = C.FALSE_POSITIVE_COST
    review_cost: float = C.REVIEW_COST
    review_catch_rate: float = C.REVIEW_CATCH_RATE
    max_review_rate: float = C.MAX_REVIEW_RATE


def decision_loss(decision: Column, fraud: Column, amount: Column, cfg: CostConfig) -> Column:
    """What one decision costs: a missed fraud its amount, a review its price and the fraud it does not catch, a
    wrongly blocked customer a fixed amount."""
    stake = F.when(fraud == 1, amount).otherwise(0.0)
    return (F.when(decision == "approve", stake)
            .when(decision == "review", cfg.review_cost + stake * (1 - cfg.review_catch_rate))
            .otherwise(F.when(fraud == 0, F.lit(cfg.false_positive_cost)).otherwise(0.0)))


def expected_cost(df: DataFrame, review: float, block: float, cfg: CostConfig = CostConfig()) -> DataFrame:
    """One row ``expected_cost`` for thresholds (review, block)."""
    p = F.col("probability")
    decision = F.when(p >= block, "block").when(p >= review, "review").otherwise("approve")
    loss = decision_loss(decision, F.col("label"), F.col("amount"), cfg)
    return df.agg(F.coalesce(F.sum(loss), F.lit(0.0)).alias("expected_cost"))


def threshold_grid() -> list[tuple[int, float, float]]:
    """The 168 (number, review, block) pairs, review first.

    Fixed values: steps of 0.05 as floating-point ranges, review from 0.05 below 0.81, block from 0.05 above review
    below 0.96; the sums' rounding is part of them.
    """
    step = 0.05
    pairs = [(float(r), float(b)) for r in np.arange(step, 0.81, step) for b in np.arange(r + step, 0.96, step)]
    return [(i, r, b) for i, (r, b) in enumerate(pairs)]


def optimize_thresholds(df: DataFrame, cfg: CostConfig = CostConfig()) -> DataFrame:
    """Lowest expected cost pair with review rate <= max; first pair wins ties.

    One row: review_threshold, block_threshold (rounded to 2 places), expected_cost.
    Default (0.40, 0.70, inf) when no pair is feasible.
    """
    spark = df.sparkSession
    pairs = threshold_grid()
    thresholds = sorted({r for _, r, _ in pairs} | {b for _, _, b in pairs})
    arr = F.array(*[F.lit(t) for t in thresholds])
    p, y, a = F.col("probability"), F.col("label"), F.col("amount")
    # bucket j = number of thresholds <= p; rows with p < thresholds[j] are buckets 0..j
    bucketed = df.select(F.size(F.filter(arr, lambda t: t <= p)).alias("j"), y.alias("y"), a.alias("a"))
    per = bucketed.groupBy("j").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("y") == 1, F.col("a")).otherwise(0.0)).alias("fa"),
        F.count(F.when(F.col("y") == 0, 1)).alias("legit"),
    )
    nt = len(thresholds)
    all_j = spark.range(nt + 1).select(F.col("id").cast("int").alias("j"))
    per = all_j.join(per, "j", "left").fillna(0, ["n", "legit"]).fillna(0.0, ["fa"])
    # <= 60 rows, bounded by the grid: a global running sum on this table is safe.
    w = Window.orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    below = per.select(
        "j",
        F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n_below"),
        F.coalesce(F.sum("fa").over(w), F.lit(0.0)).alias("fa_below"),
        F.coalesce(F.sum("legit").over(w), F.lit(0)).alias("legit_below"),
        F.sum("n").over(Window.partitionBy(F.lit(0))).alias("n_total"),
        F.sum("legit").over(Window.partitionBy(F.lit(0))).alias("legit_total"),
    )
    # S(t_j) = aggregates over rows with p < t_j  ==  rows in buckets < j+1 ... i.e. below(j + 1)
    idx = {t: i + 1 for i, t in enumerate(thresholds)}
    grid = spark.createDataFrame(
        [(o, r, b, idx[r], idx[b]) for o, r, b in pairs], "ord int, review double, block double, jr int, jb int")
    r = below.select(*(F.col(c).alias(f"r_{c}") for c in below.columns))
    b = below.select(*(F.col(c).alias(f"b_{c}") for c in below.columns))
    priced = grid.join(F.broadcast(r), F.col("jr") == F.col("r_j")).join(F.broadcast(b), F.col("jb") == F.col("b_j"))
    review_n = F.col("b_n_below") - F.col("r_n_below")
    cost = (
        F.col("r_fa_below")
        + (F.col("b_fa_below") - F.col("r_fa_below")) * (1 - cfg.review_catch_rate)
        + (F.col("b_legit_total") - F.col("b_legit_below")) * cfg.false_positive_cost
        + review_n * cfg.review_cost
    )
    rate = review_n / F.greatest(F.col("b_n_total"), F.lit(1))
    feasible = priced.select("ord", "review", "block", cost.alias("cost"), rate.alias("rate")).where(
        F.col("rate") <= cfg.max_review_rate)
    best = feasible.agg(F.min_by(F.struct("review", "block", "cost"), F.struct("cost", "ord")).alias("x"))
    return best.select(
        F.coalesce(F.round("x.review", 2), F.lit(C.REVIEW_THRESHOLD)).alias("review_threshold"),
        F.coalesce(F.round("x.block", 2), F.lit(C.BLOCK_THRESHOLD)).alias("block_threshold"),
        F.coalesce(F.col("x.cost"), F.lit(float("inf"))).alias("expected_cost"),
    )


def threshold_metrics(df: DataFrame, threshold: float | Column) -> DataFrame:
    """Precision, recall, f1 (0 on zero division), FPR, FNR at ``probability >= threshold``."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    pred = F.col("probability") >= thr
    y = F.col("label") == 1
    c = df.agg(
        F.count(F.when(pred & y, 1)).alias("tp"), F.count(F.when(pred & ~y, 1)).alias("fp"),
        F.count(F.when(~pred & y, 1)).alias("fn"), F.count(F.when(~pred & ~y, 1)).alias("tn"),
    )
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0,
                2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0)
    return c.select(
        prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
        (F.col("fp") / F.greatest(F.col("fp") + F.col("tn"), F.lit(1))).alias("false_positive_rate"),
        (F.col("fn") / F.greatest(F.col("fn") + F.col("tp"), F.lit(1))).alias("false_negative_rate"),
    )


def ranking_metrics(df: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Average precision (step sum, tied scores grouped) and ROC AUC (ties count half).

    Group by score, global prefix sums (H1) in descending-score order, then one
    aggregate.  One row: pr_auc, roc_auc.
    """
    g = df.groupBy(F.col("probability").alias("s")).agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("pos"),
        F.count(F.when(F.col("label") == 0, 1)).alias("neg"),
    ).withColumn("k", -F.col("s"))
    # descending score: cum = rows with score >= s; totals come with the bucket totals
    cum, (P, N) = prefix_sums_with_totals(g, "k", ["pos", "neg"], n_buckets)
    P, N = int(P or 0), int(N or 0)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    precision = tp / (tp + fp)
    ap_term = F.col("pos") / F.lit(float(max(P, 1))) * precision
    # negatives strictly below s = N - cum_neg ; AUC numerator = sum pos * (neg_below + neg_at / 2)
    auc_term = F.col("pos") * ((F.lit(N) - F.col("cum_neg")) + F.col("neg") / 2.0)
    out = cum.agg(F.sum(ap_term).alias("ap"), F.sum(auc_term).alias("auc_num"))
    return out.select(
        (F.when(F.lit(P) > 0, F.col("ap")).otherwise(F.lit(float("nan")))).alias("pr_auc"),
        (F.when(F.lit(P * N) > 0, F.col("auc_num") / F.lit(float(max(P * N, 1)))).otherwise(F.lit(float("nan"))))
        .alias("roc_auc"),
    )


def compare_reports(champion: DataFrame, challenger: DataFrame) -> DataFrame:
    """Promotion gates (recommend only, never automatic).

    Each input is a one-row report with model_version, test_expected_cost and
    test_pr_auc / test_recall (numeric columns are required: a non-numeric
    column raises TypeError).
    """
    for df in (champion, challenger):
        for c in ("test_expected_cost", "test_pr_auc", "test_recall"):
            typ = dict(df.dtypes).get(c)
            if typ not in ("double", "float", "int", "bigint", "smallint", "tinyint") and not str(typ).startswith(
                    "decimal"):
                raise TypeError(f"{c} must be numeric")
    cols = ["model_version", "test_expected_cost", "test_pr_auc", "test_recall"]

    def tagged(df: DataFrame, role: str) -> DataFrame:
        return df.select(F.lit(role).alias("_role"), F.col("model_version").cast("string").alias("model_version"),
                         *[F.col(c).cast("double").alias(c) for c in cols[1:]])

    both = tagged(champion, "champion").unionByName(tagged(challenger, "challenger"))
    # one row per side: pivot by a conditional aggregate instead of a join
    j = both.agg(*[F.max(F.when(F.col("_role") == role, F.col(c))).alias(f"{role}_{c}")
                   for role in ("champion", "challenger") for c in cols])
    gates = F.struct(
        (F.col("challenger_test_pr_auc") >= F.col("champion_test_pr_auc") - C.GATE_PR_AUC_TOLERANCE).alias("pr_auc"),
        (F.col("challenger_test_recall") >= F.col("champion_test_recall") - C.GATE_RECALL_TOLERANCE).alias("recall"),
        (F.col("challenger_test_expected_cost") <= F.col("champion_test_expected_cost")).alias("business_cost"),
    )
    return j.select(
        F.col("champion_model_version").alias("champion_version"),
        F.col("challenger_model_version").alias("challenger_version"),
        gates.alias("gates"),
    ).select(
        "champion_version", "challenger_version",
        F.col("gates.pr_auc").alias("gate_pr_auc"), F.col("gates.recall").alias("gate_recall"),
        F.col("gates.business_cost").alias("gate_business_cost"),
        (F.col("gates.pr_auc") & F.col("gates.recall") & F.col("gates.business_cost")).alias("promotion_recommended"),
        F.lit(False).alias("automatic_promotion"),
    )
