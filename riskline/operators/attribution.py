"""E02 permutation attribution (Shapley estimate) and E03 explanation of pending alerts.

For an alert x, a seeded feature order pi and a background row b, the model is
evaluated on the chain b -> ... -> x that switches features to x one at a time
in the order pi; the step differences are the per-feature contributions, and
their mean over permutations and background rows is phi.  Per background row
the contributions telescope to f(x) - f(b), so sum(phi) = f(x) - mean_b f(b)
exactly (tested).

Plan: each alert row is expanded by two constant-size literal arrays (the
P x (M + 1) permutation steps and at most ``max_background`` background rows), the model is
applied as columns (or a fitted pipeline), then two aggregations.  The volume
is alerts x P x (M + 1) x B and is partitioned by alert; no join, no driver loop.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline import constants as C

#: Default bound of the background rows, which are inlined into the plan.
BACKGROUND_ROWS = 200


def permutation_steps(n_features: int, permutations: int, seed: int = 42) -> list[tuple[int, int, int, list[int]]]:
    """(perm, step, feature switched at this step (-1 for step 0), mask) for seeded permutations."""
    rng = np.random.default_rng(seed)
    out = []
    for p in range(permutations):
        order = rng.permutation(n_features).tolist()
        for k in range(n_features + 1):
            mask = [0] * n_features
            for j in order[:k]:
                mask[j] = 1
            out.append((p, k, order[k - 1] if k else -1, mask))
    return out


def heuristic_model(cols: dict[str, Column]) -> Column:
    from riskline.functions.policy import heuristic_probability

    return heuristic_probability(cols["amount_vs_user_average"], cols["transactions_last_5m"], cols["new_device"],
                                 cols["new_country"], cols["impossible_travel"])


HEURISTIC_INPUTS = ["amount_vs_user_average", "transactions_last_5m", "new_device", "new_country",
                    "impossible_travel"]


def _background_array(background: DataFrame, features: list[str], max_background: int) -> Column:
    """The background rows as one literal array; more rows than allowed are an error, never cut."""
    rows = background.select(*features).limit(max_background + 1).collect()
    if len(rows) > max_background:
        raise ValueError(f"the background has more than max_background = {max_background} rows")
    return F.array(*[F.struct(F.lit(i).alias("bid"), *[F.lit(float(r[f] or 0.0)).alias(f) for f in features])
                     for i, r in enumerate(rows)])


def coalition_weights(m: int) -> list[list[float]]:
    """Per feature and coalition (bit mask): the factor of the coalition's value in the feature's Shapley value."""
    size_weight = [math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)]
    out = []
    for i in range(m):
        row = []
        for mask in range(1 << m):
            members = mask.bit_count()
            row.append(size_weight[members - 1] if mask >> i & 1 else -size_weight[members])
        out.append(row)
    return out


def exact_attribution(targets: DataFrame, background: DataFrame, features: list[str],
                      model: Callable[[dict[str, Column]], Column] | None = None, limit: int = C.REASON_LIMIT,
                      max_background: int = BACKGROUND_ROWS) -> DataFrame:
    """E02 without an estimate: the Shapley values over all 2 ** features coalitions.

    The value of a coalition is the mean of the model over the background rows, with the coalition's features taken
    from the target.  One aggregation per (target, coalition), one per target; nothing is joined.
    """
    m, fn = len(features), model or heuristic_model
    x = targets.select("transaction_id", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    wide = x.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << m) - 1))).alias("coalition")).select(
        "*", F.explode(_background_array(background, features, max_background)).alias("b"))
    mixed = {f: F.when(F.col("coalition").bitwiseAND(1 << j) != 0, F.col(f)).otherwise(F.col(f"b.{f}"))
             for j, f in enumerate(features)}
    value = wide.select("transaction_id", "coalition", fn(mixed).alias("f")).groupBy("transaction_id", "coalition").agg(
        F.avg("f").alias("value"))
    factor = [F.element_at(F.array(*[F.lit(w) for w in row]), F.col("coalition") + 1) for row in coalition_weights(m)]
    phi = value.groupBy("transaction_id").agg(*[F.sum(F.col("value") * c).alias(f) for f, c in zip(features, factor)])
    long = phi.select("transaction_id", F.explode(F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).alias("phi")) for f in features])).alias("e")).select(
        "transaction_id", "e.feature", "e.phi")
    rank = Window.partitionBy("transaction_id").orderBy(F.round(F.abs("phi"), 9).desc(), "feature")
    return long.withColumn("position", F.row_number().over(rank)).where(F.col("position") <= limit).select(
        "transaction_id", "position", "feature", F.round("phi", 6).alias("impact"),
        F.when(F.round("phi", 9) >= 0, F.lit("increases_risk")).otherwise(F.lit("decreases_risk")).alias("direction"),
        F.col("phi").alias("raw_phi"))


def permutation_attribution(targets: DataFrame, background: DataFrame, features: list[str],
                            model: Callable[[dict[str, Column]], Column] | None = None, pipeline=None,
                            permutations: int = 10, seed: int = 42, limit: int = C.REASON_LIMIT,
                            max_background: int = BACKGROUND_ROWS) -> DataFrame:
    """phi per (transaction_id, feature); top ``limit`` by |phi| kept, rounded to 6 places.

    For models of many features; ``exact_attribution`` needs no estimate where 2 ** features is small.
    ``max_background`` bounds the background, which travels inside the plan.

    ``model`` is a column function (features -> probability); ``pipeline`` a
    fitted Spark ML model whose P(label = 1) is used instead.
    """
    bg_arr = _background_array(background, features, max_background)
    m = len(features)
    steps = permutation_steps(m, permutations, seed)
    step_arr = F.array(*[F.struct(F.lit(p).alias("perm"), F.lit(k).alias("step"), F.lit(sw).alias("switched"),
                                  F.array(*[F.lit(v) for v in mask]).alias("mask")) for p, k, sw, mask in steps])
    x = targets.select("transaction_id", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    expanded = x.select("*", F.explode(step_arr).alias("s")).select("*", F.explode(bg_arr).alias("b"))
    mixed = {f: F.when(F.col("s.mask")[j] == 1, F.col(f)).otherwise(F.col(f"b.{f}"))
             for j, f in enumerate(features)}
    base = expanded.select("transaction_id", F.col("s.perm").alias("perm"), F.col("s.step").alias("step"),
                           F.col("s.switched").alias("switched"), *[c.alias(f"m_{f}") for f, c in mixed.items()])
    if pipeline is not None:
        from pyspark.ml.functions import vector_to_array

        renamed = base.select("transaction_id", "perm", "step", "switched",
                              *[F.col(f"m_{f}").alias(f) for f in features])
        evald = pipeline.transform(renamed).withColumn("f", vector_to_array("probability")[1])
    else:
        fn = model or heuristic_model
        evald = base.withColumn("f", fn({f: F.col(f"m_{f}") for f in features}))
    per_step = evald.groupBy("transaction_id", "perm", "step", "switched").agg(F.avg("f").alias("f"))
    w = Window.partitionBy("transaction_id", "perm").orderBy("step")  # M + 1 rows per partition
    contrib = per_step.withColumn("d", F.col("f") - F.lag("f").over(w)).where(F.col("step") > 0)
    names = F.array(*[F.lit(f) for f in features])
    phi = contrib.groupBy("transaction_id", "switched").agg(F.avg("d").alias("phi")).select(
        "transaction_id", F.element_at(names, F.col("switched") + 1).alias("feature"), "phi")
    rank = Window.partitionBy("transaction_id").orderBy(F.abs("phi").desc(), F.col("feature"))
    ranked = phi.withColumn("position", F.row_number().over(rank))
    return ranked.where(F.col("position") <= limit).select(
        "transaction_id", "position", "feature", F.round("phi", 6).alias("impact"),
        F.when(F.col("phi") >= 0, F.lit("increases_risk")).otherwise(F.lit("decreases_risk")).alias("direction"),
        F.col("phi").alias("raw_phi"))


def explain_pending(alerts: DataFrame, predictions: DataFrame, recomputed: DataFrame | None = None,
                    limit: int = C.REASON_LIMIT) -> DataFrame:
    """Explanation rows for alerts, from the stored snapshot, else from recomputed features.

    ``predictions`` carries ``feature_snapshot`` (nullable); ``recomputed`` holds
    freshly computed features (transaction_id + ONLINE_FEATURES) used only where
    the snapshot is null.  ``method`` states what was actually used.
    """
    from riskline.functions.reasons import reason_factors

    j = alerts.select("transaction_id").join(predictions.select("transaction_id", "feature_snapshot"),
                                             "transaction_id", "left")
    if recomputed is not None:
        rec = recomputed.select("transaction_id", F.struct(*[F.col(f) for f in C.ONLINE_FEATURES]).alias("_rec"))
        j = j.join(rec, "transaction_id", "left")
    else:
        j = j.withColumn("_rec", F.lit(None).cast(predictions.schema["feature_snapshot"].dataType))
    feats = F.coalesce(F.col("feature_snapshot"), F.col("_rec"))
    method = F.when(F.col("feature_snapshot").isNotNull(), F.lit("reason_codes:snapshot")).when(
        F.col("_rec").isNotNull(), F.lit("reason_codes:recomputed"))
    out = j.select("transaction_id", method.alias("method"),
                   reason_factors({f: feats[f] for f in C.ONLINE_FEATURES}, limit).alias("factors"))
    return out.select("transaction_id", "method", F.posexplode_outer("factors").alias("pos", "fac")).select(
        "transaction_id", "method", (F.col("pos") + 1).cast("long").alias("position"), F.col("fac.feature").alias("feature"),
        F.col("fac.impact").alias("impact"), F.col("fac.direction").alias("direction"))
