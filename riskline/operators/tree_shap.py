"""E02 for fitted tree ensembles: interventional Shapley values from the leaves' boxes, without model calls.

A coalition takes its features from a row, the others from a background row.  A leaf is reached if every interval on
its path holds for the side that its feature comes from.  So only the features matter on which the two rows part:
with a of them holding for the row alone and c for the background row alone, the leaf gives its value times
(a - 1)! c! / (a + c)! to each of the former and takes a! (c - 1)! / (a + c)! times it from each of the latter.  If an
interval holds for neither, the leaf is out of reach.

Background rows are summed up once per leaf and pattern of intervals that hold (background rows x leaves at
most, both of documented size); the rows to explain are joined to the patterns by leaf.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.functions.ensemble import Box, NodeTable, boxes


def _patterns(df: DataFrame, leaves: list[Box], keep: list[str]) -> DataFrame:
    """(keep, leaf, bits): which intervals of every leaf hold for a row; one row per leaf."""
    def bits(box: Box) -> Column:
        total = F.lit(0).cast("long")
        for j, (f, low, high) in enumerate(box.bounds):
            x = F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0))
            total = total + F.when((x > F.lit(low)) & (x <= F.lit(high)), F.lit(1 << j)).otherwise(F.lit(0)).cast("long")
        return total

    return df.select(*keep, F.posexplode(F.array(*[bits(b) for b in leaves])).alias("leaf", "bits"))


def leaf_table(spark, leaves: list[Box]) -> DataFrame:
    """(leaf, value, on): value of a leaf and the features of its intervals in the order of the bits."""
    return spark.createDataFrame([(i, b.value, [f for f, _, _ in b.bounds]) for i, b in enumerate(leaves)], "leaf int, value double, on array<string>")


def _weight(share: Column, own: Column, other: Column) -> Column:
    """(own - 1)! other! / (own + other)! times ``share``."""
    most = 25
    factorial = F.array(*[F.lit(float(math.factorial(i))) for i in range(most)])
    return share * factorial[own - 1] * factorial[other] / factorial[own + other]


def tree_shap(rows: DataFrame, background: DataFrame, table: NodeTable, id_col: str = "transaction_id") -> DataFrame:
    """(id, feature, phi) for every row and feature on whose value a leaf depends; phi sum to score less mean background score.

    Scores are the ensemble's mean ('mean') or sum before the logistic ('logistic').  Features without a difference have no row.
    """
    leaves = boxes(table)
    if any(len(b.bounds) > 24 for b in leaves):
        raise ValueError("a path has more features than the weights cover")
    size = background.count()
    there = _patterns(background, leaves, []).groupBy("leaf", F.col("bits").alias("back")).agg((F.count(F.lit(1)) / F.lit(float(max(size, 1)))).alias("share"))
    there = there.join(F.broadcast(leaf_table(rows.sparkSession, leaves)), "leaf")
    met = _patterns(rows, leaves, [id_col]).join(there, "leaf")
    whole = F.expr("shiftleft(1L, size(on)) - 1")
    mine = F.col("bits").bitwiseAND(F.bitwise_not("back"))
    theirs = F.col("back").bitwiseAND(F.bitwise_not("bits"))
    met = met.where((F.col("bits").bitwiseOR(F.col("back")) == whole) & (F.col("bits") != F.col("back")))
    met = met.select(id_col, "on", (F.col("value") * F.col("share")).alias("v"), mine.alias("mine"), theirs.alias("theirs"))
    met = met.withColumn("a", F.bit_count("mine")).withColumn("c", F.bit_count("theirs"))
    gain = F.when(F.col("a") > 0, _weight(F.col("v"), F.col("a"), F.col("c")))
    loss = F.when(F.col("c") > 0, -_weight(F.col("v"), F.col("c"), F.col("a")))
    parts = met.select(id_col, "mine", "theirs", gain.alias("gain"), loss.alias("loss"), F.posexplode("on").alias("j", "feature"))
    bit = F.expr("shiftleft(1L, j)")
    phi = F.when(F.col("mine").bitwiseAND(bit) != 0, F.col("gain")).when(F.col("theirs").bitwiseAND(bit) != 0, F.col("loss"))
    return parts.select(id_col, "feature", phi.alias("phi")).where("phi is not null").groupBy(id_col, "feature").agg(F.sum("phi").alias("phi"))
