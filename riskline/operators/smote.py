"""Synthetic minority rows between a minority row and one of its nearest minority neighbours.

Neighbours are exact (``operators.neighbours``) over standardised features.  A value counts as the integer
floor(value * STEPS + 1/2), its mean and deviation come from exact sums over the whole slice, and a standardised value is
rounded to 1 / UNITS, so distances are integers and any engine finds the same neighbours.

Every synthetic row draws a base row, one of its neighbours and a place between them from the hash of its number, with
replacement.  There are as many as the minority lacks; none if it has fewer than two rows or is no minority.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators.neighbours import NeighbourSearch
from riskline.operators.ordering import global_index, hash_rank

NEIGHBOURS = 5
#: Steps of a feature value (a power of two, so that no cent's fraction lies between two steps), units of a deviation,
#: and places between two rows.
STEPS, UNITS, PLACES = 8192, 4096, 1 << 20


def stepped(value: Column) -> Column:
    return F.floor(value * STEPS + 0.5)


def standardised(rows: DataFrame, over: DataFrame, features: list[str]) -> Column:
    """The features of ``rows`` in units of their deviation over ``over``, as an array of integers."""
    whole = [stepped(F.col(f)).cast("decimal(18,0)") for f in features]
    sums = over.agg(F.count(F.lit(1)).alias("n"), *[F.sum(q).cast("double").alias(f"s{i}") for i, q in enumerate(whole)],
                    *[F.sum(q * q).cast("double").alias(f"q{i}") for i, q in enumerate(whole)]).first()
    out = []
    for i, f in enumerate(features):
        mean = (sums[f"s{i}"] or 0.0) / max(sums["n"], 1)
        spread = math.sqrt(max((sums[f"q{i}"] or 0.0) / max(sums["n"], 1) - mean * mean, 0.0))
        out.append(F.floor((stepped(F.col(f)) - mean) / spread * UNITS + 0.5) if spread else F.lit(0).cast("long"))
    return F.array(*out)


def minority_search(train: DataFrame, features: list[str], k: int = NEIGHBOURS) -> NeighbourSearch:
    minority = train.where(F.col("label") == 1)
    return NeighbourSearch(minority.select(F.col("transaction_id").alias("id"), standardised(minority, train, features).alias("v")), k)


def smote_rows(train: DataFrame, features: list[str] = C.MODEL_FEATURES, k: int = NEIGHBOURS, seed: int = 42) -> DataFrame:
    """(row, base_id, neighbour_id, features) of the synthetic rows that a training slice lacks."""
    spark = train.sparkSession
    counted = train.agg(F.count(F.when(F.col("label") == 1, 1)).alias("few"), F.count(F.when(F.col("label") == 0, 1)).alias("many")).first()
    few, lacking = counted["few"], counted["many"] - counted["few"] if counted["few"] > 1 else 0
    near = min(k, few - 1)
    minority = train.where(F.col("label") == 1).select("transaction_id", "us", *features)
    if lacking <= 0:
        names = ["transaction_id", *features]
        return minority.where("false").select(F.lit(0).cast("long").alias("row"), F.col("transaction_id").alias("base_id"),
                                              F.col("transaction_id").alias("neighbour_id"), *names[1:])
    ranked = global_index(minority, "us", ["transaction_id"], name="rank").select(
        F.col("transaction_id").alias("base_id"), "rank", F.struct(*features).alias("base"))
    found = minority_search(train, features, k).neighbours().select(F.col("id").alias("base_id"), F.posexplode("neighbours").alias("place", "n"))
    other = minority.select(F.col("transaction_id").alias("neighbour_id"), F.struct(*features).alias("other"))
    pairs = found.select("base_id", F.col("place").cast("long").alias("place"), F.col("n.id").alias("neighbour_id")).join(other, "neighbour_id").join(ranked, "base_id")
    drawn = F.pmod(hash_rank(F.col("id"), seed), F.lit(few * near))
    rows = spark.range(lacking).select(
        F.col("id").alias("row"), F.floor(drawn / F.lit(near)).alias("rank"), F.pmod(drawn, F.lit(near)).alias("place"),
        (F.pmod(hash_rank(F.col("id"), seed + 1), F.lit(PLACES)) / F.lit(PLACES)).alias("w"))
    mixed = [(F.col(f"base.{f}") + F.col("w") * (F.col(f"other.{f}") - F.col(f"base.{f}"))).alias(f) for f in features]
    return rows.join(pairs, ["rank", "place"]).select("row", "base_id", "neighbour_id", *mixed)


def smote(train: DataFrame, features: list[str] = C.MODEL_FEATURES, k: int = NEIGHBOURS, seed: int = 42) -> DataFrame:
    """The slice's features and label with the synthetic rows added: both classes have equally many."""
    made = smote_rows(train, features, k, seed).select(*features, F.lit(1).alias("label"))
    return train.select(*features, F.col("label").cast("int").alias("label")).unionByName(made)
