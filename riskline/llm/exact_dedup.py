"""Exact deduplication with a heavy-hitter split.

Method: every text becomes the SHA-256 of its white-space-normalised form.  A Misra-Gries summary per input
partition (merged by adding counters, the ``heavy`` largest survive) names every digest that holds more than
``2 / (heavy + 1)`` of the rows.  The survivors are counted exactly; that verified table has at most ``heavy``
rows by construction and is broadcast, so copies of frequent texts are answered map-side and never meet in one
task.  What remains has no heavy key and goes through one ordinary shuffle on the digest.

Defined results: a null text counts as empty; rows with a null ``doc_id`` join their group but never become its
``keep_id`` unless the whole group has none (then ``keep_id`` is null and ``kept`` is true); a row repeated under
the same ``doc_id`` is counted each time and carries the same answer each time; an empty table gives no rows;
further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import SPACE_CLASS, Scratch

#: Counters of a Misra-Gries summary, and so the largest number of broadcast winners.
HEAVY = 128


def normalised(text):
    """White-space runs become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", " ")


def misra_gries(digests: Iterator[bytes], size: int) -> dict[bytes, int]:
    """Misra-Gries counters: every item with more than n / (size + 1) occurrences is among the keys."""
    counters: dict[bytes, int] = {}
    for d in digests:
        if d in counters:
            counters[d] += 1
        elif len(counters) < size:
            counters[d] = 1
        else:
            for k in [k for k, c in counters.items() if c == 1]:
                del counters[k]
            for k in counters:
                counters[k] -= 1
    return counters


def heavy_candidates(digests: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """At most ``heavy`` digests, among them all with more than 2 / (heavy + 1) of the rows (``digest``)."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = misra_gries((d for b in batches for d in b.column(0).to_pylist()), heavy)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(found.values(), pa.int64())], ["digest", "n"])

    merged = digests.select("digest").mapInArrow(summarise, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    # Added counters fall short of a count by at most n / (heavy + 1) and sum to at most n, so a digest with over
    # 2 / (heavy + 1) of the rows is above n / (heavy + 1), where at most ``heavy`` digests can be.
    return merged.where("n > 1").orderBy(F.desc("n"), "digest").limit(heavy).select("digest")


def exact_dedup(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    rows = scratch.write(docs.select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")), "digests")

    candidates = heavy_candidates(rows, heavy)
    winners = scratch.write(
        rows.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        "winners",
    )
    tagged = rows.join(F.broadcast(winners), "digest", "left")
    frequent = tagged.where(F.col("group_size").isNotNull())
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    ordinary = rest.join(groups, "digest")
    cols = [
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    ]
    return frequent.select(*cols).unionByName(ordinary.select(*cols))
