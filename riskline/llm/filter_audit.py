"""Audit of filters that overlap: what each removes alone, first, last and in every order.

Four filters look at one text; the fifth (E) asks whether a row with a smaller id holds the same text.  E is an
existential self-join: every row is semi-joined on hash, exact text and a smaller doc_id.  Its right side holds one row
per distinct text, the smallest id, pre-aggregated before the shuffle, so a text that a third of all rows share is a
few rows there; its left side is an ordinary shuffled join that adaptive execution splits where a text is hot.  The ids
that fail E are united with those that fail the other filters, the bits of an id and text are summed up, labels are
joined to the failing ids alone, and what remains is one row per part and combination of bits (32 at most).  All orders
are counted from these: a filter meets at most 16 sets of earlier filters, so 80 counts per part serve all 120 orders.
No text travels except for E, and nothing is collected.

Defined results: null text counts as empty; a null source is the part '', as an empty one; rows without an id fail the
other filters as any row, never E, and make no other row fail it; rows repeated under one id are documents of their own
and do not make each other fail E; a document with several label rows is good (toxic) if one of them says so, labels
without an id count for none; very long texts are read whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.llm.common import SPACE_CLASS

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
SYMBOLS = r"[#$%&*|]"
#: The bit of every filter; E's is the last.
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, f"[{SPACE_CLASS}]+"), "")
    # the array is bound once: Spark would otherwise cut the text anew for each use
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {
        "A": counts["n"] < LEAST_WORDS,
        "B": counts["distinct"] * 100 < counts["n"] * LEAST_DISTINCT,
        "C": capitals.cast("long") * 100 > F.char_length(text).cast("long") * MOST_CAPITALS,
        "D": text.rlike(SYMBOLS),
    }
    bits = F.lit(0)
    for f, failed in fails.items():
        bits = bits + F.when(failed, BIT[f]).otherwise(0)
    return bits


def repeats(docs: DataFrame) -> DataFrame:
    """Rows whose text a row with a smaller id holds too."""
    left = docs.withColumn("h", F.xxhash64("text"))
    least = docs.groupBy(F.xxhash64("text").alias("of_h"), F.col("text").alias("of_text")).agg(F.min("doc_id").alias("least"))
    same = (F.col("h") == F.col("of_h")) & (F.col("text") == F.col("of_text")) & (F.col("least") < F.col("doc_id"))
    return left.join(least, same, "left_semi").drop("h")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents of every part by the filters they fail."""
    texts = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    alone = texts.select("doc_id", "part", text_failures(F.col("text")).alias("bits"), F.lit(1).cast("long").alias("n"))
    again = repeats(texts).select("doc_id", "part", text_failures(F.col("text")).alias("bits"))
    # a document that fails E moves from its other bits to those with E's
    moved = F.array(F.struct((F.col("bits") + BIT["E"]).alias("bits"), F.lit(1).cast("long").alias("n")), F.struct(F.col("bits").alias("bits"), F.lit(-1).cast("long").alias("n")))
    again = again.select("doc_id", "part", F.explode(moved).alias("x")).select("doc_id", "part", "x.bits", "x.n")
    every = alone.unionByName(again)
    # only failing documents need their id, for the labels; the others are one row per part
    summed = every.groupBy(F.when(F.col("bits") > 0, F.col("doc_id")).alias("doc_id"), "part", "bits").agg(F.sum("n").alias("n")).where("n > 0")
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    return summed.join(known, "doc_id", "left").groupBy("part", "bits").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.col("n") * F.col("good")), F.lit(0).cast("long")).alias("good"),
        F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0).cast("long")).alias("toxic"),
    )


def _cases() -> Column:
    """Every (filter bit, bits of the filters before it, the orders in which they are, step)."""
    orders: dict[tuple[int, int], list[str]] = {}
    for order in map("".join, permutations(FILTERS)):
        for step, f in enumerate(order):
            orders.setdefault((BIT[f], sum(BIT[g] for g in order[:step])), []).append(order)
    return F.array(*[
        F.struct(F.lit(own).alias("own"), F.lit(before).alias("before"), F.lit(before.bit_count() + 1).alias("step"), F.array(*map(F.lit, found)).alias("orders"))
        for (own, before), found in orders.items()
    ])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, with the counts of that step."""
    found = combinations(docs, labels).withColumn("case", F.explode(_cases()))
    own, before = F.col("bits").bitwiseAND(F.col("case.own")) > 0, F.col("bits").bitwiseAND(F.col("case.before")) > 0

    def total(value: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0)).cast("long")

    counted = found.groupBy("part", "case.own", "case.before", "case.step", "case.orders").agg(
        total("n", ~own & ~before).alias("kept"),
        total("n", own & ~before).alias("removed"),
        total("n", own & before).alias("redundant"),
        total("n", F.col("bits") == F.col("case.own")).alias("unique_fails"),
        total("good", own & ~before).alias("good_lost"),
        total("toxic", own & ~before).alias("toxic_lost"),
    )
    of_filter = Window.partitionBy("part", "own")
    counted = counted.withColumn("shapley", F.sum(F.col("removed") * F.size("orders")).over(of_filter))
    return counted.select(
        "part", F.explode("orders").alias("filter_order"), "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
