"""Near-duplicate grouping: SuperMinHash signatures, banding, exact verification, union-find.

A document is the set of its word shingles.  Equal sets are one class, whose representative is its smallest id; only
representatives go on.  Their signatures are cut into bands, and representatives with an equal band share a bucket.

* Star step: every bucket links its members to its smallest set (the pivot), so a bucket of n gives n - 1 pairs.  The
  pairs are verified on the full sets, the links are grouped by union-find.
* Rest step: buckets that still hold more than one group are solved inside tasks, in pairs of blocks whose shingles
  are bounded: pairs across groups, by falling steps of estimated similarity, are verified on the full sets unless a
  link found before has joined them; they are taken one document at a time and never listed.  No pair leaves the task but the links of the spanning forest.

So every pair that shares a band is either verified, already connected, or ruled out by size or by a signature
estimate more than four standard errors below the threshold.  With 32 bands of 4, a pair at the threshold of 0.75
shares no band with probability 6e-6, one at 0.8 with 5e-8.

Defined results: null, empty or white-space texts have no shingles, link with nothing and stay; a text with fewer than
five words is one shingle of all its words; rows with a null id get a null component and stay; rows repeated under one
id form one node (their links add up) and carry their own shingle count; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import Scratch, slices, stream, tidy
from riskline.llm.components import components
from riskline.llm.minhash import SLOTS, super_minhash
from riskline.llm.shingles import U, mix, shingle_sets

#: Bands of the signature, the threshold in percent, the lowest estimate that is verified, shingles of a block.
BANDS, PERCENT, ESTIMATE, BLOCK_SHINGLES = 32, 75, 0.58, 1 << 19
#: Estimates from which a block's pairs are taken, one pass each.
STEPS = (0.85, 0.7, ESTIMATE)
_SUM = np.random.default_rng(75).integers(1, 2**63, (3, SLOTS), dtype=np.uint64) * U(2) + U(1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), set_hash (16 bytes), bands (hashes), sig (one byte per slot) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", rows=500, size=1 << 21):
            hashes, sizes = shingle_sets(part.column("text").to_pylist())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sums = np.zeros((len(sizes), 2), np.uint64)
            for i in (0, 1):
                np.add.at(sums[:, i], owner, mix(hashes ^ _SUM[2, i]))
            sig = super_minhash(hashes, sizes)
            rows = SLOTS // BANDS
            bands = mix((sig * _SUM[0]).reshape(len(sizes), BANDS, rows).sum(axis=2) + np.arange(BANDS, dtype=np.uint64) * _SUM[1, 0])
            byte = mix(sig).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array([r.tobytes() for r in sums], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), pa.array(bands.view(np.int64).reshape(-1))),
                    pa.array([r.tobytes() for r in byte], pa.binary()),
                ],
                ["doc_id", "n", "set_hash", "bands", "sig"],
            )

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, n long, set_hash binary, bands array<bigint>, sig binary")


def shingle_bytes(docs: DataFrame) -> DataFrame:
    """doc_id and its sorted shingle hashes as bytes (``shingles``)."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, sizes = shingle_sets(part.column("text").to_pylist())
        ends = np.cumsum(sizes)
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([h.tobytes() for h in np.split(hashes, ends[:-1])], pa.binary())], ["doc_id", "shingles"])

    return stream(docs.select("doc_id", "text"), work, "doc_id long, shingles binary")


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have 100 * intersection >= PERCENT * union."""
    both = len(a) + len(b)
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    joined = np.concatenate([a, b])
    joined.sort(kind="stable")  # two sorted runs
    common = int((joined[1:] == joined[:-1]).sum())
    return 100 * common >= PERCENT * (both - common)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are alike."""
    rows = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
    rows = rows.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keep = [alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(part.column("sa"), part.column("sb"), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in part.columns[:2]], ["a", "b"])

    return rows.mapInArrow(tidy(run), "a long, b long")


def solve_block(table: pa.Table) -> list[tuple[int, int]]:
    """Links of a spanning forest between the groups of one block, or of two blocks of one bucket."""
    ids, root, block = (table.column(c).to_numpy() for c in ("doc_id", "root", "block"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in table.column("shingles").chunks for x in c]
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    band = int(table.column("band")[0].as_py())
    n = np.array([len(s) for s in sets], np.int64)
    cross = bool((block != block[0]).any())
    group, links, high = root.copy(), [], 2.0
    for lowest in STEPS:  # the more alike first, and no list of pairs: what is joined by then is not looked at again
        for i in range(len(ids)):
            j = np.arange(i + 1, len(ids))
            j = j[(group[j] != group[i]) & (100 * np.minimum(n[j], n[i]) >= PERCENT * np.maximum(n[j], n[i]))]
            if cross:
                j = j[block[j] != block[i]]
            if not len(j):
                continue
            estimate = (sig[j] == sig[i]).mean(axis=1)
            near = (estimate >= lowest) & (estimate < high)
            j, estimate = j[near], estimate[near]
            # a pair belongs to the first band that it shares
            first = ~(bands[j, :band] == bands[i, :band]).any(axis=1)
            for k in j[first][np.argsort(-estimate[first], kind="stable")].tolist():
                if group[k] != group[i] and alike(sets[i], sets[k]):
                    links.append((int(ids[i]), int(ids[k])))
                    group[group == group[k]] = group[i]
        high = lowest
    return links


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    prints = scratch.write(fingerprints(docs), "prints")
    named = prints.where("n > 0 and doc_id is not null")
    classes = scratch.write(named.groupBy("set_hash").agg(F.min("doc_id").alias("rep")), "classes")
    # links inside a class, and between the texts of one repeated id
    same = named.select("doc_id", "set_hash").join(classes, "set_hash").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    reps = scratch.write(named.join(classes.select("set_hash", F.col("rep").alias("doc_id")), ["set_hash", "doc_id"]).dropDuplicates(["set_hash"]).drop("set_hash"), "representatives")
    members = reps.select("doc_id", "n", F.posexplode("bands").alias("band", "key"))
    pivot = F.min(F.struct("n", "doc_id"))
    buckets = scratch.write(
        members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), pivot.alias("p"), F.sum("n").alias("shingles")).where("size > 1")
        .select("band", "key", "size", "shingles", F.col("p.n").alias("pn"), F.col("p.doc_id").alias("pivot")),
        "buckets",
    )
    shared = scratch.write(members.join(buckets, ["band", "key"]).select("band", "key", "doc_id", "n", "size", "shingles", "pn", "pivot"), "shared")
    pairs = shared.where(f"doc_id <> pivot and 100 * pn >= {PERCENT} * n").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()

    wanted = shared.select("doc_id").distinct()
    sets = shingle_bytes(docs.select("doc_id", "text").where("doc_id is not null").join(wanted, "doc_id"))
    sets = scratch.write(sets.where("length(shingles) > 0"), "sets")
    star = scratch.write(verify(pairs, sets), "star-links")
    grouped = components(star, scratch)

    rooted = shared.join(grouped.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    rooted = scratch.write(rooted.select("band", "key", "doc_id", "size", "shingles", "root"), "rooted")
    apart = rooted.where("size > 2").groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band", "key")
    parts = F.ceil(F.col("shingles") / F.lit(BLOCK_SHINGLES)).cast("int")
    open_ = rooted.join(apart, ["band", "key"]).select("band", "key", "doc_id", "root", parts.alias("parts"), F.pmod(F.xxhash64("doc_id"), parts).cast("int").alias("block"))
    # a member meets every block of its bucket; a pair of blocks is one group
    meet = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    meet = meet.select("band", "key", "doc_id", "root", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    meet = meet.join(sets, "doc_id").join(reps.select("doc_id", "sig", "bands"), "doc_id")

    def solve(table: pa.Table) -> pa.Table:
        a = np.array(solve_block(table), np.int64).reshape(-1, 2)
        return pa.table({"a": a[:, 0], "b": a[:, 1]})

    rest = scratch.write(meet.groupBy("band", "key", "lo", "hi").applyInArrow(solve, "a long, b long"), "rest-links")
    final = components(star.union(rest).union(same), scratch)
    out = prints.select("doc_id", "n").join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("root", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
