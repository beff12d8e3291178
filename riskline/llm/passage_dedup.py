"""Removal of word passages repeated across documents, by prefix-partitioned suffix trees.

A word goes if it lies in a window of 13 words that also begins in a document with a smaller id.

1. Every window is known by its anchor, the smallest hash among its 6-word grams; equal windows have equal anchors.
   Consecutive windows of one anchor are a run: 13 to about 20 words, stored as two hashes and a place.  Anchors that
   only one document holds are left out by an aggregate and a semi-join.
2. Of equal runs the text is read once, from the smallest document that holds it; the text stands for all of them, and
   is in the trees twice if several documents hold it, for the smallest and for the largest one.
3. The suffixes of all texts (one per window) are divided into groups by prefixes: the suffixes around one
   anchor are one group, unless they are more than a task should hold.  Then they are dealt out by their own first words,
   by as many as make groups of that size; a prefix of 13 words is a window itself, whose smallest owner is a plain aggregate.
4. A task builds the subtrees of its groups, a bounded number of suffixes at a time.  Internal nodes at 13 words and
   below whose suffixes follow different words are the maximal repeats; each lowers the smallest owner of all windows
   inside its occurrences.  (A window's occurrences, made longer as far as they agree, are those of one maximal repeat;
   where a suffix was parted from its neighbours, all deep internal nodes count.)
5. The texts' windows are joined to all runs they stand for, and removed where the smallest owner is a smaller document.

Windows are judged on the input.  All steps are shuffled aggregates and joins, in which a run, an anchor or a window that a
third of all rows holds is summed up before the shuffle or is split by adaptive execution; a document's stretches
are gathered with the document.  Trees compare words; runs are equal if both hashes (64 bits each) are.

Defined results: null text has no words; rows without an id are kept whole and remove nothing; rows repeated under one
id do not remove from each other; very long texts are read whole, periodic ones in runs of at most 64 windows; ties do not
arise, as owners are ids; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import Scratch, slices, tidy
from riskline.llm.prefix_tree import BEGIN, deep_repeats
from riskline.llm.shingles import U, mix, prefix_sums, tables

#: Words of a window and of an anchor, most windows of a run, suffixes of a group and of a task's step.
WINDOW, GRAM, RUN, GROUP = 13, 6, 64, 1 << 16
#: Words of the prefixes by which larger groups are divided, in turn.
PREFIXES = (2, 4, 7, 10)
_rng = np.random.default_rng(1213)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_GRAM = _rng.integers(1, 2**63, GRAM, dtype=np.uint64) * U(2) + U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
RUNS = "h long, c long, doc_id long, tag long, start int, n int"
MARKS = "h long, c long, marks array<struct<first: int, n: int, owner: bigint>>"


# -- runs ---------------------------------------------------------------------------------------------------


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word, case kept."""
    raw = [t.encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    first, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    up, down = tables(len(data))
    s = prefix_sums(_BYTE[data], up)
    ends = np.cumsum([len(r) + 1 for r in raw])
    return mix((s[stop] - s[first]) * down[first] + (stop - first).astype(np.uint64)), np.searchsorted(ends, first, side="right")


def runs(texts: list[str]) -> dict[str, np.ndarray]:
    """Runs of all texts: anchor h, hash c of their words, text number, first word, n (windows)."""
    none = {k: np.zeros(0, np.int64) for k in ("h", "c", "text", "start", "n")}
    if not texts:
        return none
    word, text = word_hashes(texts)
    if len(word) < WINDOW:
        return none
    grams = np.zeros(len(word) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams += word[k : k + len(grams)] * _GRAM[k]
    low = mix(grams)
    width, reach = 1, WINDOW - GRAM + 1
    while width * 2 <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if reach > width:
        low = np.minimum(low[: -(reach - width)], low[reach - width :])
    inside = text[: len(low)] == text[WINDOW - 1 :]
    edge = np.ones(len(low), bool)
    edge[1:] = (low[1:] != low[:-1]) | (inside[1:] != inside[:-1]) | (text[1 : len(low)] != text[: len(low) - 1])
    first = np.flatnonzero(edge)
    n = np.diff(np.append(first, len(low)))
    first, n = first[inside[first]], n[inside[first]]
    cuts = -(-n // RUN)
    piece = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    first, n = np.repeat(first, cuts) + piece * RUN, np.minimum(np.repeat(n, cuts) - piece * RUN, RUN)
    up, down = tables(len(word) + 1)
    s = prefix_sums(word, up)
    c = mix((s[first + n + WINDOW - 1] - s[first]) * down[first] + n.astype(np.uint64))
    begin = np.searchsorted(text, np.arange(len(texts)))
    return {"h": low[first].view(np.int64), "c": c.view(np.int64), "text": text[first], "start": first - begin[text[first]], "n": n}


def cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1: the runs of documents (doc_id, tag, text)."""
    for part in slices(batches, "text"):
        r = runs(part.column("text").to_pylist())
        of_doc = pa.array(r["text"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(r["h"]), pa.array(r["c"]), part.column("doc_id").take(of_doc), part.column("tag").take(of_doc),
             pa.array(r["start"].astype(np.int32)), pa.array(r["n"].astype(np.int32))],
            ["h", "c", "doc_id", "tag", "start", "n"],
        )


def read_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: the words of the runs that a document was chosen for, joined by one space."""
    for part in slices(batches, "text"):
        out = {k: [] for k in ("h", "c", "lo", "hi", "n", "words")}
        for text, asked in zip(part.column("text").to_pylist(), part.column("asked").to_pylist(), strict=True):
            words = text.encode("utf-8").split()  # white space of bytes is that of the contract
            for a in asked:
                for k in ("h", "c", "lo", "hi", "n"):
                    out[k].append(a[k])
                out["words"].append(b" ".join(words[a["start"] : a["start"] + a["n"] + WINDOW - 1]).decode("utf-8"))
        kinds = {"n": pa.int32(), "words": pa.string()}
        yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))


# -- trees --------------------------------------------------------------------------------------------------


def _lowered(size: int, found) -> np.ndarray:
    """Smallest owner of every suffix's window, by the maximal repeats around it; the largest integer where there is none."""
    smallest = np.full(size, np.iinfo(np.int64).max)
    for length, sizes, suffix, low in found:
        windows = np.repeat(length - WINDOW + 1, sizes)
        owner = np.repeat(low, sizes)
        for step in range(int(windows.max(initial=0))):
            within = windows > step
            np.minimum.at(smallest, suffix[within] + step, owner[within])
    return smallest


def _word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of every word, words of every text)."""
    split = pc.split_pattern(texts, " ")
    flat = split.flatten().dictionary_encode().indices.to_numpy()
    return flat.astype(np.int64), pc.list_value_length(split).to_numpy().astype(np.int64)


def solve_groups(part: pa.RecordBatch) -> pa.RecordBatch:
    """Step 4 for whole groups of texts (h, c, lo, hi, n, words): the windows' smallest owners, where they repeat."""
    flat, length = _word_numbers(part.column("words"))
    lo, hi, n = (part.column(k).to_numpy().astype(np.int64) for k in ("lo", "hi", "n"))
    # a text that several documents hold is there twice
    copy = np.concatenate([np.arange(len(n)), np.flatnonzero(hi > lo)])
    owner = np.concatenate([lo, hi[hi > lo]])
    count = n[copy]
    text = np.repeat(copy, count)
    offset = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = (np.cumsum(length) - length)[text]
    before = np.where(offset > 0, flat[begin + offset - 1], BEGIN)
    smallest = _lowered(len(text), deep_repeats(flat, begin + offset, length[text] - offset, before, np.repeat(owner, count), WINDOW))
    # both copies of a text have the same nodes; the first ones stand for both
    own = int(n.sum())
    text, offset, smallest = text[:own], offset[:own], smallest[:own]
    edge = np.concatenate([[True], (text[1:] != text[:-1]) | (smallest[1:] != smallest[:-1])])
    first = np.flatnonzero(edge)
    size = np.diff(np.append(first, own))
    known = smallest[first] < np.iinfo(np.int64).max
    first, size = first[known], size[known]
    per_text = np.bincount(text[first], minlength=len(n))
    marks = pa.StructArray.from_arrays([pa.array(offset[first].astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(smallest[first])], ["first", "n", "owner"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)), marks)
    made = pa.RecordBatch.from_arrays([part.column("h"), part.column("c"), lists], ["h", "c", "marks"])
    return made.filter(pa.array(per_text > 0))


def solve_suffixes(part: pa.RecordBatch) -> pa.RecordBatch:
    """Step 4 for whole groups of single suffixes (h, c, place, lo, hi, words): marks of their texts.

    What precedes a suffix is in another group, which may have been divided further; so every deep internal node counts.
    """
    flat, length = _word_numbers(part.column("words"))
    lo, hi, place = (part.column(k).to_numpy().astype(np.int64) for k in ("lo", "hi", "place"))
    begin = np.cumsum(length) - length
    copy = np.concatenate([np.arange(len(lo)), np.flatnonzero(hi > lo)])
    owner = np.concatenate([lo, hi[hi > lo]])
    at, first, size, low = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for depth, sizes, suffix, smallest in deep_repeats(flat, begin[copy], length[copy], np.full(len(copy), BEGIN), owner, WINDOW):
        at.append(copy[suffix])
        first.append(place[copy[suffix]])
        size.append(np.repeat(depth - WINDOW + 1, sizes))
        low.append(np.repeat(smallest, sizes))
    at = pa.array(np.concatenate(at))
    marks = [pa.array(np.concatenate(first).astype(np.int32)), pa.array(np.concatenate(size).astype(np.int32)), pa.array(np.concatenate(low))]
    ends = pa.array(np.arange(len(at) + 1, dtype=np.int32))
    lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(marks, ["first", "n", "owner"]))
    return pa.RecordBatch.from_arrays([part.column("h").take(at), part.column("c").take(at), lists], ["h", "c", "marks"])


def by_group(solve, key: str, weight: str | None, most: int):
    """A ``mapInArrow`` function over rows sorted by group: whole groups at a time, about ``most`` suffixes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in (batch.slice(a, 4096) for a in range(0, batch.num_rows, 4096)):
                size += pc.sum(part.column(weight)).as_py() if weight else part.num_rows
                held.append(part)
                if size < most:
                    continue
                whole = pa.Table.from_batches(held).combine_chunks()
                keys = whole.column(key).combine_chunks()
                own = pc.equal(keys, keys[len(keys) - 1]).to_numpy(zero_copy_only=False)
                cut = int(own.argmax())  # the last group may go on
                if cut:
                    yield solve(whole.slice(0, cut).combine_chunks().to_batches()[0])
                    held = whole.slice(cut).combine_chunks().to_batches()
                    size = sum(pc.sum(b.column(weight)).as_py() if weight else b.num_rows for b in held)
        if size:
            yield solve(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return tidy(run)


def single_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts taken apart: a row (h, c, place, lo, hi, words) for every window."""
    for batch in batches:
        for part in (batch.slice(a, 512) for a in range(0, batch.num_rows, 512)):
            out = {k: [] for k in ("h", "c", "place", "lo", "hi", "words")}
            for h, c, lo, hi, n, text in zip(*(part.column(k).to_pylist() for k in ("h", "c", "lo", "hi", "n", "words")), strict=True):
                words = text.split(" ")
                for i in range(n):
                    for k, x in zip(out, (h, c, i, lo, hi, " ".join(words[i:])), strict=True):
                        out[k].append(x)
            kinds = {"place": pa.int32(), "words": pa.string()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))


def divided(scratch: Scratch, texts: DataFrame, group: int) -> DataFrame:
    """Marks of the texts whose anchor has more than ``group`` suffixes: prefixes grow until their groups are small."""
    rest = scratch.write(texts.mapInArrow(tidy(single_suffixes), "h long, c long, place int, lo long, hi long, words string"), "suffixes")
    found = []
    for n in PREFIXES:
        prefix = F.substring_index("words", " ", n)
        rest = rest.withColumn("prefix", prefix)
        large = scratch.write(rest.groupBy("prefix").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > group).select("prefix"), "large")
        small = rest.join(large, "prefix", "left_anti").repartition("prefix").sortWithinPartitions("prefix")
        found.append(small.mapInArrow(by_group(solve_suffixes, "prefix", None, group), MARKS))
        if large.isEmpty():
            break
        rest = rest.join(large, "prefix", "left_semi")
    else:
        # windows themselves: the node at 13 words holds all of them
        rest = rest.withColumn("prefix", F.substring_index("words", " ", WINDOW))
        nodes = rest.groupBy("prefix").agg(F.min("lo").alias("owner"), F.count(F.lit(1)).alias("size"), F.max("hi").alias("to"))
        nodes = nodes.where("size > 1 or to > owner")
        mark = F.struct(F.col("place").alias("first"), F.lit(1).alias("n"), F.col("owner").alias("owner"))
        found.append(rest.join(nodes, "prefix").select("h", "c", F.array(mark).alias("marks")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # a text has at most RUN windows, and a node for every depth of each
    return every.groupBy("h", "c").agg(F.flatten(F.collect_set("marks")).alias("marks"))


# -- the job ------------------------------------------------------------------------------------------------


def kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 5: documents without their removed words."""
    for part in slices(batches, "text"):
        n_words, n_removed, kept = [], [], []
        for text, removed in zip(part.column("text").to_pylist(), part.column("removed").to_pylist(), strict=True):
            words = text.encode("utf-8").split()
            if removed:
                step = np.zeros(len(words) + 1, np.int64)
                first = np.array([r["first"] for r in removed])
                np.add.at(step, first, 1)
                np.add.at(step, first + np.array([r["n"] for r in removed]) + WINDOW - 1, -1)
                gone = np.cumsum(step[:-1]) > 0
                left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            else:
                left = words
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def passage_dedup(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept (remaining words joined by one space) of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "passages")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    named = texts.where("doc_id is not null")
    found = scratch.write(named.select("doc_id", "tag", "text").mapInArrow(tidy(cut_runs), RUNS), "runs")
    anchors = found.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h")
    anchors = scratch.write(anchors, "anchors")
    shared = scratch.write(found.join(anchors, "h", "left_semi"), "shared")
    scratch.drop(found, anchors)

    place = F.struct("doc_id", "tag", "start", "n")
    chosen = shared.groupBy("h", "c").agg(F.min(place).alias("at"), F.max("doc_id").alias("hi"))
    chosen = chosen.select(F.col("at.doc_id").alias("doc_id"), F.col("at.tag").alias("tag"), F.struct("h", "c", F.col("at.doc_id").alias("lo"), "hi", "at.start", "at.n").alias("a"))
    asked = scratch.write(chosen.groupBy("doc_id", "tag").agg(F.collect_list("a").alias("asked")), "asked")
    # rows repeated under one id with one text give their runs twice
    once = named.dropDuplicates(["doc_id", "tag"]) if _repeated(named) else named
    fetched = once.join(asked, ["doc_id", "tag"]).select("text", "asked")
    strings = scratch.write(fetched.mapInArrow(tidy(read_texts), "h long, c long, lo long, hi long, n int, words string"), "texts")
    scratch.drop(asked)

    large = scratch.write(strings.groupBy("h").agg(F.sum("n").alias("size")).where(F.col("size") > group).select("h"), "large")
    many = not large.isEmpty()
    small = (strings.join(large, "h", "left_anti") if many else strings).repartition("h").sortWithinPartitions("h")
    marks = scratch.write(small.mapInArrow(by_group(solve_groups, "h", "n", group), MARKS), "marks")
    if many:
        marks = marks.unionByName(scratch.write(divided(scratch, strings.join(large, "h", "left_semi"), group), "more-marks"))

    hit = shared.join(marks, ["h", "c"]).select("doc_id", "tag", "start", F.explode("marks").alias("m")).where("m.owner < doc_id")
    hit = hit.groupBy("doc_id", "tag").agg(F.collect_set(F.struct((F.col("start") + F.col("m.first")).alias("first"), F.col("m.n").alias("n"))).alias("removed"))
    removed = scratch.write(hit, "removed")
    whole = texts.join(removed, ["doc_id", "tag"], "left").select("doc_id", "text", "removed")
    return whole.mapInArrow(tidy(kept_words), "doc_id long, n_words long, n_removed long, kept string")


def _repeated(named: DataFrame) -> bool:
    """Whether an id occurs with one text more than once."""
    return not named.groupBy("doc_id", "tag").count().where("count > 1").isEmpty()
