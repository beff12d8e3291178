"""Best-fit packing of token pieces into sequences by exact-complement hashing.

Only the histogram of piece lengths decides the packing, and it has at most ``capacity`` entries however many
documents there are.  On it, the longest length still available opens a pattern; the gap it leaves is looked up in an
index of the single, pair and triple sums of available lengths (``Sums``), and a combination that fills it exactly is
consumed under the availability counts, as many times at once as the counts allow.  Lengths that no combination
completes are packed best fit at the end.  Patterns are thereby few (each use exhausts a length), and every piece finds its place from its
rank among the pieces of its length.

Spark side: pieces are staged without their texts; ranks come from per-(length, bucket) counts, so a length that a
third of all pieces share is ranked in ``BUCKETS`` groups; the pattern table (bounded by the capacity, not by the
data) is broadcast and looked up by binary search.

Defined results: a null text is empty and gives one piece with the closing id alone; documents longer than the
capacity are cut into full pieces, the first piece taking the remainder; very long texts are encoded whole; pieces of
equal length are interchangeable, and ranked by (doc_id, piece, start, digest); repeated rows are packed each; null ids are
packed as any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskline.llm.bpe import UNUSUAL
from riskline.llm.common import Scratch, bound_batches, slices, tidy

CAPACITY = 2048
#: Groups in which pieces of one length are ranked.
BUCKETS = 256


class Tokens:
    """Ids of whole texts: the fast encoder of the same vocabulary, or the library itself for unusual text."""

    def __init__(self, path: str, ranks: str):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        # the fast encoder's pattern keeps a stack for long runs without a break
        if not UNUSUAL.search(text) and not _long_run(text):
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.library.no_truncation()
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


def _long_run(text: str, most: int = 20_000) -> bool:
    return len(text) > most and max(map(len, text.split(" "))) > most


@lru_cache(maxsize=2)
def tokens(path: str, ranks: str) -> Tokens:
    """Once per worker."""
    return Tokens(path, ranks)


def cuts(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``n`` tokens begin: only the first may be shorter than the capacity."""
    return [0] if n <= capacity else [*([0] if n % capacity else []), *range(n % capacity, n, capacity)]


def token_pieces(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of every whole text closed by ``end_id``: doc_id, piece, start, length, ids_crc32 (and ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            encode = tokens(path, ranks).ids
            rows, kept = [], []
            for at, text in enumerate(part.column("text").to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                starts = cuts(len(ids), capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    rows.append((at, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                    if with_ids:
                        kept.append(ids[a:b])
            n = np.array(rows, np.int64).reshape(-1, 5)
            columns = [part.column("doc_id").take(pa.array(n[:, 0])), pa.array(n[:, 1].astype(np.int32)), *(pa.array(n[:, i]) for i in (2, 3, 4))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(np.cumsum([0, *map(len, kept)]).astype(np.int32), np.concatenate(kept).astype(np.int32)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    bound_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


# -- the packing of a histogram -----------------------------------------------------------------------------


class Sums:
    """Index of the single, pair and triple sums of available lengths, kept under the availability counts.

    ``pair[s]`` is the shorter length of a pair that sums to s, ``triple[s]`` the longest length of a triple (0: none).
    Counts only fall, so an entry whose lengths have run out moves on to the next combination of its sum, upwards for
    pairs and downwards for triples, and never back: all lookups together pass each combination once.  What a filling
    tried in vain has moved is put back with its counts (``undo``).
    """

    def __init__(self, left: np.ndarray, most: int = 3):
        self.left, self.most = left, most
        self.pair, self.triple = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        self.moved: list[tuple[np.ndarray, int, int]] = []
        lengths = np.flatnonzero(left)
        for x in lengths.tolist() if most >= 2 else []:
            sums = x + lengths[lengths > x - (left[x] > 1)]
            sums = sums[sums < len(left)]
            self.pair[sums[self.pair[sums] == 0]] = x
        with_pair = np.flatnonzero(self.pair)
        for x in lengths[::-1].tolist() if most >= 3 else []:
            sums = x + with_pair[: np.searchsorted(with_pair, 2 * x, side="right")]  # the longest of three is at least a third
            sums = sums[sums < len(left)]
            self.triple[sums[self.triple[sums] == 0]] = x

    def _move(self, index: np.ndarray, s: int, to: int) -> None:
        if index[s] != to:
            self.moved.append((index, s, int(index[s])))
            index[s] = to

    def keep(self) -> None:
        """The combinations returned since the last call are consumed."""
        self.moved.clear()

    def undo(self) -> None:
        """They were not: their counts are back, and so are the entries."""
        for index, s, old in reversed(self.moved):
            index[s] = old
        self.moved.clear()

    def _first_pair(self, s: int, x: int) -> int:
        """Shorter length, from ``x`` on, of an available pair that sums to ``s``; 0 if there is none."""
        lo = np.arange(x, s // 2 + 1)
        fits = (self.left[lo] > 0) & (self.left[s - lo] > np.where(2 * lo == s, 1, 0))
        at = int(fits.argmax()) if len(lo) else 0
        return x + at if len(lo) and fits[at] else 0

    def pair_of(self, s: int) -> list[int] | None:
        x = int(self.pair[s])
        if x and (not self.left[x] or self.left[s - x] <= (2 * x == s)):
            x = self._first_pair(s, x)
            self._move(self.pair, s, x)
        return [s - x, x] if x else None

    def triple_of(self, s: int) -> list[int] | None:
        x = int(self.triple[s])
        while x:
            if self.left[x] and 0 < s - x <= 2 * x and (rest := self.pair_of(s - x)):
                if rest.count(x) < self.left[x]:
                    break
                # the pair needs the one that is left of x: another pair of that sum, without moving its entry
                self.left[x] -= 1
                other = self._first_pair(s - x, 1)
                self.left[x] += 1
                if other:
                    rest = [s - x - other, other]
                    break
            x = int(x - 1 - np.argmax(self.left[x - 1 : 0 : -1] > 0)) if x > 1 and self.left[1:x].any() else 0
            x = x if 3 * x >= s else 0
        self._move(self.triple, s, x)
        return [x, *rest] if x else None

    def filling(self, gap: int) -> list[int] | None:
        """Available lengths that fill ``gap`` exactly, as few as possible."""
        if self.most >= 1 and self.left[gap]:
            return [gap]
        return self.pair_of(gap) or self.triple_of(gap)


def _complement(left: np.ndarray, gap: int, most: int = 3) -> list[int] | None:
    """Up to ``most`` (three at most) available lengths that fill ``gap`` exactly, as few as possible."""
    return Sums(left, most).filling(gap)


Pattern = tuple[dict[int, int], int]


def _exact(left: np.ndarray, capacity: int, most: int) -> list[Pattern]:
    """Sequences that get exactly full, taken from ``left``, opened by ever shorter lengths.

    The gap is filled by a complement of at most ``most`` lengths, or, where there is none, by the longest that fits,
    after which the smaller gap is looked up again; a length that cannot be completed is left.
    """
    patterns, first, sums = [], capacity, Sums(left, most)
    while first:
        used: dict[int, int] = {}
        gap, found = capacity, [first] if left[first] else []
        while found:
            for x in found:
                used[x] = used.get(x, 0) + 1
                left[x] -= 1
            gap -= sum(found)
            found = (sums.filling(gap) or [int(x) + 1 for x in np.flatnonzero(left[1 : gap + 1] > 0)[-1:]]) if gap else []
        more = -1 if gap else min(int(left[x]) // k for x, k in used.items())
        for x, k in used.items():
            left[x] -= more * k
        if gap:
            sums.undo()
            first -= 1
        else:
            sums.keep()
            patterns.append((used, more + 1))
    return patterns


def _best_fit(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit, longest pieces first, for whole classes of equally filled sequences at once."""
    open_: dict[int, list[Pattern]] = {}
    for x in np.flatnonzero(left)[::-1].tolist():
        n = int(left[x])
        while n:
            gap = min((g for g, c in open_.items() if g >= x and c), default=capacity)
            each = gap // x
            used, copies = open_[gap].pop() if open_.get(gap) else ({}, -(-n // each))
            full = min(copies, n // each)
            for times, some in ((each, full), (n % each if full < copies else 0, 1)):
                if times and some:
                    open_.setdefault(gap - times * x, []).append((used | {x: times}, some))
                    n -= times * some
                    copies -= some
            if copies and used:
                open_.setdefault(gap, []).append((used, copies))
    return [p for c in open_.values() for p in c]


def pack_histogram(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns ({length: times}, copies) that use every piece once; ``counts[l]``: pieces of length l.

    First the patterns that fill a sequence exactly, then best fit for the residual lengths.  Complements of up to
    three, two or one lengths are tried, and the packing with the fewest sequences is taken.  Where that is above the
    lower bound, the last exact fillings (half of them at most) are given back to the residual if that saves a sequence.
    """
    tried: list[tuple[list[Pattern], list[Pattern]]] = []
    for most in (3, 2, 1):
        left = np.zeros(capacity + 1, np.int64)
        left[: len(counts)] = counts
        exact = _exact(left, capacity, most)
        tried.append((exact, _best_fit(left, capacity)))
    bound = -(-int((counts * np.arange(len(counts))).sum()) // capacity)
    if min(_sequences(exact + rest) for exact, rest in tried) > bound:
        tried = [_settle(exact, rest, bound, capacity) for exact, rest in tried]
    return min((exact + rest for exact, rest in tried), key=_sequences)


def _settle(exact: list[Pattern], rest: list[Pattern], bound: int, capacity: int) -> tuple[list[Pattern], list[Pattern]]:
    """The last exact fillings, at most half of them, given back to the residual while that saves a sequence."""
    back, most = 1, _sequences(exact) // 2
    while back <= most and _sequences(exact + rest) > bound:
        kept, left = _given_back(exact, rest, back, capacity)
        again = _best_fit(left, capacity)
        if _sequences(kept + again) < _sequences(exact + rest):
            exact, rest, most = kept, again, most - back
        else:
            back *= 2
    return exact, rest


def _sequences(patterns: list[Pattern]) -> int:
    return sum(copies for _, copies in patterns)


def _given_back(exact: list[Pattern], rest: list[Pattern], back: int, capacity: int) -> tuple[list[Pattern], np.ndarray]:
    """``exact`` without its last ``back`` sequences, and the counts of their pieces and of those in ``rest``."""
    kept, returned = list(exact), list(rest)
    while back:
        used, copies = kept.pop()
        some = min(back, copies)
        returned.append((used, some))
        if copies > some:
            kept.append((used, copies - some))
        back -= some
    left = np.zeros(capacity + 1, np.int64)
    for used, copies in returned:
        for x, times in used.items():
            left[x] += times * copies
    return kept, left


def _slots(patterns: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Sorted by (length, first rank): how the ranks of each length are dealt to sequences."""
    rows, taken, first = [], {}, 0
    for used, copies in patterns:
        offset = 0
        for x in sorted(used, reverse=True):
            rows.append((x, taken.get(x, 0), used[x], first, offset))
            taken[x] = taken.get(x, 0) + copies * used[x]
            offset += x * used[x]
        first += copies
    a = np.array(rows, np.int64).reshape(-1, 5)
    a = a[np.lexsort((a[:, 1], a[:, 0]))]
    return dict(zip(("length", "rank", "times", "first", "offset"), a.T, strict=True))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (doc_id, piece, start, length, ids_crc32)."""
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    staged = scratch.write(pieces, "pieces").withColumn("bucket_", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)).cast("int"))
    counts = scratch.write(staged.groupBy("length", "bucket_").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[r["length"]] = r["n"]
    slots = spark.sparkContext.broadcast(_slots(pack_histogram(histogram, capacity)))

    before = Window.partitionBy("length").orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "bucket_", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_"))
    inside = Window.partitionBy("length", "bucket_").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = staged.withColumn("rank_", F.row_number().over(inside) - 1).join(base, ["length", "bucket_"])
    ranked = ranked.select(*pieces.columns, (F.col("rank_") + F.col("base_")).alias("rank_"))

    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        key = s["length"] << 48 | s["rank"]
        for part in batches:
            length, rank = part.column("length").to_numpy(), part.column("rank_").to_numpy()
            at = np.searchsorted(key, length << 48 | rank, side="right") - 1
            r = rank - s["rank"][at]
            sequence = s["first"][at] + r // s["times"][at]
            offset = s["offset"][at] + r % s["times"][at] * length
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")
