"""Removal of repeated byte strings across documents by a common-prefix interval tree, spread by minimizers.

A byte goes if it lies in a 50-byte string that also begins in a document with a smaller id.  Every 50-byte window
has a minimizer: the smallest hash among its 25-byte grams.  Equal windows have equal minimizers, so the corpus is
cut into runs (stretches of consecutive windows with one minimizer), and runs are dealt out by it (one bucket per partition):

1. Each input slice packs its runs into one row per bucket: minimizer, fingerprint of the run's text, document,
   place.  Equal runs are combined first, only those of the smallest document travel on; a minimizer that one slice
   holds in many different texts travels as a single mark.
2. A bucket combines equal runs again (all but the smallest document's are removed) and asks for the text of runs
   that share their minimizer with other texts.
3. The texts asked for, dealt out by minimizer, form enhanced suffix arrays.  A stack scan builds their interval
   tree and yields all maximal repeats (left-diverse intervals) with all occurrences and the smallest document; every
   window of an occurrence in a larger document is removed.
4. Minimizers with very many different texts (over ``GROUP_TEXTS``) skip the suffix array: their windows are dealt
   out by their own hash, so that no task holds all texts around one frequent string.
5. Removed stretches meet their document again, which is cut as a whole.

Windows are judged on the input.  Nothing is collected; rows of a bucket, of a minimizer group and of a document
bucket are bounded by the number of partitions and by the combining.  Equality of runs, and of the windows of step 4,
rests on two hashes: 48 bits and the bucket for the first (the minimizer, or the window's hash), 48 bits for the second
(of the run's text, or of the window by other byte values and another base).  The texts of step 3 are compared as bytes.

Defined results: null text counts as empty; rows with a null id are kept whole and remove nothing; rows repeated
under one id do not remove from each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.llm.common import Scratch, give_back, slices, tidy
from riskline.llm.shingles import U, mix, powers, prefix_sums, tables
from riskline.llm.suffix_array import maximal_repeats

#: Bytes of a match and of a gram; most windows of a run; texts of one minimizer in a slice before it travels as a
#: mark, and in a bucket before its windows are dealt out one by one; suffixes sorted and repeats marked at once.
MATCH, GRAM, RUN = 50, 25, 64
SLICE_TEXTS, GROUP_TEXTS, SORT, MARKS = 16, 2048, 1 << 16, 1 << 19
#: Text bytes that step 1 takes at once: its tables come to about 55 bytes for each.
SLICE = 1 << 20
#: Shares in which a task takes the minimizers of its bucket.
TURNS = 4
#: Kinds of packed rows: runs, removed stretches, texts asked for, the same window by window, texts.
RUNS, SPANS, ASK, ASK_WINDOWS, TEXTS = range(5)
PACKED = "kind int, part int, rows int, payload binary"
_BYTE = np.random.default_rng(50).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BYTE_2 = np.random.default_rng(51).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_POWERS_2 = powers(0xD1342543DE82EF95, MATCH)
_LOW48 = U((1 << 48) - 1)

_RUN_FIELDS = (("h4", "<u4"), ("h2", "<u2"), ("c4", "<u4"), ("c2", "<u2"), ("doc", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("n", "u1"))
_SPAN_FIELDS = (("doc", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("n", "<u4"))
_FIELDS = {RUNS: _RUN_FIELDS, SPANS: _SPAN_FIELDS, ASK: _SPAN_FIELDS, ASK_WINDOWS: _SPAN_FIELDS, TEXTS: (*_RUN_FIELDS[:2], *_SPAN_FIELDS)}


# -- packed rows --------------------------------------------------------------------------------------------


def pack(kind: int, t: dict[str, np.ndarray], tail: bytes = b"") -> bytes:
    return b"".join([t[f].astype(d).tobytes() for f, d in _FIELDS[kind]]) + tail


def unpack(kind: int, rows: int, payload: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    out, at = {}, 0
    for f, d in _FIELDS[kind]:
        out[f] = np.frombuffer(payload, d, rows, at)
        at += out[f].nbytes
    return out, payload[at:]


def join48(t: dict[str, np.ndarray], name: str) -> np.ndarray:
    return t[name + "4"].astype(np.uint64) | t[name + "2"].astype(np.uint64) << U(32)


def split48(t: dict[str, np.ndarray], name: str, x: np.ndarray) -> None:
    t[name + "4"], t[name + "2"] = x & U(0xFFFFFFFF), x >> U(32) & U(0xFFFF)


def take(t: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[at] for k, v in t.items()}


class Out:
    """Collects packed rows, split by part; what is removed or asked for makes one row per part and batch."""

    def __init__(self, parts: int):
        self.parts = parts
        self.rows: list[tuple[int, int, int, bytes]] = []
        self.held: dict[int, list[dict[str, np.ndarray]]] = {SPANS: [], ASK: [], ASK_WINDOWS: []}

    def deal(self, kind: int, t: dict[str, np.ndarray], part: np.ndarray) -> None:
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        for at in np.split(order, cuts):
            if len(at):
                self.rows.append((kind, int(part[at[0]]), len(at), pack(kind, take(t, at))))

    def hold(self, kind: int, t: dict[str, np.ndarray]) -> None:
        """Windows (doc, tag, start, n) that are removed (SPANS), or whose text is asked for."""
        if len(t["doc"]):
            self.held[kind].append({f: t[f].astype(d) for f, d in _SPAN_FIELDS})

    def _flush(self) -> None:
        for kind, found in self.held.items():
            if not found:
                continue
            t = {f: np.concatenate([x[f] for x in found]) for f, _ in _SPAN_FIELDS}
            found.clear()
            if kind == SPANS:
                t = joined(t)
            self.deal(kind, t, doc_part(t["doc"], self.parts))

    def batch(self) -> pa.RecordBatch:
        self._flush()
        kind, part, rows, payload = zip(*self.rows, strict=True) if self.rows else ((),) * 4
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(rows, pa.int32()), pa.array(payload, pa.binary())], ["kind", "part", "rows", "payload"])


def joined(t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Removed windows (doc, tag, start, n), joined where they touch."""
    order = np.lexsort((t["start"], t["tag"], t["doc"]))
    doc, tag, start, n = (t[k][order].astype(np.int64) for k in ("doc", "tag", "start", "n"))
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] != start[:-1] + n[:-1])
    first = np.flatnonzero(fresh)
    return {"doc": doc[first], "tag": tag[first], "start": start[first], "n": np.add.reduceat(n, first)}


def doc_part(doc: np.ndarray, parts: int) -> np.ndarray:
    """Document bucket of an id; ``doc_part_column`` is the same for Spark."""
    return ((doc ^ (doc >> 17) ^ (doc >> 31)) % parts).astype(np.int64)


def doc_part_column(doc: Column, parts: int) -> Column:
    return F.pmod(doc.bitwiseXOR(F.shiftright(doc, 17)).bitwiseXOR(F.shiftright(doc, 31)), F.lit(parts)).cast("int")


# -- windows and runs ---------------------------------------------------------------------------------------


def minimizers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer of every window, prefix sums, inverse powers) of one byte string of at least MATCH bytes."""
    up, down = tables(len(data) + 1)
    s = prefix_sums(_BYTE[data], up)
    low = mix((s[GRAM:] - s[:-GRAM]) * down[: len(s) - GRAM])
    width, reach = 1, MATCH - GRAM + 1
    while width * 2 <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if reach > width:
        low = np.minimum(low[: -(reach - width)], low[reach - width :])
    return low, s, down


def second_hash(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """48 bits of the MATCH bytes from each place in ``first``, by other byte values and another base than the minimizers'."""
    value = _BYTE_2[data]
    h = np.zeros(len(first), np.uint64)
    for k in range(MATCH):
        h += value[first + k] * _POWERS_2[k]
    return mix(h) & _LOW48


def runs(texts: list[bytes], parts: int) -> dict[str, np.ndarray]:
    """Runs of all texts: part, h, c (48 bits each), text number, start, n (windows)."""
    used = [(i, t) for i, t in enumerate(texts) if len(t) >= MATCH]
    none = np.zeros(0, np.int64)
    if not used:
        return {"part": none, "h": none.astype(np.uint64), "c": none.astype(np.uint64), "text": none, "start": none, "n": none}
    data = np.frombuffer(b"".join([t for _, t in used]), np.uint8)
    low, s, down = minimizers(data)
    length = np.array([len(t) for _, t in used], np.int64)
    begin = np.cumsum(length) - length
    edge = np.ones(len(low), bool)
    edge[1:] = low[1:] != low[:-1]
    edge[begin] = True
    # windows that would cross into the next text form runs of their own, which are dropped
    edge[np.minimum(begin + length - MATCH + 1, len(low) - 1)[:-1]] = True
    first = np.flatnonzero(edge)
    n = np.diff(np.append(first, len(low)))
    text = np.searchsorted(begin, first, side="right") - 1
    whole = first - begin[text] <= length[text] - MATCH
    first, n, text = first[whole], n[whole], text[whole]
    # long runs (periodic text) are cut
    cuts = -(-n // RUN)
    piece = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    first, n, text = np.repeat(first, cuts) + piece * RUN, np.minimum(np.repeat(n, cuts) - piece * RUN, RUN), np.repeat(text, cuts)
    h = low[first]
    c = mix((s[first + n + MATCH - 1] - s[first]) * down[first] + n.astype(np.uint64))
    number = np.array([i for i, _ in used], np.int64)
    return {"part": (h % U(parts)).astype(np.int64), "h": h // U(parts) & _LOW48, "c": c & _LOW48, "text": number[text], "start": first - begin[text], "n": n}


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group number of each ordered entry) by the keys, the first one leading."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    for k in keys:
        k = k[order]
        fresh[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(fresh)


def combine(h: np.ndarray, c: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal runs: (order by h, c, doc; whether a larger document's; number of the h group; of the (h, c) group)."""
    order = np.lexsort((doc, c, h))
    h, c, doc = h[order], c[order], doc[order]
    new_h, new_c = np.zeros(len(h), bool), np.zeros(len(h), bool)
    new_h[1:] = h[1:] != h[:-1]
    new_c[1:] = new_h[1:] | (c[1:] != c[:-1])
    group_h, group_c = np.cumsum(new_h), np.cumsum(new_c)
    head = np.flatnonzero(np.concatenate([[True], new_c[1:]])) if len(h) else np.zeros(0, np.int64)
    larger = doc > doc[head][group_c] if len(h) else np.zeros(0, bool)
    return order, larger, group_h, group_c


def texts_of(group_h: np.ndarray, group_c: np.ndarray) -> np.ndarray:
    """Number of different texts in the h group of every ordered entry."""
    if not len(group_h):
        return group_h
    fresh = np.ones(len(group_c), np.int64)
    fresh[1:] = group_c[1:] != group_c[:-1]
    return np.bincount(group_h, weights=fresh).astype(np.int64)[group_h]


def cut_slice(ids: np.ndarray, texts: list[bytes], out: Out) -> None:
    """Step 1 for the texts of one slice."""
    r = runs(texts, out.parts)
    tag = np.array([zlib.crc32(t) for t in texts], np.int64)
    t = {"doc": ids[r["text"]], "tag": tag[r["text"]], "start": r["start"], "n": r["n"]}
    order, larger, group_h, group_c = combine(r["h"] * U(out.parts) + r["part"].astype(np.uint64), r["c"], t["doc"])
    out.hold(SPANS, take(t, order[larger]))
    often = (texts_of(group_h, group_c) > SLICE_TEXTS) & ~larger
    asked = order[often]
    out.hold(ASK_WINDOWS, take(t, asked))
    split48(t, "h", r["h"])
    split48(t, "c", r["c"])
    rest = np.sort(order[~larger & ~often])  # in the order of the texts, which compresses well
    out.deal(RUNS, take(t, rest), r["part"][rest])
    if len(asked):
        marks = order[np.flatnonzero(often & np.concatenate([[True], group_h[1:] != group_h[:-1]]))]
        mark = take(t, marks)
        mark["n"] = np.zeros(len(marks), np.int64)  # a mark has no windows
        out.deal(RUNS, mark, r["part"][marks])


def cut_batches(batches: Iterator[pa.RecordBatch], out: Out) -> Iterator[pa.RecordBatch]:
    """Step 1 for Arrow batches of doc_id and text, slice by slice."""
    for part in slices(batches, "text", size=SLICE):
        cut_slice(part.column("doc_id").to_numpy().astype(np.int64), [x.encode("utf-8") for x in part.column("text").to_pylist()], out)
        yield out.batch()


def solve_runs(rows: list[tuple[int, int, bytes]], out: Out) -> None:
    """Step 2 for all rows (part, rows, payload) of kind RUNS that met in one task."""
    if not rows:
        return
    t: dict[str, list[np.ndarray]] = {k: [] for k in ("h", "c", "doc", "tag", "start", "n")}
    number: dict[int, int] = {}
    while rows:
        p, n, payload = rows.pop()
        x, _ = unpack(RUNS, n, payload)
        # 2 ** 16 buckets of a task at most are kept apart
        t["h"].append(join48(x, "h") | U(number.setdefault(p, len(number)) << 48))
        t["c"].append(join48(x, "c"))
        for k in ("doc", "tag", "start", "n"):
            t[k].append(x[k].copy())
    whole = {k: np.concatenate(t.pop(k)) for k in list(t)}
    for turn in range(TURNS):  # a share of the minimizers at a time
        _solve_runs(take(whole, np.flatnonzero(whole["h"] % U(TURNS) == turn)), out)


def _solve_runs(t: dict[str, np.ndarray], out: Out) -> None:
    t = {k: v if k in "hc" else v.astype(np.int64) for k, v in t.items()}
    mark = t["n"] == 0
    often = np.unique(t["h"][mark])
    t = take(t, ~mark)
    h, c = t.pop("h"), t.pop("c")
    order, larger, group_h, group_c = combine(h, c, t["doc"])
    out.hold(SPANS, take(t, order[larger]))
    n_texts = texts_of(group_h, group_c)
    kept = ~larger
    windows = kept & ((n_texts > GROUP_TEXTS) | np.isin(h[order], often))
    # texts of one document alone need no comparison
    doc = t["doc"][order]
    lone = np.zeros(len(doc), bool)
    if len(doc):
        low, high = np.full(group_h[-1] + 1, np.iinfo(np.int64).max), np.full(group_h[-1] + 1, np.iinfo(np.int64).min)
        np.minimum.at(low, group_h, doc)
        np.maximum.at(high, group_h, doc)
        lone = (low == high)[group_h]
    mixed = kept & ~windows & (n_texts > 1) & ~lone
    out.hold(ASK, take(t, order[mixed]))
    out.hold(ASK_WINDOWS, take(t, order[windows]))


def solve_texts(rows: list[tuple[int, int, bytes]], out: Out) -> None:
    """Step 3 for all rows of kind TEXTS that met in one task."""
    h, t, strings = [], [], []
    for part, n, payload in rows:
        x, blob = unpack(TEXTS, n, payload)
        ends = np.cumsum(x["n"].astype(np.int64) + MATCH - 1).tolist()
        strings += [blob[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        h.append(join48(x, "h") * U(out.parts) + U(part))
        t.append(x)
    if not strings:
        return
    t = {k: np.concatenate([x[k] for x in t]).astype(np.int64) for k in ("doc", "tag", "start", "n")}
    h = np.concatenate(h)
    order = np.argsort(h, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    size = np.cumsum(t["n"][order])
    at = 0
    while at < len(order):
        # whole minimizer groups, about SORT suffixes at once
        reach = int(np.searchsorted(size, (size[at - 1] if at else 0) + SORT, side="right"))
        later = begin[begin > at]
        stop = int(later[max(0, np.searchsorted(later, reach, side="right") - 1)]) if len(later) and later[0] <= reach else (int(later[0]) if len(later) else len(order))
        if reach >= len(order):
            stop = len(order)
        _solve_group(take(t, order[at:stop]), [strings[i] for i in order[at:stop]], out)
        at = stop


def _solve_group(t: dict[str, np.ndarray], strings: list[bytes], out: Out) -> None:
    number = np.repeat(np.arange(len(strings)), t["n"])
    offset = np.arange(len(number)) - np.repeat(np.cumsum(t["n"]) - t["n"], t["n"])
    own = t["doc"][number]
    smallest = own.copy()
    # a suffix of at least MATCH bytes and the window that it begins with have one number
    kept: list[tuple[int, np.ndarray, int]] = []
    marks = 0
    for repeat in maximal_repeats(strings, t["doc"], MATCH):
        kept.append(repeat)
        marks += len(repeat[1]) * (repeat[0] - MATCH + 1)
        if marks >= MARKS:
            _mark(kept, smallest)
            kept.clear()
            marks = 0
    _mark(kept, smallest)
    gone = smallest < own
    out.hold(SPANS, {"doc": own[gone], "tag": t["tag"][number][gone], "start": (t["start"][number] + offset)[gone], "n": np.ones(int(gone.sum()), np.int64)})


def _mark(repeats: list[tuple[int, np.ndarray, int]], smallest: np.ndarray) -> None:
    """Lower ``smallest`` at every window inside every occurrence of the repeats (length, suffixes, smallest owner)."""
    if not repeats:
        return
    sizes = np.array([len(found) for _, found, _ in repeats])
    windows = np.repeat([length - MATCH + 1 for length, _, _ in repeats], sizes)
    first = np.repeat(np.concatenate([found for _, found, _ in repeats]), windows)
    step = np.arange(len(first)) - np.repeat(np.cumsum(windows) - windows, windows)
    np.minimum.at(smallest, first + step, np.repeat(np.repeat([low for _, _, low in repeats], sizes), windows))


def fetch(asked: list[tuple[int, int, bytes]], texts: dict[tuple[int, int], bytes], out: Out) -> None:
    """Between steps 2 and 3: the texts of ASK and ASK_WINDOWS rows (kind, rows, payload) of one document bucket."""
    for kind in (ASK, ASK_WINDOWS):
        found = [unpack(kind, n, b)[0] for k, n, b in asked if k == kind]
        if not found:
            continue
        t = {k: np.concatenate([x[k] for x in found]).astype(np.int64) for k in ("doc", "tag", "start", "n")}
        strings = [texts[d, g][a : a + n + MATCH - 1] for d, g, a, n in zip(*(t[k].tolist() for k in ("doc", "tag", "start", "n")), strict=True)]
        data = np.frombuffer(b"".join(strings), np.uint8)
        length = t["n"] + MATCH - 1
        begin = np.cumsum(length) - length
        low, s, down = minimizers(data)
        if kind == ASK:
            h = low[begin]
            part = (h % U(out.parts)).astype(np.int64)
            split48(t, "h", h // U(out.parts) & _LOW48)
            order = np.argsort(part, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                out.rows.append((TEXTS, int(part[at[0]]), len(at), pack(TEXTS, take(t, at), b"".join([strings[i] for i in at]))))
        else:
            number = np.repeat(np.arange(len(strings)), t["n"])
            offset = np.arange(len(number)) - np.repeat(np.cumsum(t["n"]) - t["n"], t["n"])
            first = begin[number] + offset
            h = mix((s[first + MATCH] - s[first]) * down[first])
            w = {"doc": t["doc"][number], "tag": t["tag"][number], "start": t["start"][number] + offset, "n": np.ones(len(number), np.int64)}
            c = second_hash(data, first)
            order, larger, _, _ = combine(h, c, w["doc"])
            out.hold(SPANS, take(w, order[larger]))
            kept = order[~larger]
            w, h = take(w, kept), h[kept]
            split48(w, "h", h // U(out.parts) & _LOW48)
            split48(w, "c", c[kept])
            out.deal(RUNS, w, (h % U(out.parts)).astype(np.int64))


def cut(text: bytes, start: np.ndarray, n: np.ndarray) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed stretches [begin, end) and the remaining bytes, given removed windows."""
    order = np.argsort(start, kind="stable")
    spans: list[list[int]] = []
    for a, b in zip(start[order].tolist(), (start + n + MATCH - 1)[order].tolist(), strict=True):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    edges = [0, *(x for s in spans for x in s), len(text)]
    return [(a, b) for a, b in spans], b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def decode_texts(kept: pa.Array) -> pa.Array:
    """Remaining bytes as text; the bytes of a character that was cut apart go."""
    return pa.array([None if x is None else x.decode("utf-8", errors="ignore") for x in kept.to_pylist()], pa.string())


def even_keys(spark, parts: int) -> list[int]:
    """One integer per hash partition, so that ``parts`` parts fill as many partitions with one part each."""
    cell = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts))
    found = spark.range(64 * parts + 64).groupBy(cell.alias("cell")).agg(F.min("id").alias("id")).collect()
    keys = {r["cell"]: int(r["id"]) for r in found}
    return [keys.get(c, c) for c in range(parts)]


# -- the job ------------------------------------------------------------------------------------------------


def suffix_dedup(docs: DataFrame, carry: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, spans (begin and end of removed bytes), kept (remaining bytes) of every row of ``docs``.

    ``carry`` names further columns, which come back as the fields of a struct ``carried``.  ``as_text`` returns ``kept``
    as text (``decode_texts``), made where documents are cut: a function of its own would be a second Python process a task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-dedup")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deal_key = F.element_at(F.array(*[F.lit(k) for k in even_keys(spark, parts)]), F.col("part") + 1)
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("int")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), carried.alias("carried"))
    named = texts.where("doc_id is not null")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from cut_batches(batches, Out(parts))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, found = Out(parts), {RUNS: [], TEXTS: []}
        for b in batches:
            through = pc.is_in(b.column("kind"), pa.array([SPANS, ASK, ASK_WINDOWS], pa.int32()))
            yield b.filter(through)
            own = b.filter(pc.invert(through))
            for k, p, n, x in zip(*(own.column(c).to_pylist() for c in ("kind", "part", "rows", "payload")), strict=True):
                found[k].append((p, n, x))
        solve_runs(found.pop(RUNS), out)
        solve_texts(found.pop(TEXTS), out)
        yield out.batch()

    def deal(packed: DataFrame, name: str) -> DataFrame:
        even = packed.withColumn("deal", deal_key).repartition(parts, "deal").drop("deal")
        return scratch.write(even.mapInArrow(tidy(solve), PACKED), name)

    first = deal(named.select("doc_id", "text").mapInArrow(tidy(spread), PACKED), "runs")
    asked = first.where(F.col("kind").isin(ASK, ASK_WINDOWS)).withColumn("to_deal", deal_key)

    def collect(left: pa.Table, right: pa.Table) -> pa.Table:
        out = Out(parts)
        if right.num_rows:
            raw = [x.encode("utf-8") for x in left.column("text").to_pylist()]
            by_key = {(d, zlib.crc32(x)): x for d, x in zip(left.column("doc_id").to_pylist(), raw, strict=True)}
            fetch(list(zip(*(right.column(c).to_pylist() for c in ("kind", "rows", "payload")), strict=True)), by_key, out)
        made = pa.Table.from_batches([out.batch()])
        give_back()
        return made

    placed = named.withColumn("part", doc_part_column(F.col("doc_id"), parts)).withColumn("deal", deal_key).drop("part")
    removed = first.where(F.col("kind") == SPANS)
    if not asked.isEmpty():
        fetched = placed.drop("carried").groupBy("deal").cogroup(asked.groupBy("to_deal")).applyInArrow(collect, PACKED)
        removed = removed.union(deal(fetched, "texts").where(F.col("kind") == SPANS))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list] = {}
        if right.num_rows and left.num_rows:
            rows = [unpack(SPANS, n, x)[0] for n, x in zip(right.column("rows").to_pylist(), right.column("payload").to_pylist(), strict=True)]
            t = {k: np.concatenate([x[k] for x in rows]).astype(np.int64) for k in ("doc", "tag", "start", "n")}
            order, group = grouped(t["doc"], t["tag"])
            for at in np.split(order, np.flatnonzero(np.diff(group)) + 1):
                found[int(t["doc"][at[0]]), int(t["tag"][at[0]])] = (t["start"][at], t["n"][at])
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        kinds = [left.schema.field("doc_id").type, pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.string() if as_text else pa.binary(), left.schema.field("carried").type]
        wanted = pa.schema([pa.field(f, k) for f, k in zip(("doc_id", "n_bytes", "spans", "kept", "carried"), kinds, strict=True)])
        done = []
        for part in slices(iter(left.to_batches()), "text"):
            raw = [x.encode("utf-8") for x in part.column("text").to_pylist()]
            made = [cut(x, *found.get((d, zlib.crc32(x)), nothing)) for d, x in zip(part.column("doc_id").to_pylist(), raw, strict=True)]
            spans = pa.array([[{"begin": a, "end": b} for a, b in m[0]] for m in made], kinds[2])
            kept = pa.array([m[1] for m in made], pa.binary())
            done.append(pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(x) for x in raw], pa.int64()), spans, decode_texts(kept) if as_text else kept, part.column("carried")], schema=wanted))
        give_back()
        return pa.Table.from_batches(done, wanted)

    schema = T.StructType.fromDDL(f"doc_id long, n_bytes long, spans array<struct<begin: bigint, end: bigint>>, kept {'string' if as_text else 'binary'}")
    schema = schema.add("carried", texts.schema["carried"].dataType)
    done = placed.groupBy("deal").cogroup(removed.withColumn("to_deal", deal_key).groupBy("to_deal")).applyInArrow(finish, schema)
    whole = texts.where("doc_id is null").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<begin: bigint, end: bigint>>").alias("spans"), (F.col("text") if as_text else F.col("text").cast("binary")).alias("kept"), "carried",
    )
    both = done.unionByName(whole)
    return both if carry else both.drop("carried")
