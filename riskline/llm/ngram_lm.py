"""Stupid-backoff language-model scores of whole documents against the rest of the corpus.

S(w | u v) = c(u v w) / c(u v) if c(u v w) > 0, else 0.4 S(w | v); S(w | v) = c(v w) / c(v) if c(v w) > 0, else
0.4 S(w); S(w) = max(c(w), 1/2) / N.  Counts are those of all other documents: the corpus count less the document's
own, N likewise (1 at least).  The score is the mean natural logarithm of S over the words of the document.

The count table of all n-grams is partitioned by their hash.  Documents go in groups; a group packs its distinct
n-grams with their counts, sorted, as one row per bucket of the table (so a frequent n-gram travels once per group,
combined, and no bucket holds more than one entry of it per group).  A bucket adds the counts up and sends each group
the totals of its own n-grams, in their order; the group joins them to the n-grams of its documents by position and
sums per document.  An exploded form (one Spark row per n-gram, joined twice) would shuffle several times the input.

Defined results: words are runs without white space, A-Z lower-cased; a document without words, or with a null text,
has n_words 0 and a null score; rows with null ids and rows repeated under one id are documents of their own; an empty
table gives no rows; other columns are not read.  N-grams are told apart by 48 bits within a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import Scratch, slices, tidy
from riskline.llm.shingles import U, mix, word_hashes

ORDER, BACKOFF, FLOOR = 3, 0.4, 0.5
#: Bits that tell the n-grams of one bucket apart.
BITS = 48
_SALT = np.random.default_rng(3).integers(1, 2**63, 16, dtype=np.uint64)


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(word hash, text number) of many texts, a few MB at a time."""
    word, doc, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for part in slices(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]), "text", size=2 << 20):
        w, d = word_hashes(part.column(0).to_pylist())
        word.append(w)
        doc.append(d + at)
        at += part.num_rows
    return np.concatenate(word), np.concatenate(doc)


def grams(word: np.ndarray, doc: np.ndarray, order: int, bits: int) -> list[np.ndarray]:
    """Per n from 1 to ``order``: the hash of ``bits`` bits of the n-gram that ends at each word, -1 where none does."""
    out, h = [], mix(word + _SALT[0])
    for n in range(1, order + 1):
        if n > 1:
            # the n-gram that ends here is the shorter one that ends a word earlier, and this word
            h = np.concatenate([h[:1], mix(h[:-1] * U(0x9E3779B97F4A7C15) + word[1:] + _SALT[n - 1])])
        value = (h >> U(64 - bits)).astype(np.int64)
        value[: n - 1] = -1
        value[n - 1 :][doc[n - 1 :] != doc[: max(len(doc) - n + 1, 0)]] = -1
        out.append(value)
    return out


def distinct(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(sorted distinct n-grams, their counts, per level the place of each n-gram in them or -1), level by level."""
    parts = []
    for x in levels:
        found, place, count = np.unique(x, return_inverse=True, return_counts=True)
        none = int(len(found) > 0 and found[0] < 0)
        parts.append((found[none:], (place - none).astype(np.int32), count[none:]))
    whole = np.sort(np.concatenate([p[0] for p in parts]))
    whole = whole[np.append(True, whole[1:] != whole[:-1])[: len(whole)]]
    counts, places = np.zeros(len(whole), np.int64), []
    for found, place, count in parts:
        at = np.searchsorted(whole, found)
        counts[at] += count
        places.append(np.append(at, -1)[place])
    return whole, counts, places


def planes(x: np.ndarray, width: int) -> bytes:
    """Little-endian bytes of non-negative integers, plane by plane (equal high bytes compress away)."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T
    return out.view("<u8").reshape(-1).astype(np.int64)


def width_of(x: np.ndarray) -> int:
    return max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)


def own_counts(place: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """How often the n-gram at each word stands in the word's own document."""
    _, at, count = np.unique(place * docs + doc, return_inverse=True, return_counts=True)
    return count[at]


def backoff_scores(levels: list[np.ndarray], doc: np.ndarray, docs: int, total: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, mean log score) of every document; ``levels``: places in ``total``, the corpus counts."""
    n_words = np.bincount(doc, minlength=docs)
    rest = np.maximum(tokens - n_words, 1)[doc].astype(float)
    count = [np.where(p >= 0, total[np.maximum(p, 0)] - own_counts(p, doc, docs), 0) for p in levels] if len(total) else [np.zeros(0)] * len(levels)
    score = np.log(np.maximum(count[0], FLOOR) / rest)
    for n in range(1, len(levels)):
        context = np.ones(len(doc))
        context[1:] = np.maximum(count[n - 1][:-1], 1)
        seen = count[n] > 0
        back = np.where(levels[n] >= 0, score + np.log(BACKOFF), score)  # the first words have no longer context
        score = np.where(seen, np.log(np.maximum(count[n], 1)) - np.log(context), back)
    total_log = np.bincount(doc, weights=score, minlength=docs)
    return n_words, total_log / np.maximum(n_words, 1)


def by_group(docs: DataFrame) -> DataFrame:
    """(grp, payload): the documents (doc_id, text, grp) of each slice packed by group and compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            grp = part.column("grp").to_numpy()
            order = np.argsort(grp, kind="stable")
            rows = [(int(grp[at[0]]), _packed(part.select(["doc_id", "text"]).take(pa.array(at)))) for at in np.split(order, np.flatnonzero(np.diff(grp[order])) + 1) if len(at)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["grp", "payload"])

    return docs.mapInArrow(tidy(run), "grp int, payload binary")


def _packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def texts_of(table: pa.Table) -> pa.Table:
    """The documents in the payloads of a group, in one order however they arrived."""
    parts = [pa.ipc.open_stream(x).read_all() for x in sorted(table.column("payload").to_pylist())]
    return pa.concat_tables(parts) if parts else pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})


def lm_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, score of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-lm")
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = 3 * shuffles
    bucket_bits = max(1, (shuffles - 1).bit_length())
    bits = min(BITS + bucket_bits, 63)
    low = (1 << (bits - bucket_bits)) - 1
    placed = by_group(docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(groups)).cast("int").alias("grp")))

    # packed rows: bucket -1 has the words of a group; w and v: bytes of a step between hashes and of a count
    packed = "grp int, bucket int, rows int, tokens long, payload binary, w int, v int"
    names = ["grp", "bucket", "rows", "tokens", "payload", "w", "v"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]

    def send(key: tuple, table: pa.Table) -> pa.Table:
        word, doc = words_of(texts_of(table).column("text").to_pylist())
        n_words = len(word)
        found, count, _ = distinct(grams(word, doc, order, bits))
        del word, doc
        bucket = found >> (bits - bucket_bits)
        rows = [(key[0].as_py(), -1, 0, n_words, b"", 0, 0)]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for at, n in zip(np.split(found, cuts), np.split(count, cuts), strict=True):
            if len(at):
                step = np.diff(at & low, prepend=0)
                w, v = width_of(step), width_of(n)
                rows.append((key[0].as_py(), int(at[0] >> (bits - bucket_bits)), len(at), 0, planes(step, w) + planes(n, v), w, v))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def totals(bucket: int, rows: list[tuple]) -> pa.RecordBatch:
        """Corpus counts of the n-grams of one bucket, for every group that sent some."""
        _, place = np.unique(np.concatenate([from_planes(x, n, w).cumsum() for _, n, x, w, _ in rows]), return_inverse=True)
        total = np.zeros(int(place.max(initial=-1)) + 1, np.int64)
        at = 0
        for _, n, x, w, v in rows:  # n-grams are distinct within a row
            total[place[at : at + n]] += from_planes(x[n * w :], n, v)
            at += n
        back = np.split(total[place], np.cumsum([r[1] for r in rows])[:-1])
        v = [width_of(x) for x in back]
        columns = ([r[0] for r in rows], [bucket] * len(rows), [r[1] for r in rows], [0] * len(rows), [planes(x, n) for x, n in zip(back, v, strict=True)], [0] * len(rows), v)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket: one bucket at a time, however many a task reads."""
        bucket, held = -1, []
        for b in batches:
            yield b.filter(pa.array([x < 0 for x in b.column("bucket").to_pylist()], pa.bool_()))
            for g, k, n, _, x, w, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k < 0:
                    continue
                if k != bucket:
                    if held:
                        yield totals(bucket, held)
                    bucket, held = k, []
                held.append((g, n, x, w, v))
        if held:
            yield totals(bucket, held)

    sent = placed.groupBy("grp").applyInArrow(send, packed)
    counted = scratch.write(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(add_up), packed), "totals")
    tokens = counted.agg(F.sum("tokens")).first()[0] or 0

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        docs_ = texts_of(left)
        word, doc = words_of(docs_.column("text").to_pylist())
        found, _, levels = distinct(grams(word, doc, order, bits))
        answers = sorted(zip(*(right.column(c).to_pylist() for c in ("bucket", "rows", "payload", "v")), strict=True), key=lambda r: r[0])
        total = np.concatenate([np.zeros(0, np.int64), *(from_planes(x, n, v) for k, n, x, v in answers if k >= 0)])
        if len(total) != len(found):
            raise ValueError(f"{len(total)} counts for {len(found)} n-grams")
        n_words, mean = backoff_scores(levels, doc, docs_.num_rows, total, tokens)
        return pa.table({"doc_id": docs_.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "score": pa.array(mean, pa.float64(), mask=n_words == 0)})

    answers = counted.withColumnRenamed("grp", "to_grp")
    return placed.groupBy("grp").cogroup(answers.groupBy("to_grp")).applyInArrow(score, "doc_id long, n_words long, score double")
