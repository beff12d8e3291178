"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary (a SentencePiece model file; only its
list of pieces is used).  The likelihood of a word sums over all its segmentations into pieces by the forward
algorithm; the score of a text is the posterior of its language, words taken as independent, with the language
shares of the training rows as prior.  Piece probabilities are trained here: one expectation step (forward-backward
over all segmentations, started from equal piece weights) on the words of the training rows, with additive smoothing.

Spark side: the training sample holds about ``train_rows`` rows of each language, chosen by the hash of the id
against the language's exact row count, so its size does not grow with the input.  Word counts are combined inside
the partitions and piece counts by one grouped aggregation; only (language, piece, weight) rows reach the driver, as
many at most as languages times vocabulary.  Scoring is one ``mapInArrow`` over the scan, without a shuffle.

Defined results: null text, or one without a letter, is ``und`` with score 0; without training rows every text is
``und``; a language of the table may be called ``und`` too, so only the flag ``rejected`` of ``predictor`` tells a text
without a letter; equal posteriors go to the language first in alphabet; combining marks belong to the word that they stand in;
a run of letters of any length is one word, summed over all its segmentations (long ones in stretches with carried
and rescaled sums, so memory does not grow with them); a null id is never learned from and is not held out; repeated
rows are predicted each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import bound_batches, slices, stream, tidy
from riskline.llm.quality import held_out
from riskline.llm.shingles import U, mix

#: Training rows of each language (about), additive smoothing per piece, weight of an unknown character.
TRAIN_ROWS, SMOOTHING, UNKNOWN = 3_000, 0.05, 1e-7
#: Longest word (with its mark) whose sums need no rescaling: 31 weights of at least UNKNOWN stay far above underflow.
SHORT = 31
#: Positions of a longer word that are held at once; chunks, and their characters, kept by a worker.
STRETCH, CACHE_CHUNKS, CACHE_CHARACTERS = 4096, 150_000, 1 << 24
START = "▁"
NOT_WORD, LETTER = regex.compile(r"[^\p{L}\p{M}]+"), regex.compile(r"\p{L}")


class Pieces:
    """The vocabulary as a hash table over all pieces and their prefixes, looked up many strings at once."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        listed: dict[str, int] = {}
        for i in range(model.get_piece_size()):
            p = model.id_to_piece(i)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and p != START:
                listed.setdefault(p.lower(), len(listed))
        self.size = len(listed)
        self.longest = max(map(len, listed))
        entries = dict.fromkeys((p[:k] for p in listed for k in range(1, len(p))), -1) | listed
        keys = np.zeros(len(entries), np.uint64)
        by_length: dict[int, list[int]] = defaultdict(list)
        names = list(entries)
        for i, e in enumerate(names):
            by_length[len(e)].append(i)
        for n, at in by_length.items():
            codes = np.array([names[i] for i in at]).view(np.uint32).reshape(len(at), n)
            h = np.zeros(len(at), np.uint64)
            for k in range(n):
                h = extend(h, codes[:, k])
            keys[at] = h
        values = np.array(list(entries.values()), np.int32)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.first = np.full(1 << 20, -1, np.int32)
        self.first[(self.keys >> U(44)).astype(np.int64)] = np.arange(len(keys), dtype=np.int32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether it is a piece or a prefix, number of the piece or -1) of every hash."""
        at = self.first[(h >> U(44)).astype(np.int64)]
        hit = self.keys[at] == h
        hit &= at >= 0
        # entries that share a table cell stand side by side in the sorted list
        lost = np.flatnonzero(~hit & (at >= 0))
        if len(lost):
            again = np.minimum(np.searchsorted(self.keys, h[lost]), len(self.keys) - 1)
            at[lost], hit[lost] = again, self.keys[again] == h[lost]
        return hit, np.where(hit, self.values[at], -1)


def extend(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hash of a string with one more character."""
    return mix(h * U(0x9E3779B97F4A7C15) + code.astype(np.uint64) + U(1))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """Once per worker."""
    return Pieces(path)


def rejected(text: str | None) -> bool:
    """Whether a text has no letter (null texts have none), whatever was learned."""
    return LETTER.search(text or "") is None


def words_of(chunk: str) -> list[str]:
    """The runs of letters (and their combining marks) of a chunk as marked words."""
    return [START + w for w in NOT_WORD.split(chunk.lower()) if w]


class Lattice:
    """All segmentations of many words: ``piece[word, begin, length - 1]``, numbers from the vocabulary.

    Two further numbers: ``unknown`` for a character that is no piece, ``unknown + 1`` (weight 0) for no piece.
    """

    def __init__(self, words: list[str], path: str):
        known = pieces(path)
        self.length = np.array([len(w) for w in words], np.int64)
        n = int(self.length.max(initial=1))
        codes = np.array(words, f"<U{n}").view(np.uint32).reshape(len(words), n)
        self.unknown = known.size
        self.piece = np.full((len(words), n, min(n, known.longest)), self.unknown + 1, np.int32)
        word, begin = np.nonzero(codes)
        h = np.zeros(len(word), np.uint64)
        for k in range(self.piece.shape[2]):
            inside = begin + k < self.length[word]
            word, begin, h = word[inside], begin[inside], h[inside]
            h = extend(h, codes[word, begin + k])
            hit, number = known.find(h)
            found = number >= 0
            self.piece[word[found], begin[found], k] = number[found]
            if k == 0:
                self.piece[word[~found], begin[~found], 0] = self.unknown
            word, begin, h = word[hit], begin[hit], h[hit]
            if not len(word):
                break

    def forward(self, table: np.ndarray) -> np.ndarray:
        """alpha[position, word, language]; ``table``: weight per piece number and language."""
        _, n, longest = self.piece.shape
        alpha = np.zeros((n + 1, len(self.length), table.shape[1]))
        alpha[0] = 1.0
        for end in range(1, n + 1):
            for k in range(1, min(end, longest) + 1):
                number = self.piece[:, end - k, k - 1]
                some = np.flatnonzero(number <= self.unknown)
                alpha[end, some] += alpha[end - k, some] * table[number[some]]
        return alpha

    def totals(self, table: np.ndarray) -> np.ndarray:
        """Probability of each word, summed over all segmentations."""
        return self.forward(table)[self.length, np.arange(len(self.length))]

    def expected(self, table: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts of words seen ``counts`` times, all languages alike (``table`` has one column)."""
        _, n, longest = self.piece.shape
        alpha = self.forward(table)[:, :, 0]
        beta = np.zeros_like(alpha)
        here = np.arange(len(self.length))
        beta[self.length, here] = 1.0
        out = np.zeros(len(table))
        scale = counts / alpha[self.length, here]
        for begin in range(n - 1, -1, -1):
            for k in range(1, min(n - begin, longest) + 1):
                number = self.piece[:, begin, k - 1]
                some = np.flatnonzero(number <= self.unknown)
                step = table[number[some], 0] * beta[begin + k, some]
                beta[begin, some] += step
                out += np.bincount(number[some], weights=alpha[begin, some] * step * scale[some], minlength=len(table))
        return out[: self.unknown]


class LongWord:
    """All segmentations of one word of any length, a stretch of positions at a time.

    Sums are divided by the one at the present position at every step, and the logarithms of the divisors added up;
    no sum is 0, as a single character always is a piece or unknown.
    """

    def __init__(self, word: str, path: str, stretch: int = STRETCH):
        self.word, self.path, self.stretch = word, path, stretch
        self.longest = pieces(path).longest

    def numbers(self, begin: int) -> np.ndarray:
        """Piece numbers [position, length - 1] of the stretch that begins at ``begin``; pieces may end beyond it."""
        lattice = Lattice([self.word[begin : begin + self.stretch + self.longest - 1]], self.path)
        found = lattice.piece[0, : min(self.stretch, len(self.word) - begin)]
        return np.pad(found, ((0, 0), (0, self.longest - found.shape[1])), constant_values=lattice.unknown + 1)

    def forward(self, table: np.ndarray, numbers: np.ndarray, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Divisors of the positions of a stretch, and the sums carried to the next one."""
        steps = table[numbers]
        alpha = np.zeros((len(numbers) + self.longest, table.shape[1]))
        alpha[: self.longest] = carried
        divisors = np.empty((len(numbers), table.shape[1]))
        for p, step in enumerate(steps):
            divisors[p] = alpha[p]
            ahead = alpha[p + 1 : p + 1 + self.longest]
            ahead /= divisors[p]
            ahead += step
        return divisors, alpha[len(numbers) :]

    def passes(self, table: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(begin, sums carried in, divisors, sums carried out) of every stretch."""
        carried = np.zeros((self.longest, table.shape[1]))
        carried[0] = 1.0
        for begin in range(0, len(self.word), self.stretch):
            divisors, after = self.forward(table, self.numbers(begin), carried)
            yield begin, carried, divisors, after
            carried = after

    def log_total(self, table: np.ndarray) -> np.ndarray:
        """Logarithm of the word's probability per language."""
        total = np.zeros(table.shape[1])
        for _, _, divisors, after in self.passes(table):
            total += np.log(divisors).sum(axis=0)
        return total + np.log(after[0])

    def expected(self, table: np.ndarray, count: float) -> np.ndarray:
        """Expected piece counts, as ``Lattice.expected``; only the sums between stretches are held, the rest is made again."""
        held = [(begin, carried) for begin, carried, _, _ in self.passes(table)]
        total = self.log_total(table)[0]
        # logarithm of the divisors before the present position, and of those of the sums behind it
        before = total
        out = np.zeros(len(table))
        behind, log_behind = np.zeros(self.longest), 0.0
        behind[0] = 1.0
        for begin, carried in reversed(held):
            numbers = self.numbers(begin)
            divisors, after = self.forward(table, numbers, carried)
            if begin + len(numbers) == len(self.word):
                before -= float(np.log(after[0, 0]))
            logs = np.log(divisors[:, 0])
            steps = table[numbers, 0]
            for p in range(len(numbers) - 1, -1, -1):
                share = steps[p] * behind
                # the sum at p is 1 after division, so its logarithm is that of all divisors up to p
                np.add.at(out, numbers[p], share * (count * np.exp(before + log_behind - total)))
                before -= logs[p]
                here = share.sum()
                behind = np.concatenate([[1.0], behind[:-1] / here])
                log_behind += float(np.log(here))
        return out[: len(table) - 2]


def log_totals(words: list[str], path: str, table: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of each word (sorted by length) per language."""
    short = [w for w in words if len(w) <= SHORT]
    logs = [np.log(np.maximum(Lattice(short[i : i + 4096], path).totals(table), 1e-300)) for i in range(0, len(short), 4096)]
    logs += [LongWord(w, path).log_total(table)[None] for w in words[len(short) :]]
    return np.concatenate([np.zeros((0, table.shape[1])), *logs])


def expected_pieces(words: dict[str, int], path: str, table: np.ndarray) -> np.ndarray:
    """Expected piece counts of words seen so many times (``table`` has one column)."""
    short = sorted((w for w in words if len(w) <= SHORT), key=len)
    out = np.zeros(len(table) - 2)
    for i in range(0, len(short), 4096):
        group = short[i : i + 4096]
        out += Lattice(group, path).expected(table, np.array([words[w] for w in group], float))
    for w in sorted(w for w in words if len(w) > SHORT):
        out += LongWord(w, path).expected(table, float(words[w]))
    return out


@dataclass
class Model:
    """Languages in alphabetical order, log prior, and the piece table (last row: the unknown character)."""

    path: str
    languages: list[str]
    prior: np.ndarray
    table: np.ndarray

    kept: Scorer | None = None

    def scorer(self) -> Scorer:
        """One for all tasks of a worker."""
        if self.kept is None:
            self.kept = Scorer(self)
        return self.kept


class Scorer:
    """Keeps the scores of chunks and words seen so far, a fixed number at most; row 0 is a chunk without letters."""

    def __init__(self, model: Model):
        self.model = model
        self.weights = np.vstack([model.table, np.zeros(len(model.languages))])
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.scores = np.zeros((1, len(self.model.languages)))
        self.characters = 0

    def learn(self, chunks: list[str]) -> None:
        split = [words_of(c) for c in chunks]
        self.characters += sum(map(len, chunks))
        fresh = sorted({w for s in split for w in s if w not in self.words}, key=len)
        base = len(self.scores)
        self.words.update(zip(fresh, range(base, base + len(fresh)), strict=True))
        several = [(c, [self.words[w] for w in s]) for c, s in zip(chunks, split, strict=True) if len(s) > 1]
        self.known.update((c, self.words[s[0]] if s else 0) for c, s in zip(chunks, split, strict=True))
        self.scores = np.concatenate([self.scores, log_totals(fresh, self.model.path, self.weights)])
        if several:
            base = len(self.scores)
            self.scores = np.concatenate([self.scores, np.array([self.scores[rows].sum(axis=0) for _, rows in several])])
            self.known.update((c, base + i) for i, (c, _) in enumerate(several))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        if not self.model.languages:
            return [("und", 0.0)] * len(texts)
        if len(self.known) > CACHE_CHUNKS or self.characters > CACHE_CHARACTERS:
            self.clear()
        split = [t.split() for t in texts]
        chunks = [c for s in split for c in s]
        row = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(row < 0)
        if len(new):
            self.learn(sorted({chunks[i] for i in new.tolist()}))
            row[new] = [self.known[chunks[i]] for i in new.tolist()]
        out, end = [], 0
        for t, s in zip(texts, split, strict=True):
            begin, end = end, end + len(s)
            if rejected(t):
                out.append(("und", 0.0))
                continue
            total = self.model.prior + self.scores[row[begin:end]].sum(axis=0)
            p = np.exp(total - total.max())
            best = int(p.argmax())
            out.append((self.model.languages[best], float(p[best] / p.sum())))
        return out


def train(rows: DataFrame, path: str, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on ``text`` and non-null ``lang`` of ``rows`` (which also have ``doc_id``)."""
    bound_batches(rows.sparkSession)
    size = pieces(path).size
    start = np.append(np.full(size, 1.0 / size), [UNKNOWN, 0.0])[:, None]
    labelled = rows.where("lang is not null and doc_id is not null")
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model(path, [], np.zeros(0), np.zeros((size + 1, 0)))
    grain = 1 << 30
    limit = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, int(min(1.0, train_rows / totals[k]) * grain))]), F.col("lang"))
    sample = labelled.select("doc_id", "lang", "text").where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < limit)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(size))
        for part in slices(batches, "text"):
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                seen[lang].update((text or "").split())
            for lang, chunks in seen.items():
                words: Counter = Counter()
                for c, n in chunks.items():
                    for w in words_of(c):
                        words[w] += n
                sums[lang] += expected_pieces(words, path, start)
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(s[at])], ["lang", "piece", "weight"])

    # rounded sums do not depend on the order in which partitions arrive
    found = sample.mapInArrow(tidy(count), "lang string, piece int, weight double").groupBy("lang", "piece").agg(F.sum(F.round(F.col("weight") * 1e4).cast("long")).alias("w")).toPandas()
    table = np.full((size + 1, len(languages)), SMOOTHING)
    column = found["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(int)
    np.add.at(table, (found["piece"].to_numpy(int), column), found["w"].to_numpy(float) / 1e4)
    table[:size] /= table[:size].sum(axis=0)
    table[size] = UNKNOWN
    n = np.array([totals[k] for k in languages], float)
    return Model(path, languages, np.log(n / n.sum()), table)


def predictor(model: Model, spark):
    """A column function: text -> struct(lang_pred, score, rejected); leaves the other columns of its frame alone.

    ``rejected``: the text has no letter.  A ``lang_pred`` of ``und`` alone does not say so.
    """
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text"):
            held = [t or "" for t in part.column(0).to_pylist()]
            out += [{"lang_pred": a, "score": b, "rejected": rejected(t)} for t, (a, b) in zip(held, shared.value.scorer().predict(held), strict=True)]
        return pa.array(out, pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]))

    return predict


def identify(docs: DataFrame, path: str, folds: int = 4, fold: int = 2, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns only from rows outside the held-out fold."""
    out = held_out(F.col("doc_id"), folds, fold)
    model = docs.sparkSession.sparkContext.broadcast(train(docs.select("doc_id", "lang", "text").where(~out), path, train_rows))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = model.value.scorer().predict([t or "" for t in part.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )

    scored = stream(docs.select("doc_id", "text"), work, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", out.alias("held_out"), "lang_pred", "score")
