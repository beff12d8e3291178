"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

One pass over the texts turns each document into a short vector of statistics (``FEATURES``), staged once.  Class
sizes, sums and second moments come from one grouped aggregation with map-side combine; only those (2 rows) reach
the driver.  Each class covariance is shrunk towards the pooled one and a scaled identity, factored once by
Cholesky, and the score of a document is the logistic of the difference of the two log densities (Mahalanobis
distances by triangular solve with the cached factors) plus the log prior ratio.

Defined results: null text counts as empty and is scored; a null id is never learned from and not held out; of
several labels of one id the smallest counts, null labels and labels other than 0 and 1 are left out; with no
labelled rows of a class the score is the share of label 1 among the labelled rows (0.5 without any); repeated rows
are scored each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import Scratch, stream

FEATURES = (
    "log_chars", "word_length", "symbols", "pipes", "bangs", "digits", "capitals", "distinct_words", "repeats", "stops", "short_words",
)
#: Shrinkage towards the pooled covariance, towards the scaled identity, and the contract's threshold.
POOL, RIDGE, THRESHOLD = 0.1, 0.02, 0.3

# byte classes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 sentence mark, 6 '!', 7 '|', 8 other symbol, 9 continuation byte
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 8
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = 1, 2, 3
_CLASS[[0x20, *range(9, 14)]] = 4
for _c in ".,;:?-'\"()":
    _CLASS[ord(_c)] = 5
_CLASS[ord("!")], _CLASS[ord("|")], _CLASS[0x80:0xC0] = 6, 7, 9


def statistics(text: str) -> list[float]:
    """The FEATURES of one whole text, log-transformed shares with a floor that shrinks with its length."""
    count = np.bincount(_CLASS[np.frombuffer(text.encode("utf-8"), np.uint8)], minlength=10).tolist()
    words = text.split()
    chars, n = len(text), len(words)
    letters = count[0] + count[1] + count[2]
    share = lambda part, whole: float(np.log((part + 0.5) / (whole + 25.0)))
    return [
        float(np.log1p(chars)),
        float(np.log((letters + 5.0) / (n + 1.0))),
        share(count[8], chars),
        share(count[7], n),
        share(count[6], n),
        share(count[3], chars),
        share(count[2], letters),
        float(np.log((len(set(words)) + 5.0) / (n**0.8 + 5.0))),
        share(sum(map(eq, words, words[1:])), n),
        share(count[5], n),
        share(sum([len(w) < 4 for w in words]), n),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and one double column per feature."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t or "") for t in part.column("text").to_pylist()]).reshape(-1, len(FEATURES))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(rows[:, i]) for i in range(len(FEATURES)))], ["doc_id", *FEATURES])

    return stream(docs.select("doc_id", "text"), work, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass
class Discriminant:
    """Class means, Cholesky factors, log determinants and the log prior ratio; ``constant`` without both classes."""

    means: np.ndarray | None
    factors: np.ndarray | None
    offset: float
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        distance = [(np.linalg.solve(self.factors[k], (x - self.means[k]).T) ** 2).sum(axis=0) for k in (0, 1)]
        return 1.0 / (1.0 + np.exp(np.clip(-(self.offset + 0.5 * (distance[0] - distance[1])), -700, 700)))


def moments(rows: DataFrame, label: str) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: count, sums, second moments.  At most two rows are collected."""
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
    sums = [F.sum(f) for f in FEATURES] + [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in pairs]
    out = {}
    for r in rows.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s")).collect():
        s = np.array(r["s"])
        second = np.zeros((len(FEATURES),) * 2)
        for (i, j), v in zip(pairs, s[len(FEATURES) :], strict=True):
            second[i, j] = second[j, i] = v
        out[int(r[label])] = (float(r["n"]), s[: len(FEATURES)], second)
    return out


def fit(rows: DataFrame, label: str = "label", pool: float = POOL, ridge: float = RIDGE) -> Discriminant:
    found = moments(rows, label)
    if len(found) < 2:
        return Discriminant(None, None, 0.0, float(next(iter(found))) if found else 0.5)
    n = {k: v[0] for k, v in found.items()}
    means = {k: v[1] / v[0] for k, v in found.items()}
    scatter = {k: v[2] - np.outer(v[1], v[1]) / v[0] for k, v in found.items()}
    pooled = sum(scatter.values()) / sum(n.values())
    factors, log_det = [], []
    for k in (0, 1):
        s = (1 - pool) * scatter[k] / n[k] + pool * pooled
        s = (1 - ridge) * s + ridge * max(np.trace(s) / len(FEATURES), 1e-9) * np.eye(len(FEATURES))
        factors.append(np.linalg.cholesky(s))
        log_det.append(2 * np.log(np.diag(factors[-1])).sum())
    offset = 0.5 * (log_det[0] - log_det[1]) + np.log(n[1] / n[0])
    return Discriminant(np.array([means[0], means[1]]), np.array(factors), float(offset))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.write(document_statistics(docs), "statistics")
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    model = fit(stats.where(~held_out(F.col("doc_id"), folds, fold)).join(known, "doc_id"))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        x = np.column_stack([part.column(f).to_numpy() for f in FEATURES])
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    def run(batches):
        for part in batches:
            yield work(part)

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
