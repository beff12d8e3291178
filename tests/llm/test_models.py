"""Language identification, quality, language-model scores and top-k search."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path

from riskline.llm import language as LA
from riskline.llm import ngram_lm as LM
from riskline.llm import quality as QU
from riskline.llm import topk as TK
from riskline.llm.queries import QUERIES

from .fixtures import awkward, empty, table

PIECES = path("piece_bpe_32k.model")


def listed_pieces():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = {}
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and p != "▁":
            out.setdefault(p.lower(), len(out))
    return out


WORDS = ["▁the", "▁thedndou", "▁été", "▁größe", "▁日本", "▁a", "▁xqzthtion" + "and" * 5, "▁", "▁𝒳b"]


def weights(size):
    return np.vstack([np.random.default_rng(1).random((size, 3)) / 50, np.full((1, 3), 1e-7), np.zeros((1, 3))])


def test_forward_sums_all_segmentations():
    known = listed_pieces()
    table_ = weights(len(known))
    got = LA.Lattice(WORDS, PIECES).totals(table_)

    def total(word, c):
        def rest(i):
            if i == len(word):
                return 1.0
            out = sum(table_[known[word[i:j]], c] * rest(j) for j in range(i + 1, len(word) + 1) if word[i:j] in known)
            return out if word[i] in known else out + 1e-7 * rest(i + 1)

        return rest(0)

    short = [i for i, w in enumerate(WORDS) if len(w) <= 12]
    assert np.allclose(got[short], [[total(WORDS[i], c) for c in range(3)] for i in short], rtol=1e-12, atol=0)


def test_expected_counts_are_derivatives_of_the_likelihood():
    start = weights(len(listed_pieces()))[:, :1].copy()
    counts = LA.Lattice(WORDS, PIECES).expected(start, np.ones(len(WORDS)))
    for p in np.flatnonzero(counts)[:30]:
        more = start.copy()
        more[p] *= 1 + 1e-6
        change = np.log(LA.Lattice(WORDS, PIECES).totals(more)).sum() - np.log(LA.Lattice(WORDS, PIECES).totals(start)).sum()
        assert abs(change / 1e-6 - counts[p]) < 1e-3


LONG = [LA.START + "".join(WORDS)[:n].replace(LA.START, "") + "ß日本語" * 9 for n in (1, 40, 400)]


def test_long_words_sum_over_all_segmentations():
    """In stretches of any size as in one lattice, far beyond what a double holds without rescaling."""
    table_ = weights(len(listed_pieces()))
    for w in [w for w in WORDS if w][:20]:
        whole = np.log(LA.Lattice([w], PIECES).totals(table_)[0])
        for stretch in (1, 3, 4096):
            assert np.allclose(LA.LongWord(w, PIECES, stretch).log_total(table_), whole, rtol=1e-12, atol=1e-12)
    known = {p: i for i, p in enumerate(listed_pieces())}
    for w in LONG:
        logs = [0.0]
        for end in range(1, len(w) + 1):
            terms = [logs[b] + np.log(table_[known[w[b:end]], 0]) for b in range(max(0, end - 16), end) if w[b:end] in known]
            logs.append(np.logaddexp.reduce([*terms, *([logs[end - 1] + np.log(LA.UNKNOWN)] if w[end - 1] not in known else [])]))
        for stretch in (5, 4096):
            assert abs(LA.LongWord(w, PIECES, stretch).log_total(table_)[0] - logs[-1]) < 1e-9 * abs(logs[-1])


def test_expected_counts_of_long_words():
    start = weights(len(listed_pieces()))[:, :1].copy()
    for w in [w for w in WORDS if w][:20]:
        whole = LA.Lattice([w], PIECES).expected(start, np.array([2.0]))
        for stretch in (1, 3, 4096):
            assert np.allclose(LA.LongWord(w, PIECES, stretch).expected(start, 2.0), whole, rtol=1e-9, atol=1e-12)
    for w in LONG:
        counts = LA.LongWord(w, PIECES, 7).expected(start, 1.0)
        for p in np.flatnonzero(counts)[:10]:
            more = start.copy()
            more[p] *= 1 + 1e-6
            change = LA.LongWord(w, PIECES).log_total(more)[0] - LA.LongWord(w, PIECES).log_total(start)[0]
            assert abs(change / 1e-6 - counts[p]) < 1e-3


def test_combining_marks_belong_to_their_word():
    assert LA.words_of("नमस्ते, e\u0301t\u00e9-12x") == ["▁नमस्ते", "▁e\u0301t\u00e9", "▁x"]
    assert LA.rejected("\u0301 12") and not LA.rejected("नि")


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_language_on_held_out_documents(spark, small_dir):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = QUERIES["op6_language_id"](spark, small_dir).collect()
    assert len(got) == len(docs) and all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in got)
    out = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in got if r["held_out"]]
    assert len(out) > 20 and np.mean(out) > 0.95


def test_language_cases(spark):
    rows = awkward() + [(900, "123 456 !!"), (901, "w" * 100_000)]
    got = LA.identify(table(spark, rows), PIECES).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (5, 6, 7, 900))
    assert all(r["lang_pred"] in ("en", "fr", "und") for r in got) and not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert LA.identify(empty(spark), PIECES).collect() == []
    unlabelled = table(spark, rows).withColumn("lang", LA.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in LA.identify(unlabelled, PIECES).collect()} == {"und"}


def test_language_cache_is_bounded_and_changes_nothing(monkeypatch):
    texts = [t or "" for _, t in awkward()]
    size = LA.pieces(PIECES).size
    model = LA.Model(PIECES, ["a", "b", "c"], np.zeros(3), weights(size)[:-1])
    whole = LA.Scorer(model).predict(texts)
    monkeypatch.setattr(LA, "CACHE_CHUNKS", 3)
    scorer = LA.Scorer(model)
    assert [scorer.predict([t])[0] for t in texts] == whole


def test_quality_on_held_out_documents(spark, small_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    got = QUERIES["op8_quality"](spark, small_dir).collect()
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    out = [r["predicted"] == labels[r["doc_id"]] for r in got if r["doc_id"] in labels]
    assert np.mean(out) > 0.95


def test_quality_cases(spark):
    docs = table(spark, awkward())
    labels = spark.createDataFrame([(100, 1, 0), (100, 0, 0), (101, 1, None), (None, 1, 0), (5, 0, 1), (6, 1, 0), (120, None, 1), (300, 7, 1)], "doc_id long, quality int, toxic int")
    assert QU.quality_scores(docs, labels).count() == len(awkward())
    one = QU.quality_scores(docs, labels.where("quality = 1 and doc_id is not null"))
    assert {r["score"] for r in one.collect()} == {1.0}
    assert {r["score"] for r in QU.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert QU.quality_scores(empty(spark), labels).collect() == []


def test_discriminant_is_the_gaussian_log_ratio(spark):
    rng = np.random.default_rng(2)
    k = len(QU.FEATURES)
    x = [rng.normal(size=(300, k)) @ rng.normal(size=(k, k)) + rng.normal(size=k) for _ in (0, 1)]
    rows = [(c, *map(float, r)) for c in (0, 1) for r in x[c]]
    frame = spark.createDataFrame(rows, "label int, " + ", ".join(f"{f} double" for f in QU.FEATURES))
    model = QU.fit(frame, pool=0.0, ridge=0.0)
    point = rng.normal(size=(5, k))

    def log_density(c):
        s = np.cov(x[c].T, bias=True)
        d = point - x[c].mean(axis=0)
        return -0.5 * (np.einsum("ij,ij->i", d @ np.linalg.inv(s), d) + np.linalg.slogdet(s)[1])

    want = 1 / (1 + np.exp(np.clip(log_density(0) - log_density(1), -700, 700)))
    assert np.allclose(model.score(point), want, atol=1e-6)


def backoff(rows):
    docs = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0d]+", t or "")] for _, t in rows]
    total = [Counter(tuple(d[i : i + n]) for d in docs for i in range(len(d) - n + 1)) for n in (1, 2, 3)]
    tokens, out = sum(map(len, docs)), []
    for (doc_id, _), d in zip(rows, docs):
        own = [Counter(tuple(d[i : i + n]) for i in range(len(d) - n + 1)) for n in (1, 2, 3)]
        count = lambda g: total[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: B023, E731

        def s(g):
            if len(g) == 1:
                return max(count(g), 0.5) / max(tokens - len(d), 1)  # noqa: B023
            return count(g) / count(g[:-1]) if count(g) > 0 else 0.4 * s(g[1:])

        logs = [math.log(s(tuple(d[max(0, i - 2) : i + 1]))) for i in range(len(d))]
        out.append((doc_id, len(d), round(sum(logs) / len(d), 6) if d else None))
    return sorted(out, key=str)


def test_lm_scores(spark):
    rows = awkward()
    got = sorted(((r[0], r[1], None if r[2] is None else round(r[2], 6)) for r in LM.lm_scores(table(spark, rows)).collect()), key=str)
    want = backoff(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(a[2] == b[2] or abs(a[2] - b[2]) < 2e-6 for a, b in zip(got, want))
    assert LM.lm_scores(empty(spark)).collect() == []


def top(rows, k, every):
    ints = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            made = [math.floor(256 * x) for x in v]
            ints[i] = min(ints.get(i, made), made)
    out = []
    for q in ints:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize(("block", "group", "pivots"), [(TK.BLOCK, TK.GROUP, TK.PIVOTS), (40, 3, 6)])
def test_top_k(spark, block, group, pivots):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 8)) * 4
    rows = [(i, (centres[i % 5] + rng.normal(size=8) * 0.1).astype(np.float32).astype(float).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8) for i in range(150)]  # ties and one very common vector
    rows += [(2000, None), (2010, [None] + [1.0] * 7), (2020, [float("nan")] * 8), (2030, [float("inf")] * 8), (None, [1.0] * 8), (2040, [0.0] * 8)]
    rows += [(3, rows[3][1]), (10, [0.5] * 8)]  # ids that are repeated
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cell string").repartition(4)
    got = sorted(tuple(r) for r in TK.top_k(frame, TK.F.col("vec_id") % 10 == 0, 5, pivots, block, group).collect())
    assert got == top(rows, 5, 10)


def test_top_k_few_or_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (50, [0.5, 0.25])], "vec_id long, embedding array<double>")
    is_query = TK.F.col("vec_id") % 50 == 0
    assert sorted(tuple(r) for r in TK.top_k(frame, is_query).collect()) == top([(0, [1.0, 2.0]), (50, [0.5, 0.25])], 5, 50)
    assert TK.top_k(frame.limit(0), is_query).collect() == []
    assert TK.top_k(frame.where("vec_id = 0"), is_query).collect() == []
