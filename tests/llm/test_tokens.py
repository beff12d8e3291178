"""BPE and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from riskline.llm import bpe as BP
from riskline.llm import packing as PK

from .fixtures import awkward, empty, table

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def texts():
    rng = random.Random(4)
    odd = ["don't WE'LL 12345  \n\n x\t\ty   ", "ΑΣ ΑΣα İstanbul", "日本語テキスト 한국어 𝒳😀👩‍👧 ٣٤", "<|startoftext|><|endoftext|>x<|endoftext|>", " ", "x" * 3000 + "1" * 200]
    wild = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x530), rng.randrange(0x1C00, 0x3100), rng.randrange(0x10000, 0x12000)])) for _ in range(50)) for _ in range(100)]
    return [t or "" for _, t in awkward()] + odd + wild


@pytest.mark.parametrize("name", FILES)
def test_bpe_equals_library(name):
    ours, library = BP.Bpe(path(name)), Tokenizer.from_file(path(name))
    for t in texts():
        ids = library.encode(t, add_special_tokens=False).ids
        assert ours.encode(t) == ids, t[:60]
        assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)
        assert ours.encode_decode(t) == (np.array(ids, "<i4").tobytes(), ours.decode(ids))


def test_bpe_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(BP, "CACHE_CHUNKS", 5)
    ours, library = BP.Bpe(path(FILES[0])), Tokenizer.from_file(path(FILES[0]))
    for t in texts()[:30]:
        assert ours.encode(t) == library.encode(t, add_special_tokens=False).ids
        assert len(ours.cache) <= 5


def test_bpe_job(spark):
    rows = awkward()
    library = Tokenizer.from_file(path(FILES[0]))
    got = sorted(((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in BP.bpe_round_trip(table(spark, rows), path(FILES[0])).collect()), key=str)
    encoded = [(d, library.encode(t or "", add_special_tokens=False).ids) for d, t in rows]
    assert got == sorted(((d, tuple(i), library.decode(i, skip_special_tokens=False)) for d, i in encoded), key=str)
    assert BP.bpe_round_trip(empty(spark), path(FILES[0])).collect() == []


def check_packing(rows, got, capacity):
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = []
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        starts = [0] if len(ids) <= capacity else [*([0] if len(ids) % capacity else []), *range(len(ids) % capacity, len(ids), capacity)]
        want += [(d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), -(-sum(r["length"] for r in got) // capacity)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_job(spark, capacity):
    rows = awkward()
    pieces = PK.token_pieces(table(spark, rows), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), capacity=capacity)
    used, least = check_packing(rows, PK.pack(pieces, capacity=capacity).collect(), capacity)
    assert used <= least * 1.01 + 1


def test_packing_empty(spark):
    assert PK.pack(PK.token_pieces(empty(spark), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))).collect() == []


def test_pieces_carry_their_ids(spark):
    rows = [(1, "some words " * 50), (2, None)]
    got = PK.token_pieces(table(spark, rows), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), capacity=32, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in got)


def best_fit_decreasing(counts, capacity):
    gaps = []
    for x in range(capacity, 0, -1):
        for _ in range(int(counts[x])):
            fits = [g for g in gaps if g >= x]
            gap = min(fits, default=capacity)
            if fits:
                gaps.remove(gap)
            gaps.append(gap - x)
    return len(gaps)


def test_histogram_packing_uses_every_piece_once():
    rng = random.Random(9)
    for _ in range(300):
        capacity = rng.choice([5, 16, 50, 200])
        counts = np.zeros(capacity + 1, np.int64)
        for _ in range(rng.randint(0, 30)):
            counts[rng.randint(1, capacity)] += rng.choice([1, 1, 2, 40])
        used, sequences = np.zeros(capacity + 1, np.int64), 0
        for lengths, copies in PK.pack_histogram(counts, capacity):
            assert copies >= 1 and sum(x * k for x, k in lengths.items()) <= capacity
            sequences += copies
            for x, k in lengths.items():
                used[x] += k * copies
        assert (used == counts).all()
        assert sequences <= best_fit_decreasing(counts, capacity)


def test_no_packing_without_exact_complements(monkeypatch):
    calls, exact, best_fit = [], PK._exact, PK._best_fit
    monkeypatch.setattr(PK, "_exact", lambda *a: calls.append("exact") or exact(*a))
    monkeypatch.setattr(PK, "_best_fit", lambda *a: calls.append("fit") or best_fit(*a))
    PK.pack_histogram(np.array([0, 3, 2, 0, 5, 1]), 8)
    assert calls == ["exact", "fit"] * 3


def test_complement_finds_a_filling_whenever_there_is_one():
    rng = random.Random(2)
    for _ in range(500):
        left = np.array([0, *(rng.choice([0, 0, 0, 1, 2]) for _ in range(30))])
        gap = rng.randint(1, 30)
        items = [x for x in range(1, 31) for _ in range(left[x])]
        from itertools import combinations

        possible = any(sum(c) == gap for k in (1, 2, 3) for c in combinations(items, k))
        found = PK._complement(left.copy(), gap)
        assert (found is not None) == possible
        assert found is None or (sum(found) == gap and all(found.count(x) <= left[x] for x in found))


def test_sum_index_under_falling_counts():
    """Consumed combinations and those put back: always as an index made anew."""
    rng = random.Random(5)
    for _ in range(150):
        left = np.array([0, *(rng.choice([0, 0, 1, 1, 3]) for _ in range(24))])
        sums = PK.Sums(left)
        for _ in range(30):
            before, keep = left.copy(), rng.random() < 0.6
            for _ in range(rng.randint(1, 3)):
                gap = rng.randint(1, 24)
                found, new = sums.filling(gap), PK.Sums(left.copy()).filling(gap)
                assert found == new
                for x in found or []:
                    left[x] -= 1
            if keep:
                sums.keep()
            else:
                left[:] = before
                sums.undo()


def test_exact_fillings_are_given_back_where_that_saves_a_sequence():
    exact, rest = [({5: 1, 3: 1}, 3), ({4: 2}, 2)], [({7: 1}, 1)]
    kept, left = PK._given_back(exact, rest, 3, 8)
    assert kept == [({5: 1, 3: 1}, 2)] and left.tolist() == [0, 0, 0, 1, 4, 1, 0, 1, 0]
    rng = random.Random(3)
    for _ in range(60):
        counts = np.zeros(201, np.int64)
        for _ in range(150):
            counts[rng.randint(1, 200)] += 1
        made = PK.pack_histogram(counts, 200)
        bound = -(-int((counts * np.arange(201)).sum()) // 200)
        first = min(PK._sequences(PK._exact(left := counts.copy(), 200, most) + PK._best_fit(left, 200)) for most in (3, 2, 1))
        assert bound <= PK._sequences(made) <= first
        full = sum(c for used, c in made if sum(x * k for x, k in used.items()) == 200)
        assert full >= PK._sequences(made) // 3  # most come from the exact fillings


def test_digest_is_of_the_decoded_text():
    ours = BP.Bpe(path(FILES[0]))
    _, decoded = ours.encode_decode("The End.")
    assert decoded == "the</w> end</w> .</w>" and len(hashlib.sha256(decoded.encode()).hexdigest()) == 64
