"""Near-duplicate grouping against all pairs in plain Python."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskline.llm import near_dedup as ND
from riskline.llm.common import Scratch
from riskline.llm.components import UnionFind, components
from riskline.llm.minhash import SLOTS, super_minhash
from riskline.llm.shingles import shingle_sets

from .fixtures import awkward, empty, table, words


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    at = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        if d is not None:
            for x in s:
                at[x].append(i)
    common = Counter((a, b) for found in at.values() for k, b in enumerate(found) for a in found[:k])
    groups = UnionFind()
    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a][1]) + len(sets[b][1]) - c):
            groups.union(sets[a][0], sets[b][0])
    return sorted(((d, len(s), None if d is None else groups.find(d), d is None or groups.find(d) == d) for d, s in sets), key=str)


def test_shingle_sets():
    rows = awkward()
    hashes, sizes = shingle_sets([t for _, t in rows])
    sets = [shingles(t) for _, t in rows]
    assert sizes.tolist() == [len(s) for s in sets]
    ours = [frozenset(x.tolist()) for x in np.split(hashes, np.cumsum(sizes)[:-1])]
    for i in range(len(rows)):
        for j in range(i):
            assert len(ours[i] & ours[j]) == len(sets[i] & sets[j])


def test_super_minhash_is_the_step_by_step_definition():
    """Taking all elements through every step without the early stop gives the same signature."""
    from riskline.llm.minhash import _GOLD
    from riskline.llm.shingles import U, mix

    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 60):
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        slow = [2**64 - 1] * SLOTS
        for e in x:
            order = list(range(SLOTS))
            for j in range(SLOTS):
                draw = int(mix(np.array([e], np.uint64) + U(_GOLD * (j + 1) & (2**64 - 1)))[0])
                k = j + ((draw & 0xFFFFFFFF) * (SLOTS - j) >> 32)
                order[j], order[k] = order[k], order[j]
                slow[order[j]] = min(slow[order[j]], j << 32 | draw >> 32)
        assert super_minhash(x, np.array([n]))[0].tolist() == slow


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(6)
    errors = []
    for _ in range(60):
        a = rng.integers(0, 2**63, 200, dtype=np.uint64)
        b = a.copy()
        b[: rng.integers(0, 120)] += np.uint64(1)
        h = super_minhash(np.concatenate([a, b]), np.array([200, 200]))
        errors.append((h[0] == h[1]).mean() - len(set(a) & set(b)) / len(set(a) | set(b)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(1000, 1000 + i) for i in range(1, 90)]
    groups = UnionFind()
    for a, b in links:
        groups.union(a, b)
    frame = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r["node"]: r["root"] for r in components(frame, Scratch(spark, "test")).collect()}
    assert got == {x: groups.find(x) for x in got} and set(got) == {x for link in links for x in link if link[0] != link[1]}


@pytest.mark.parametrize("block", [ND.BLOCK_SHINGLES, 300])
def test_near_dedup(spark, monkeypatch, block):
    """With a small block bound, buckets are solved in pairs of blocks."""
    monkeypatch.setattr(ND, "BLOCK_SHINGLES", block)
    rows = awkward()
    got = sorted((tuple(r) for r in ND.near_dedup(table(spark, rows)).collect()), key=str)
    assert got == expected(rows)


def test_chains_of_copies_stay_whole(spark):
    """A drifting chain: neighbours are alike, far members are not, and one bucket's pivot links few of them."""
    rng = random.Random(12)
    text, rows = words(rng, 150).split(" "), []
    for i in range(60):
        text[rng.randrange(len(text))] = f"new{rng.randrange(10**8)}"
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    got = sorted((tuple(r) for r in ND.near_dedup(table(spark, rows)).collect()), key=str)
    assert got == expected(rows)


def test_solve_block_links_across_groups_once():
    base = np.arange(100, dtype=np.uint64)
    sets = [base, np.append(base[:-1], np.uint64(500)), np.append(base[:-2], np.uint64(600)), np.arange(900, 1000, dtype=np.uint64)]
    flat = np.concatenate([np.sort(s) for s in sets])
    sig = super_minhash(flat, np.array([len(s) for s in sets]))
    t = pa.table(
        {
            "band": [0] * 4, "doc_id": [1, 2, 3, 4], "root": [1, 1, 3, 4], "block": [0, 0, 0, 0],
            "shingles": [np.sort(s).tobytes() for s in sets], "sig": [s.astype(np.uint8).tobytes() for s in sig], "bands": [[1, 2]] * 4,
        }
    )
    links = ND.solve_block(t)
    assert len(links) == 1 and 3 in links[0] and 4 not in links[0]


def test_near_dedup_empty(spark):
    assert ND.near_dedup(empty(spark)).collect() == []


def test_pairs_of_a_block_are_not_listed():
    """Many short texts of one template, no two alike: every pair is a candidate, the memory stays small."""
    n = 600
    sets = np.arange(4 * n, dtype=np.uint64).reshape(n, 4)
    block = pa.table(
        {
            "doc_id": pa.array(range(n), pa.int64()),
            "root": pa.array(range(n), pa.int64()),
            "block": pa.array([0] * n, pa.int32()),
            "band": pa.array([0] * n, pa.int32()),
            "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
            "sig": pa.array([bytes(SLOTS)] * n, pa.binary()),
            "bands": pa.array([[0] * ND.BANDS] * n, pa.list_(pa.int64())),
        }
    )
    tracemalloc.start()
    try:
        assert ND.solve_block(block) == []
        assert tracemalloc.get_traced_memory()[1] < 4 << 20
    finally:
        tracemalloc.stop()
