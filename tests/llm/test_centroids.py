"""Centroid clustering against plain Python, and the bounds that leave centroids out."""

import hashlib
import math
import random

import numpy as np
import pytest

from riskline.llm import centroids as CE

SCHEMA = "vec_id long, embedding array<float>, cluster string, v int, apex string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 7, "clash") for i, v in rows], SCHEMA).repartition(3)


def expected(rows, k, rounds, dims, scale):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    keyed = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [list(v) for _, v in keyed[:k]]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres]
            out.append((i, v, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        done = assign()
        for c in range(len(centres)):
            own = [v for v, (_, _, g, _) in zip([v for _, v in kept], done, strict=True) if g == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    per = [sum(d for _, _, g, d in found if g == c) for c in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, g, d, per[g], sum(per), sha[g]) for i, _, g, d in found), key=str)


def got(df):
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect()), key=str)


def vectors(rng, n, dims, centres=5, spread=0.05):
    middle = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(centres)]
    return [(i, [float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("dims,k,scale", [(4, 5, 64), (6, 16, 8), (64, 16, 64), (3, 7, 2)])
def test_equal_to_plain_python(spark, dims, k, scale):
    rng = random.Random(dims)
    rows = vectors(rng, 120, dims)
    rows += [(1000, None), (1001, []), (1002, [0.5] * (dims - 1)), (1003, [None] + [0.5] * (dims - 1)), (1004, [math.nan] * dims), (1005, [math.inf] * dims)]
    rows += [(None, rows[0][1]), (None, rows[1][1]), (3, rows[3][1]), (3, rows[4][1])]  # no id; one id twice, alike and not
    rows += [(2000 + i, rows[7][1]) for i in range(60)]  # a third of all rows in one place
    assert got(CE.cluster(table(spark, rows), k, 3, dims, scale)) == expected(rows, k, 3, dims, scale)


def test_ties_few_vectors_and_empty(spark):
    rows = [(1, [0.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0])]
    assert got(CE.cluster(table(spark, rows), 2, 0, 2, 1)) == expected(rows, 2, 0, 2, 1)
    assert got(CE.cluster(table(spark, rows), 16, 3, 2, 1)) == expected(rows, 16, 3, 2, 1)
    same = [(i, [0.25, -0.25]) for i in range(20)]  # equal centroids: the smaller number wins, the others stay empty
    assert got(CE.cluster(table(spark, same), 16, 3, 2, 64)) == expected(same, 16, 3, 2, 64)
    assert CE.cluster(table(spark, rows).where("vec_id < 0")).count() == 0


def test_bounds_hold_and_are_tight_in_the_hull():
    rng = np.random.default_rng(3)
    for dims, pivots in ((2, 6), (5, 3), (64, 16)):
        x, p = rng.integers(-60, 60, (200, dims)), rng.integers(-60, 60, (pivots, dims))
        p[-1] = p[0]  # a pivot twice is left out
        simplex = CE.Simplex(p)
        assert len(simplex.pivots) <= min(pivots, dims + 1)
        low, high = CE.bounds(*simplex.apex(CE.squared(x, simplex.pivots)), *simplex.apex(CE.squared(x, simplex.pivots)))
        exact = CE.squared(x, x)
        assert (low <= exact).all() and (exact <= high).all()
        if pivots > dims:  # the hull is the whole space: both bounds are the distance
            assert np.allclose(low, exact, atol=1e-2) and np.allclose(high, exact, atol=1e-2)


def test_centroids_are_left_out(spark):
    rows = vectors(random.Random(9), 800, 64, centres=16, spread=0.02)
    found = CE.cluster(table(spark, rows)).agg({"compared": "avg"}).first()[0]
    assert found < 8
