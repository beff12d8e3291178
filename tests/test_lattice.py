"""Exact p-values of the KS distance against all interleavings."""

from itertools import combinations

import pytest

from riskline.operators import drift as D
from riskline.operators import lattice as LT


def shares(n, m):
    """For every distance h: the share of interleavings of n and m rows whose largest |a m - b n| is at least h."""
    found = []
    for places in combinations(range(n + m), n):
        a = b = top = 0
        for k in range(n + m):
            a, b = (a + 1, b) if k in places else (a, b + 1)
            top = max(top, abs(a * m - b * n))
        found.append(top)
    return {h: sum(t >= h for t in found) / len(found) for h in range(n * m + 2)}


@pytest.mark.parametrize("n", range(1, 7))
def test_all_interleavings(n):
    for m in range(1, 7):
        for h, share in shares(n, m).items():
            assert LT.outside_share(n, m, h) == pytest.approx(share, abs=1e-12), (n, m, h)


def test_large_samples_agree_with_the_series(spark):
    p = LT.outside_share(3000, 2000, int(0.03 * 3000 * 2000))
    row = spark.range(1).select(D.ks_p_value(*[D.F.lit(x) for x in (0.03, 3000.0, 2000.0)]).alias("p")).first()
    assert p == pytest.approx(row["p"], abs=0.02)


def test_rows_per_column(spark):
    left = spark.createDataFrame([(float(i), float(i % 3)) for i in range(12)], "x double, y double")
    right = spark.createDataFrame([(float(i) + 4, float(i % 3)) for i in range(9)], "x double, y double")
    found = {r["metric"]: r for r in D.ks_tests(left, right, ["x", "y"]).collect()}
    assert (found["x"]["n"], found["x"]["m"], found["x"]["method"]) == (12, 9, "exact")
    assert found["x"]["ks"] == pytest.approx(4 / 12)
    assert found["x"]["p_value"] == pytest.approx(LT.outside_share(12, 9, 36))
    assert found["y"]["ks"] == 0.0 and found["y"]["p_value"] == 1.0
    empty = D.ks_tests(left, right.where("false"), ["x"]).first()
    assert empty["ks"] == 0.0 and empty["p_value"] == 1.0


def test_beyond_the_limit_the_series_is_used(spark, monkeypatch):
    monkeypatch.setattr(D, "EXACT_ROWS", 10)
    frames = [spark.range(a, b).select(D.F.col("id").cast("double").alias("x")) for a, b in ((0, 40), (5, 60))]
    row = D.ks_tests(*frames, ["x"]).first()
    assert row["method"] == "asymptotic" and 0 < row["p_value"] < 1
