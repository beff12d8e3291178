"""Order statistics of ranges and scans in chunks: the same answers as plain Python and as windows over a user."""

import random
import statistics

import numpy as np
import pytest

from helpers import at, brute_features, frame, tx
from riskline.operators import segments as SG
from riskline.operators import selection as SE
from riskline.operators.features import offline_features, online_features


def test_kth_smallest():
    rng = np.random.default_rng(4)
    for _ in range(200):
        values = rng.integers(0, rng.integers(1, 40), rng.integers(1, 60)) / 4
        lo = rng.integers(0, len(values), 30)
        hi = np.array([rng.integers(x + 1, len(values) + 1) for x in lo])
        k = np.array([rng.integers(0, b - a) for a, b in zip(lo, hi)])
        expected = [sorted(values[a:b])[c] for a, b, c in zip(lo, hi, k)]
        assert SE.kth_smallest(values, lo, hi, k).tolist() == expected
    found = SE.medians(np.array([5.0, 1.0, 4.0]), np.array([0, 0, 1, 2]), np.array([3, 2, 1, 3]))
    assert found.tolist()[:2] == [4.0, 3.0] and np.isnan(found[2]) and found[3] == 4.0


@pytest.mark.parametrize("bits", [0, 1, 2, 4, 10])
def test_range_medians_over_chunks(spark, bits):
    rng = random.Random(bits)
    rows, ranges, expected = [], [], {}
    for user, n in (("a", 61), ("b", 16), ("c", 1), ("d", 32)):
        values = [float(rng.choice([1, 2, 3, rng.randint(0, 50)])) for _ in range(n)]
        rows += [(user, p, v) for p, v in enumerate(values)]
        for lo in range(n):
            for hi in {lo + 1, n, rng.randint(lo + 1, n), min(n, lo + 9)}:
                ranges.append((user, lo, hi))
                expected[user, lo, hi] = statistics.median(values[lo:hi])
    rows_df = spark.createDataFrame(rows, "user_id string, pos long, value double").repartition(3)
    found = SE.range_medians(rows_df, spark.createDataFrame(ranges, "user_id string, lo long, hi long"), bits).collect()
    assert {(r["user_id"], r["lo"], r["hi"]): r["median"] for r in found} == expected
    assert len(found) == len(expected)


def history(seed, n=220, days=45):
    """One user with two thirds of the rows, many of them at equal times."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = rnd.choice(["u1", "u1", "u1", "u1", "u2", "u3"])
        when = at(minutes=rnd.choice([rnd.randint(0, 60 * 24 * days), 60 * 24 * 7 + rnd.randint(0, 90)]) * rnd.choice([1, 1, 1, 0]) + rnd.randint(0, 3))
        geo = rnd.choice([(40.7128, -74.0060), (51.5072, -0.1276), (None, None)])
        rows.append(tx(f"t{i:03d}", when, amount=round(rnd.uniform(1, 500), 2), user=user, merchant=f"m{rnd.randint(1, 6)}",
                       country=rnd.choice(["US", "GB", "TR"]), device=f"d{rnd.randint(1, 3)}", ip=f"192.0.2.{rnd.randint(1, 3)}",
                       lat=geo[0], lon=geo[1]))
    return rows


def by_id(df):
    return {r["transaction_id"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("seed,bits", [(1, 1), (2, 2), (3, 5)])
def test_hot_users_online(spark, seed, bits):
    rows = history(seed)
    got = by_id(online_features(frame(spark, rows), hot_rows=40, chunk_bits=bits))
    expected = brute_features(rows)
    assert set(got) == set(expected)
    for tid, exp in expected.items():
        for k, v in exp.items():
            assert got[tid][k] == pytest.approx(v, rel=1e-9, abs=1e-9), (tid, k)


def test_hot_users_without_snapshot(spark):
    rows = history(5, n=90)
    got = by_id(online_features(frame(spark, rows), hot_rows=1, chunk_bits=2, distinct_counts=False, medians=False))
    usual = by_id(online_features(frame(spark, rows), distinct_counts=False, medians=False))
    assert got.keys() == usual.keys()
    for tid, row in usual.items():
        assert got[tid]["user_median_amount"] == row["amount"] and got[tid]["unique_merchants_last_24h"] is None
        for k, v in row.items():
            assert got[tid][k] == (pytest.approx(v, rel=1e-12) if isinstance(v, float) else v), (tid, k)


@pytest.mark.parametrize("bits", [1, 3])
def test_hot_users_offline(spark, bits):
    rows = history(7)
    got = by_id(offline_features(frame(spark, rows), hot_rows=30, chunk_bits=bits))
    order = sorted(rows, key=lambda r: (r[1], r[3], r[0]))
    for i, r in enumerate(order):
        before = [x for x in order[:i] if x[1] == r[1]]
        g = got[r[0]]
        amounts = [x[4] for x in before]
        assert g["user_median_amount"] == pytest.approx(statistics.median(amounts) if before else r[4])
        assert g["user_average_amount"] == pytest.approx(sum(amounts) / len(amounts) if before else r[4])
        for k, column in ((2, "new_merchant"), (5, "new_country"), (6, "new_device")):
            assert g[column] == float(bool(before) and r[k] not in {x[k] for x in before})
        for seconds, column in ((300, "transactions_last_5m"), (3600, "transactions_last_1h"), (86400, "transactions_last_24h")):
            assert g[column] == sum(x[3] < r[3] and (r[3] - x[3]).total_seconds() <= seconds for x in before)


def test_chunks_are_bounded(spark):
    df = frame(spark, history(9)).select("user_id", "us", "transaction_id")
    chunks = SG.ordered_chunks(df, ["user_id", "us", "transaction_id"], bits=2)
    assert max(r["count"] for r in chunks.groupBy("_chunk").count().collect()) <= 4
    ordered = [(r["user_id"], r["us"], r["transaction_id"]) for r in chunks.orderBy("_row").collect()]
    assert ordered == sorted(ordered)
