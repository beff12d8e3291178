"""Exact nearest neighbours and synthetic minority rows against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from riskline.operators import neighbours as NB
from riskline.operators import smote as SM
from riskline.plans import training as TR


def points(spark, rows):
    return spark.createDataFrame(rows, "id string, v array<bigint>").repartition(3)


def expected(rows, k):
    out = {}
    for i, v in rows:
        others = sorted((sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), j) for j, w in rows if j != i)
        out[i] = others[:k]
    return out


def got(df):
    return {r["id"]: [(n["distance"], n["id"]) for n in r["neighbours"]] for r in df.collect()}


def clustered(rng, n, dims=4, centres=8, spread=30):
    middle = [[rng.randint(-5000, 5000) for _ in range(dims)] for _ in range(centres)]
    return [(f"p{i:05d}", [x + rng.randint(-spread, spread) for x in rng.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("per_cell,block,chunk", [(256, 1024, 1024), (16, 8, 8), (5, 1024, 3)])
def test_equal_to_brute_force(spark, per_cell, block, chunk):
    rng = random.Random(per_cell)
    rows = clustered(rng, 250) + [(f"u{i}", [rng.randint(-6000, 6000) for _ in range(4)]) for i in range(40)]
    rows += [(f"same{i:03d}", [7, 7, 7, 7]) for i in range(120)]  # a third of all rows is one vector
    rows += [(f"line{i}", [i % 5, 0, 0, 0]) for i in range(20)]  # ties
    assert got(NB.NeighbourSearch(points(spark, rows), 5, per_cell, block, chunk).neighbours()) == expected(rows, 5)


def test_few_rows(spark):
    for n in (1, 2, 4):
        rows = [(f"r{i}", [i * i, 3]) for i in range(n)]
        assert got(NB.nearest_neighbours(points(spark, rows), 5)) == expected(rows, 5)
    assert NB.nearest_neighbours(points(spark, []), 5).count() == 0


def test_cells_are_left_out(spark):
    rows = clustered(random.Random(2), 1500, centres=30)
    asked, there = NB.NeighbourSearch(points(spark, rows), 5, per_cell=25).asked()
    assert asked < 0.25 * there


def slice_of(spark, positives, negatives, seed=1):
    rng = random.Random(seed)
    rows = [(f"t{i}", i, int(i < positives), round(rng.uniform(1, 200), 2), float(rng.randint(0, 23))) for i in range(positives + negatives)]
    return spark.createDataFrame(rows, "transaction_id string, us long, label int, amount double, hour double")


def test_smote_balances_and_stays_between(spark):
    train = slice_of(spark, 12, 60)
    made = SM.smote_rows(train, ["amount", "hour"]).collect()
    assert len(made) == 48 and len({r["row"] for r in made}) == 48
    value = {r["transaction_id"]: (r["amount"], r["hour"]) for r in train.collect()}
    near = {i: {n for _, n in found} for i, found in got(SM.minority_search(train, ["amount", "hour"]).neighbours()).items()}
    for r in made:
        assert r["neighbour_id"] in near[r["base_id"]]
        for x, a, b in zip((r["amount"], r["hour"]), value[r["base_id"]], value[r["neighbour_id"]], strict=True):
            assert min(a, b) - 1e-9 <= x <= max(a, b) + 1e-9
    assert len({(r["base_id"], r["neighbour_id"]) for r in made}) > 20
    again = SM.smote_rows(train.repartition(5), ["amount", "hour"]).collect()
    assert sorted(made) == sorted(again)
    balanced = SM.smote(train, ["amount", "hour"]).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in balanced} == {0: 60, 1: 60}


@pytest.mark.parametrize("positives,negatives,lacking", [(1, 9, 0), (0, 5, 0), (6, 6, 0), (8, 3, 0), (2, 7, 5), (3, 9, 6)])
def test_smote_small_classes(spark, positives, negatives, lacking):
    made = SM.smote_rows(slice_of(spark, positives, negatives), ["amount", "hour"])
    assert made.columns == ["row", "base_id", "neighbour_id", "amount", "hour"]
    assert made.count() == lacking


def test_constant_feature_has_no_weight(spark):
    train = slice_of(spark, 6, 10).withColumn("hour", F.lit(3.0))
    assert {len(v["v"]) for v in SM.minority_search(train, ["amount", "hour"]).points.collect()} == {2}
    assert SM.smote_rows(train, ["amount", "hour"]).where("hour <> 3.0").count() == 0


def test_smote_candidate_fits(spark):
    train = slice_of(spark, 12, 60)
    entrants = TR.candidates(TR.CandidateConfig(lr_max_iter=20, include=("logistic_smote",)), ["amount", "hour"], 1.0)
    (name, (pipe, weighting)), = entrants.items()
    fitted = TR.Fitted(name, pipe, weighting, ["amount", "hour"]).fit(train)
    rows = TR.positive_probability(fitted, train).select("raw_probability").collect()
    assert len(rows) == 72 and all(0 < r[0] < 1 for r in rows)
    assert name in TR.ALL_CANDIDATES and len(TR.ALL_CANDIDATES) == 5
