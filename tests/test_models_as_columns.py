"""Fitted models as node tables, their attributions, and Platt's parameters."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from riskline.functions import ensemble as EN
from riskline.operators import calibrate as CA
from riskline.operators.tree_shap import tree_shap
from riskline.plans import training as TR

FEATURES = ["f0", "f1", "f2", "f3"]


def rows_of(spark, n=160, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.choice([0.0, 1.0]), round(rng.uniform(-2, 2), 3), float(rng.randint(0, 9)), round(rng.gauss(0, 1), 3)]
        rows.append((f"t{i}", i, *x, int(x[1] + x[0] * x[3] + rng.gauss(0, 0.4) > 0.3)))
    return spark.createDataFrame(rows, "transaction_id string, us long, f0 double, f1 double, f2 double, f3 double, label int")


@pytest.fixture(scope="module")
def data(spark):
    return rows_of(spark).persist()


@pytest.fixture(scope="module")
def fitted(data):
    cfg = TR.CandidateConfig(rf_trees=4, rf_depth=4, rf_min_leaf=2, gbt_iters=4, gbt_depth=3, lr_max_iter=30)
    out = {}
    for name, (pipe, weighting) in TR.candidates(cfg, FEATURES, 1.0).items():
        if name in ("random_forest", "gradient_boosted_trees", "logistic_regression"):
            out[name] = TR.Fitted(name, pipe, weighting, FEATURES).fit(data)
    return out


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosted_trees", "logistic_regression"])
def test_columns_equal_the_model(spark, data, fitted, name):
    table = EN.NodeTable.from_json(EN.node_table(fitted[name], FEATURES).to_json())
    want = {r["transaction_id"]: r["raw_probability"] for r in TR.positive_probability(fitted[name], data).collect()}
    got = data.select("transaction_id", EN.raw_probability(table).alias("p")).collect()
    assert len(got) == len(want) and all(r["p"] == pytest.approx(want[r["transaction_id"]], abs=1e-12) for r in got)
    plan = data.select(EN.raw_probability(table).alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_missing_values_count_as_zero(spark, fitted):
    table = EN.node_table(fitted["random_forest"], FEATURES)
    rows = spark.createDataFrame([(None, math.nan, 0.0, None), (0.0, 0.0, 0.0, 0.0)], "f0 double, f1 double, f2 double, f3 double")
    a, b = rows.select(EN.raw_probability(table).alias("p")).collect()
    assert a["p"] == b["p"]


def score(table, x):
    """The ensemble's mean or sum at x, walked in plain Python."""
    total = 0.0
    for node in table.roots:
        while table.nodes[node][0] != EN.LEAF:
            f, threshold, left, right, _ = table.nodes[node]
            node = left if x[f] <= threshold else right
        total += table.nodes[node][4]
    return total / len(table.roots) if table.kind == "mean" else total


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosted_trees"])
def test_attributions_equal_all_coalitions(data, fitted, name):
    table = EN.node_table(fitted[name], FEATURES)
    some, back = data.where("us < 12"), data.where("us >= 60 and us < 85")
    got = {}
    for r in tree_shap(some, back, table).collect():
        got[r["transaction_id"], r["feature"]] = r["phi"]
    ground = [[r[f] for f in FEATURES] for r in back.collect()]
    n = len(FEATURES)
    for r in some.collect():
        x = [r[f] for f in FEATURES]
        value = {s: sum(score(table, [x[i] if i in s else b[i] for i in range(n)]) for b in ground) / len(ground)
                 for k in range(n + 1) for s in itertools.combinations(range(n), k)}
        phis = []
        for i in range(n):
            phi = 0.0
            for s, v in value.items():
                if i not in s:
                    weight = math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n)
                    phi += weight * (value[tuple(sorted((*s, i)))] - v)
            phis.append(phi)
            assert got.get((r["transaction_id"], FEATURES[i]), 0.0) == pytest.approx(phi, abs=1e-12)
        assert sum(phis) == pytest.approx(score(table, x) - value[()], abs=1e-12)


def minimum(pairs):
    """Platt's parameters by plain Newton steps over all rows."""
    p, n = sum(y for _, y in pairs), sum(1 - y for _, y in pairs)
    high, low = CA.targets(p, n)
    a, b = CA.start(p, n)
    for _ in range(60):
        g = [0.0, 0.0]
        h = [[1e-12, 0.0], [0.0, 1e-12]]
        for f, y in pairs:
            q = 1 / (1 + math.exp(a * f + b))
            d, w = (high if y else low) - q, q * (1 - q)
            for i, u in enumerate((f, 1.0)):
                g[i] += u * d
                for j, v in enumerate((f, 1.0)):
                    h[i][j] += u * v * w
        det = h[0][0] * h[1][1] - h[0][1] ** 2
        a, b = a - (h[1][1] * g[0] - h[0][1] * g[1]) / det, b - (h[0][0] * g[1] - h[0][1] * g[0]) / det
    return a, b


def test_platt(spark):
    rng = random.Random(6)
    pairs = [(round(rng.random(), 2), 0) for _ in range(300)]
    pairs = [(f, int(rng.random() < f * f)) for f, _ in pairs]
    frame = spark.createDataFrame([*pairs, (None, 1), (0.5, None)], "raw_probability double, label int")
    found = CA.fit(frame)
    a, b = minimum(pairs)
    assert (found.a, found.b) == (pytest.approx(a, abs=1e-7), pytest.approx(b, abs=1e-7))
    assert found.positives + found.negatives == 300 and found.evaluations < 30
    again = CA.fit(frame.repartition(7))
    assert (again.a, again.b) == (found.a, found.b)
    assert TR.fit_platt(frame).a == found.a


@pytest.mark.parametrize("rows", [[], [(0.3, 1)], [(0.3, 0), (0.3, 0)], [(0.1, 0), (0.9, 1)], [(0.9, 0)] * 50 + [(0.1, 1)] * 50])
def test_platt_extremes(spark, rows):
    found = CA.fit(spark.createDataFrame(rows, "raw_probability double, label int"))
    assert math.isfinite(found.a) and math.isfinite(found.b) and found.evaluations < CA.EVALUATIONS
    if rows and len({f for f, _ in rows}) > 1:
        assert (found.a, found.b) == (pytest.approx(minimum(rows)[0], abs=1e-5), pytest.approx(minimum(rows)[1], abs=1e-5))
