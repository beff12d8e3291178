import pytest
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators import attribution as AT

FEATS = AT.HEURISTIC_INPUTS


def df(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, " + ", ".join(f"{f} double" for f in FEATS))


def f_heuristic(r):
    import math
    logit = (-4 + min(r[0], 15) * 0.12 + min(r[1], 10) * 0.22 + r[2] * 0.8 + r[3] * 0.7 + r[4] * 2.0)
    return 1 / (1 + math.exp(-logit))


def test_additivity_and_ranking(spark):
    x = [("a", 9.0, 6.0, 1.0, 0.0, 1.0), ("b", 1.0, 0.0, 0.0, 1.0, 0.0)]
    bg = [(f"g{i}", 1.0 + i % 3, float(i % 4), 0.0, float(i % 2), 0.0) for i in range(20)]
    out = AT.permutation_attribution(df(spark, x), df(spark, bg).drop("transaction_id"), FEATS,
                                     permutations=6, limit=len(FEATS)).collect()
    mean_bg = sum(f_heuristic(r[1:]) for r in bg) / len(bg)
    for tid, *vals in x:
        phis = [r["raw_phi"] for r in out if r["transaction_id"] == tid]
        assert sum(phis) == pytest.approx(f_heuristic(vals) - mean_bg, abs=1e-12)
    a = sorted((r for r in out if r["transaction_id"] == "a"), key=lambda r: r["position"])
    assert a[0]["feature"] == "impossible_travel" and a[0]["direction"] == "increases_risk"
    assert [abs(r["raw_phi"]) for r in a] == sorted([abs(r["raw_phi"]) for r in a], reverse=True)


def test_background_is_bounded(spark):
    big = df(spark, [(f"g{i}", 1.0, 0.0, 0.0, 0.0, 0.0) for i in range(7)]).drop("transaction_id")
    x = df(spark, [("a", 1.0, 0.0, 0.0, 0.0, 0.0)])
    for attribute in (AT.permutation_attribution, AT.exact_attribution):
        with pytest.raises(ValueError):
            attribute(x, big, FEATS, max_background=6)
        assert attribute(x, big, FEATS, max_background=7).count() > 0


def test_exact_attribution_against_all_orders(spark):
    """The Shapley value is the mean step over all orders of the features."""
    from itertools import permutations

    x = [("a", 9.0, 6.0, 1.0, 0.0, 1.0), ("b", 1.0, 0.0, 0.0, 1.0, 0.0)]
    bg = [(f"g{i}", 1.0 + i % 3, float(i % 4), 0.0, float(i % 2), 0.0) for i in range(5)]
    got = {(r["transaction_id"], r["feature"]): r["raw_phi"]
           for r in AT.exact_attribution(df(spark, x), df(spark, bg).drop("transaction_id"), FEATS, limit=5).collect()}
    for tid, *vals in x:
        want = dict.fromkeys(FEATS, 0.0)
        for order in permutations(range(5)):
            for b in bg:
                mixed = list(b[1:])
                for j in order:
                    before = f_heuristic(mixed)
                    mixed[j] = vals[j]
                    want[FEATS[j]] += (f_heuristic(mixed) - before) / 120 / len(bg)
        for f in FEATS:
            assert got[tid, f] == pytest.approx(want[f], abs=1e-12)


def test_explain_pending_snapshot_then_recompute(spark):
    snap_type = "struct<" + ", ".join(f"{f}: double" for f in C.ONLINE_FEATURES) + ">"
    full = {f: 0.0 for f in C.ONLINE_FEATURES}
    full.update(impossible_travel=1.0, amount_vs_user_average=2.0)
    preds = spark.createDataFrame([("t1", full), ("t2", None)], f"transaction_id string, feature_snapshot {snap_type}")
    alerts = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "transaction_id string")
    rec = spark.createDataFrame([("t2", *[1.0 if f == "new_device" else 0.0 for f in C.ONLINE_FEATURES])],
                                "transaction_id string, " + ", ".join(f"{f} double" for f in C.ONLINE_FEATURES))
    out = AT.explain_pending(alerts, preds, rec).collect()
    methods = {r["transaction_id"]: r["method"] for r in out}
    assert methods == {"t1": "reason_codes:snapshot", "t2": "reason_codes:recomputed", "t3": None}
    t1 = sorted((r for r in out if r["transaction_id"] == "t1"), key=lambda r: r["position"])
    assert [r["impact"] for r in t1] == [2.0, 0.24]
