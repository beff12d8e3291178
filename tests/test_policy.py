import math

import pytest
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.functions.policy import Policy
from riskline.functions.reasons import reason_factors
from riskline.plans.scoring import apply_policy

BASE = {n: 0.0 for n in C.ONLINE_FEATURES}


def decide(spark, p, **feats):
    row = dict(BASE, **feats, fraud_probability=p)
    cols = list(row)
    df = spark.createDataFrame([tuple(float(row[c]) for c in cols)], ", ".join(f"{c} double" for c in cols))
    return apply_policy(df).select("decision", "risk_score", "rule_reasons").first()


@pytest.mark.parametrize("p,expected", [(0.39, "APPROVE"), (0.40, "MANUAL_REVIEW"), (0.70, "BLOCK")])
def test_threshold_boundaries(spark, p, expected):
    assert decide(spark, p)["decision"] == expected


def test_escalation_to_block(spark):
    r = decide(spark, 0.1, impossible_travel=1.0, new_device=1.0)
    assert r["decision"] == "BLOCK"
    assert r["rule_reasons"] == [C.RULE_IMPOSSIBLE_TRAVEL, C.RULE_TRAVEL_NEW_DEVICE]


def test_rules_lift_approve_never_downgrade(spark):
    assert decide(spark, 0.1, transactions_last_5m=8.0)["decision"] == "MANUAL_REVIEW"
    assert decide(spark, 0.9, amount_vs_user_average=9.0)["decision"] == "BLOCK"
    assert decide(spark, 0.1, amount_vs_user_average=7.99)["rule_reasons"] == []


@pytest.mark.parametrize("p", [0.005, 0.015, 0.125, 0.625, 0.5, 0.994])
def test_half_even_score(spark, p):
    assert decide(spark, p)["risk_score"] == round(p * 100)


@pytest.mark.parametrize("p", [1.1, -0.01, float("nan")])
def test_out_of_range_probability_fails(spark, p):
    with pytest.raises(Exception):
        decide(spark, p)


def test_policy_config_checks():
    with pytest.raises(ValueError):
        Policy(0.8, 0.7)
    assert Policy.resolve(0.3, 0.6).review_threshold == 0.3
    assert Policy.resolve(0.3, 0.6, override_block=0.9).block_threshold == 0.9


def test_reason_codes_order_slice_then_drop(spark):
    feats = dict(BASE, impossible_travel=1.0, new_device=1.0, new_country=1.0, transactions_last_5m=3.0,
                 amount_vs_user_average=1.0, ip_changed=1.0)
    cols = list(feats)
    df = spark.createDataFrame([tuple(feats[c] for c in cols)], ", ".join(f"{c} double" for c in cols))
    out = df.select(reason_factors({c: F.col(c) for c in cols}, friendly=False).alias("r")).first()["r"]
    names = [x["feature"] for x in out]
    # 2.0, 0.8, 0.7, 0.66, 0.12 kept (top 5); ip_changed 0.3 beats 0.12 -> order by |impact|
    assert names == ["impossible_travel", "new_device", "new_country", "transactions_last_5m", "ip_changed"]
    assert [x["impact"] for x in out] == [2.0, 0.8, 0.7, 0.66, 0.3]
    zero = dict(BASE, amount_vs_user_average=0.0)
    df0 = spark.createDataFrame([tuple(zero[c] for c in cols)], ", ".join(f"{c} double" for c in cols))
    assert df0.select(reason_factors({c: F.col(c) for c in cols}).alias("r")).first()["r"] == []
