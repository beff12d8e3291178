import math

import pytest

from riskline.operators import drift as D


def ks_p_value_scalar(d: float, n: int, m: int, terms: int = 100) -> float:
    """Driver-side twin of ``ks_p_value`` for tests."""
    if d <= 0:
        return 1.0
    en = math.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    s = sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam) for k in range(1, terms + 1))
    return min(max(2 * s, 0.0), 1.0)


def col(spark, values, name="amount"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def test_identical_distributions(spark):
    a = col(spark, range(100))
    assert D.psi(a, a, "amount").first()["psi"] == pytest.approx(0.0)
    assert D.ks_statistic(a, a, "amount").first()["ks"] == pytest.approx(0.0)


def test_full_shift(spark):
    a, b = col(spark, range(100)), col(spark, [v + 1000 for v in range(100)])
    assert D.ks_statistic(a, b, "amount").first()["ks"] == pytest.approx(1.0)
    table = D.psi_table(a, b, "amount").collect()
    assert all(r["current_count"] == 0 for r in table)  # out-of-range values are dropped
    assert D.psi(a, b, "amount").first()["psi"] > 1.0
    assert D.psi(a, col(spark, [v + 5 for v in range(100)]), "amount").first()["psi"] < \
        D.psi(a, col(spark, [v + 50 for v in range(100)]), "amount").first()["psi"]


def test_constant_reference_gives_zero(spark):
    assert D.psi(col(spark, [3.0] * 50), col(spark, range(50)), "amount").first()["psi"] == 0.0


def test_js(spark):
    a = spark.createDataFrame([(c,) for c in "AABBC"], "country string")
    b = spark.createDataFrame([(c,) for c in "XXYZ"], "country string")
    assert D.js_divergence(a, a, "country").first()["js"] == pytest.approx(0.0)
    assert D.js_divergence(a, b, "country").first()["js"] == pytest.approx(math.log(2))


def test_report_needs_100_rows(spark):
    ref = spark.createDataFrame([(float(i), "US", i / 100) for i in range(200)],
                                "amount double, country string, fraud_probability double")
    cur99 = ref.limit(99)
    assert D.drift_report(ref, cur99, "v", 0, 1).count() == 0
    rep = D.drift_report(ref, ref, "v", 0, 1).first()
    assert rep["drift_detected"] is False and rep["rows"] == 200
    assert 0.0 <= rep["amount_ks_p_value"] <= 1.0


def test_p_value_series():
    assert ks_p_value_scalar(0.0, 10, 10) == 1.0
    assert ks_p_value_scalar(0.5, 100, 100) < 0.01
