import pytest

from riskline.operators.evaluate import compare_reports


def report(spark, version, cost, pr_auc, recall):
    return spark.createDataFrame([(version, float(cost), float(pr_auc), float(recall))],
                                 "model_version string, test_expected_cost double, test_pr_auc double, "
                                 "test_recall double")


@pytest.mark.parametrize("chall,expected", [
    ((100, 0.50, 0.60), True),        # all gates pass
    ((101, 0.50, 0.60), False),       # cost worse
    ((100, 0.48, 0.60), False),       # pr_auc below tolerance
    ((100, 0.50, 0.57), False),       # recall below tolerance
    ((100, 0.49, 0.58), True),        # exactly at both tolerances
])
def test_gates(spark, chall, expected):
    champ = report(spark, "a", 100, 0.50, 0.60)
    r = compare_reports(champ, report(spark, "b", *chall)).first()
    assert r["promotion_recommended"] is expected
    assert r["automatic_promotion"] is False


def test_non_numeric_rejected(spark):
    bad = spark.createDataFrame([("b", "cheap", 0.5, 0.5)], "model_version string, test_expected_cost string, "
                                                              "test_pr_auc double, test_recall double")
    with pytest.raises(TypeError):
        compare_reports(report(spark, "a", 1, 0.5, 0.5), bad)
