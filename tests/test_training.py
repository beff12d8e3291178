import tempfile

import pytest

from riskline.plans import training as TR
from riskline.plans.catalog import transactions
from riskline.plans.scoring import score_batch


@pytest.fixture(scope="module")
def trained(spark, small_dir):
    out = tempfile.mkdtemp(prefix="riskline-train-")
    cfg = TR.CandidateConfig(rf_trees=5, rf_depth=4, gbt_iters=5, gbt_depth=3, lr_max_iter=50)
    return out, TR.train_job(spark, small_dir, out, cfg).first()


def test_report_row(trained):
    _, rep = trained
    assert rep["split_rows"] == {"train": 500, "selection": 150, "calibration": 100, "threshold": 100, "test": 150}
    ranked = rep["candidates"]
    assert {c["candidate"] for c in ranked} == {"logistic_regression", "random_forest", "gradient_boosted_trees",
                                                "logistic_undersampled"}
    assert [c["place"] for c in ranked] == [1, 2, 3, 4] and ranked[0]["candidate"] == rep["champion"]
    keys = [(c["expected_cost"], -c["pr_auc"]) for c in ranked]
    assert keys == sorted(keys)
    assert rep["review_threshold"] < rep["block_threshold"]
    assert len(rep["fingerprint"]) == 12 and rep["model_version"].endswith(rep["fingerprint"])
    assert {"expected_cost", "recall", "precision", "pr_auc", "roc_auc"} <= set(rep["test"])


def test_bundle_scores_with_packaged_thresholds(spark, small_dir, trained):
    out, rep = trained
    model = TR.load_model(spark, out)
    assert model.review_threshold == rep["review_threshold"]
    assert model.features == list(TR.C.MODEL_FEATURES)
    scored = score_batch(transactions(spark, small_dir), model=model)
    rows = scored.select("fraud_probability", "model_version").collect()
    assert all(0.0 <= r["fraud_probability"] <= 1.0 for r in rows)
    assert {r["model_version"] for r in rows} == {rep["model_version"]}


def test_missing_bundle_falls_back(spark):
    assert TR.load_model(spark, tempfile.mkdtemp() + "/none") is None
