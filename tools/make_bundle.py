"""Writes the small forest of ``riskline/models/forest.json``: trained on a data folder, read by the query ``score_with_model``."""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskline import constants as C  # noqa: E402
from riskline.functions.ensemble import node_table  # noqa: E402
from riskline.operators import evaluate as EV  # noqa: E402
from riskline.operators.ordering import chronological_split  # noqa: E402
from riskline.plans import training as TR  # noqa: E402
from riskline.plans.catalog import transactions  # noqa: E402
from riskline.session import local_session, materialize  # noqa: E402


def main(sf_dir: str, out: str) -> None:
    spark = local_session()
    frame = materialize(chronological_split(materialize(TR.training_frame(transactions(spark, sf_dir)))))
    of = {name: frame.where(f"split = '{name}'") for name, _ in C.SPLIT_FRACTIONS}
    cfg = TR.CandidateConfig(rf_trees=5, rf_depth=4, rf_min_leaf=20)
    pipe, weighting = TR.candidates(cfg, list(C.MODEL_FEATURES), 1.0)["random_forest"]
    fitted = TR.Fitted("random_forest", pipe, weighting).fit(of["train"].unionByName(of["selection"]))
    platt = TR.fit_platt(TR.positive_probability(fitted, of["calibration"]))
    seen = TR.positive_probability(fitted, of["threshold"]).withColumn("probability", platt.apply(TR.F.col("raw_probability")))
    best = EV.optimize_thresholds(seen).first()
    bundle = {"version": "small-forest-1", "review": best["review_threshold"], "block": best["block_threshold"],
              "platt_a": platt.a, "platt_b": platt.b, "table": json.loads(node_table(fitted, list(C.MODEL_FEATURES)).to_json())}
    with open(out, "w") as f:
        json.dump(bundle, f)
        f.write("\n")


if __name__ == "__main__":
    main(*sys.argv[1:3])
