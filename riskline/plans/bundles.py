"""A trained model as columns, from a bundle of one JSON document (node table, calibration, thresholds)."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.functions.ensemble import NodeTable, node_table, raw_probability
from riskline.plans.training import Calibrator, TrainedModel

#: A small forest that comes with the library (``tools/make_bundle.py`` makes it).
SMALL_FOREST = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "models", "forest.json")


@dataclass
class ColumnModel:
    """What ``score_batch`` takes as a model; scoring adds columns and runs no ML transformer."""

    table: NodeTable
    calibrator: Calibrator
    version: str
    review_threshold: float
    block_threshold: float

    @property
    def features(self) -> list[str]:
        return self.table.features

    def score(self, feats: DataFrame) -> DataFrame:
        missing = [f for f in self.features if f not in feats.columns]
        rows = feats.select("*", *[F.lit(0.0).alias(f) for f in missing], F.lit(self.version).alias("model_version"))
        rows = rows.withColumn("raw_probability", raw_probability(self.table))
        return rows.withColumn("fraud_probability", self.calibrator.apply(F.col("raw_probability"))).drop(*missing)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "review": self.review_threshold, "block": self.block_threshold,
                           "platt_a": self.calibrator.a, "platt_b": self.calibrator.b, "table": json.loads(self.table.to_json())})

    @staticmethod
    def from_json(text: str) -> ColumnModel:
        d = json.loads(text)
        return ColumnModel(NodeTable(**d["table"]), Calibrator(d["platt_a"], d["platt_b"]), d["version"], d["review"], d["block"])


def as_columns(model: TrainedModel) -> ColumnModel:
    """A model that was trained or loaded with Spark ML, as columns."""
    return ColumnModel(node_table(model.pipeline, model.features), model.calibrator, model.version, model.review_threshold, model.block_threshold)


def small_forest() -> ColumnModel:
    with open(SMALL_FOREST) as f:
        return ColumnModel.from_json(f.read())
