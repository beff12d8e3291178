"""The scored "system of record" derived from the driver tables.

transactions -> scored predictions -> alerts -> analyst update log -> folded
alert state -> label log (delayed labels + analyst labels) -> latest labels.

Every part is a lazy plan that is built when a query asks for it.  Two scored
frames exist: ``decided`` (probability, score, decision, reasons; without the 24 h
distinct counts) and ``scored`` (with the packed snapshot).  Only the alerts, a
few narrow columns that feed the update log, the fold, the state and the labels, are
written once.  ``as_of_us`` is the latest event time (a scalar the read models
filter on).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators import cases
from riskline.operators.segments import window_tasks
from riskline.plans.scoring import alerts_from, prediction_rows, score_batch
from riskline.session import materialize, prepare
from riskline.sources.adapter import COMPRESSED_SCALE, label_log, transactions_from_events, update_log
from riskline.sources.tables import read_table


@dataclass
class CaseFrames:
    """What follows from a set of alerts."""

    spark: SparkSession
    alerts: DataFrame

    @cached_property
    def updates(self) -> DataFrame:
        return update_log(self.spark, self.alerts)

    @cached_property
    def folded(self) -> DataFrame:
        return cases.fold_updates(self.alerts, self.updates)

    @cached_property
    def state(self) -> DataFrame:
        return cases.alert_state(self.alerts, self.folded)


@dataclass
class Store:
    spark: SparkSession
    txns: DataFrame
    scale: int

    @cached_property
    def decided(self) -> DataFrame:
        return score_batch(self.txns, with_snapshot=False)

    @cached_property
    def scored(self) -> DataFrame:
        return score_batch(self.txns)

    @cached_property
    def predictions(self) -> DataFrame:
        """Decision columns only; ``snapshots`` has the whole contract."""
        return self.decided.select("transaction_id", "fraud_probability", "risk_score", "decision", "model_version",
                                   "rule_reasons")

    @cached_property
    def snapshots(self) -> DataFrame:
        return prediction_rows(self.scored)

    @cached_property
    def flagged(self) -> DataFrame:
        """Scored rows that raise an alert."""
        return self.decided.where(F.col("decision") != "APPROVE")

    @cached_property
    def alerts(self) -> DataFrame:
        return materialize(alerts_from(self.decided))

    @cached_property
    def cases(self) -> CaseFrames:
        return CaseFrames(self.spark, self.alerts)

    @cached_property
    def as_of_us(self) -> int:
        return int(self.txns.agg(F.max("us")).first()[0])

    @cached_property
    def tasks(self) -> int:
        return window_tasks(self.spark, self.txns.count())

    @cached_property
    def label_log(self) -> DataFrame:
        return self.label_log_of(self.txns, self.cases.state)

    def label_log_of(self, txns: DataFrame, state: DataFrame) -> DataFrame:
        return label_log(txns, C.DAY_US // self.scale).unionByName(cases.analyst_labels(state))

    def labels(self, as_of: bool = True) -> DataFrame:
        """Latest labels.  Partitions follow the number of rows, and so do those of joins by transaction with them."""
        known = self.txns.select("transaction_id").repartition(self.tasks, "transaction_id")
        latest, _ = cases.upsert_labels(self.label_log, known, self.as_of_us if as_of else None)
        return latest

    def labels_of(self, rows: DataFrame, state: DataFrame) -> DataFrame:
        """Latest labels of a few scored rows (a page)."""
        return cases.upsert_labels(self.label_log_of(rows, state), rows, self.as_of_us)[0]

    def rejected_labels(self) -> DataFrame:
        _, rejected = cases.upsert_labels(self.label_log, self.txns, None)
        return rejected


def build_store(spark: SparkSession, sf_dir: str, scale: int = COMPRESSED_SCALE) -> Store:
    prepare(spark)
    return Store(spark, transactions_from_events(read_table(spark, sf_dir, "events"), scale), scale)
