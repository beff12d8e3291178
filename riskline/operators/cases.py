"""Analyst workflow (T01, T02) and label upserts (S08) as window folds.

The alert state machine closes in window form because acceptance only depends
on (a) the first shape-valid RESOLVED request and (b) whether a shape-valid
IN_REVIEW request came earlier:

    current = OPEN       -> OPEN / IN_REVIEW / RESOLVED accepted
    current = IN_REVIEW  -> OPEN rejected (409), IN_REVIEW / RESOLVED accepted
    current = RESOLVED   -> only RESOLVED with the same resolution (note may change)

Shape errors come first (422): RESOLVED without resolution, resolution without
RESOLVED, note over 2000 characters, unknown status.  Unknown alert: 404.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskline import constants as C

NOTE_LIMIT = 2000


def fold_updates(alerts: DataFrame, updates: DataFrame) -> DataFrame:
    """T01 per update: alert_id, seq, at_us, status, resolution, accepted, code."""
    known = alerts.select("alert_id", F.lit(True).alias("_known"))
    u = updates.join(known, "alert_id", "left")
    status_ok = F.col("status").isin(*C.ALERT_STATUSES)
    res_ok = F.col("resolution").isNull() | F.col("resolution").isin(*C.RESOLUTIONS)
    pairing = (F.col("status") == "RESOLVED") == F.col("resolution").isNotNull()
    note_ok = F.col("analyst_note").isNull() | (F.length("analyst_note") <= NOTE_LIMIT)
    u = u.withColumn("_shape", F.coalesce(status_ok & res_ok & pairing & note_ok, F.lit(False)))

    whole = Window.partitionBy("alert_id")
    before = Window.partitionBy("alert_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    first_res = F.min(
        F.when(F.col("_shape") & (F.col("status") == "RESOLVED"), F.struct("seq", "resolution", "at_us"))
    ).over(whole)
    review_before = F.max(
        (F.col("_shape") & (F.col("status") == "IN_REVIEW")).cast("int")
    ).over(before)
    u = u.withColumn("_fr", first_res).withColumn("_rb", F.coalesce(review_before, F.lit(0)) == 1)

    fr_seq = F.col("_fr.seq")
    pre = fr_seq.isNull() | (F.col("seq") < fr_seq)
    accepted_pre = (F.col("status") != "OPEN") | ~F.col("_rb")
    accepted_post = (F.col("status") == "RESOLVED") & (F.col("resolution") == F.col("_fr.resolution"))
    state_ok = F.when(pre, accepted_pre).when(F.col("seq") == fr_seq, F.lit(True)).otherwise(accepted_post)
    code = (
        F.when(F.col("_known").isNull(), F.lit("404"))
        .when(~F.col("_shape"), F.lit("422"))
        .when(state_ok, F.lit("ok"))
        .otherwise(F.lit("409"))
    )
    return u.select(
        "alert_id", "seq", "at_us", "status", "resolution", "analyst_note",
        (code == "ok").alias("accepted"), code.alias("code"),
        F.col("_fr.resolution").alias("final_resolution"), F.col("_fr.at_us").alias("resolved_us"),
    )


def alert_state(alerts: DataFrame, folded: DataFrame) -> DataFrame:
    """T01 folded state per alert: status, last non-null note, resolution, resolved_us."""
    acc = folded.where(F.col("accepted"))
    state = acc.groupBy("alert_id").agg(
        F.max_by("status", "seq").alias("_status"),
        F.max_by("analyst_note", F.when(F.col("analyst_note").isNotNull(), F.col("seq"))).alias("_note"),
        F.max("final_resolution").alias("_resolution"),
        F.max("resolved_us").alias("_resolved_us"),
    )
    out = alerts.join(state, "alert_id", "left")
    return out.select(
        "alert_id", "transaction_id", "severity",
        F.coalesce(F.col("_status"), F.col("status")).alias("status"),
        F.col("_note").alias("analyst_note"),
        F.col("_resolution").alias("resolution"),
        F.col("_resolved_us").alias("resolved_us"),
        "created_us",
    )


def analyst_labels(state: DataFrame) -> DataFrame:
    """Each resolution writes one label (source analyst) at the resolution instant."""
    return state.where(F.col("resolution").isNotNull()).select(
        "transaction_id",
        (F.col("resolution") == "FRAUD").alias("is_fraud"),
        F.lit("analyst").alias("source"),
        F.col("resolved_us").alias("confirmed_us"),
        (F.col("alert_id") * 4 + 3).alias("label_seq"),
    )


def upsert_labels(label_log: DataFrame, transactions: DataFrame, as_of_us: int | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """(accepted latest-wins labels, rejected rows for unknown transactions).

    Latest wins by (confirmed_us, label_seq).  ``as_of_us`` keeps only labels
    that had arrived by then.
    """
    log = label_log if as_of_us is None else label_log.where(F.col("confirmed_us") <= F.lit(as_of_us))
    ids = transactions.select("transaction_id")
    accepted = log.join(ids, "transaction_id", "left_semi")
    rejected = log.join(ids, "transaction_id", "left_anti")
    latest = accepted.groupBy("transaction_id").agg(
        F.max_by(F.struct("is_fraud", "source", "confirmed_us"), F.struct("confirmed_us", "label_seq")).alias("l"),
        F.count(F.lit(1)).alias("versions"),
    ).select("transaction_id", "l.is_fraud", "l.source", "l.confirmed_us", "versions")
    return latest, rejected
