from riskline.operators import cases


def run(spark, updates):
    alerts = spark.createDataFrame([(1, "t1", "HIGH", "OPEN", 0)],
                                   "alert_id long, transaction_id string, severity string, status string, created_us long")
    log = spark.createDataFrame(updates, "alert_id long, seq long, at_us long, status string, resolution string, "
                                         "analyst_note string")
    folded = cases.fold_updates(alerts, log)
    codes = [r["code"] for r in folded.orderBy("alert_id", "seq").collect()]
    state = cases.alert_state(alerts, folded).first()
    return codes, state, cases.analyst_labels(cases.alert_state(alerts, folded)).collect()


def test_transition_table(spark):
    codes, state, labels = run(spark, [
        (1, 1, 10, "IN_REVIEW", None, "looking"),
        (1, 2, 20, "OPEN", None, None),                # in review -> open: 409
        (1, 3, 30, "RESOLVED", None, None),            # missing resolution: 422
        (1, 4, 40, "RESOLVED", "FRAUD", "confirmed"),  # ok, writes label
        (1, 5, 50, "RESOLVED", "FRAUD", None),         # same resolution: ok, no second label
        (1, 6, 60, "RESOLVED", "LEGITIMATE", None),    # relabel: 409
        (2, 1, 70, "IN_REVIEW", None, None),           # unknown alert: 404
    ])
    assert codes == ["ok", "409", "422", "ok", "ok", "409", "404"]
    assert state["status"] == "RESOLVED" and state["resolution"] == "FRAUD"
    assert state["analyst_note"] == "confirmed" and state["resolved_us"] == 40
    assert len(labels) == 1 and labels[0]["is_fraud"] is True and labels[0]["confirmed_us"] == 40


def test_open_stays_open_and_note_kept(spark):
    codes, state, labels = run(spark, [
        (1, 1, 10, "OPEN", None, "first"),
        (1, 2, 20, "OPEN", "FRAUD", None),             # resolution without RESOLVED: 422
        (1, 3, 30, "IN_REVIEW", None, None),           # null note keeps the old note
        (1, 4, 40, "IN_REVIEW", None, "x" * 2001),     # note too long: 422
    ])
    assert codes == ["ok", "422", "ok", "422"]
    assert state["status"] == "IN_REVIEW" and state["analyst_note"] == "first" and labels == []


def test_label_upsert_latest_wins_and_rejects(spark):
    tx = spark.createDataFrame([("t1",), ("t2",)], "transaction_id string")
    log = spark.createDataFrame([
        ("t1", True, "chargeback", 10, 1), ("t1", False, "analyst", 20, 2), ("t2", True, "chargeback", 5, 3),
        ("zz", True, "chargeback", 1, 4)], "transaction_id string, is_fraud boolean, source string, "
                                           "confirmed_us long, label_seq long")
    latest, rejected = cases.upsert_labels(log, tx)
    got = {r["transaction_id"]: (r["is_fraud"], r["versions"]) for r in latest.collect()}
    assert got == {"t1": (False, 2), "t2": (True, 1)}
    assert [r["transaction_id"] for r in rejected.collect()] == ["zz"]
    as_of, _ = cases.upsert_labels(log, tx, as_of_us=15)
    assert {r["transaction_id"]: r["is_fraud"] for r in as_of.collect()} == {"t1": True, "t2": True}
