import random

import pytest
from pyspark.sql import functions as F

from riskline.operators import readmodels as RM


def test_recent_rows_exact_with_small_buckets(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        user = f"u{rnd.randint(1, 3)}"
        us = rnd.randint(0, 50) * 1_000_000 * rnd.choice([1, 1, 60])  # many equal timestamps, gaps
        rows.append((f"t{i:03d}", user, us, float(i), "USD", "US", "m1", i % 100, "APPROVE"))
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, us long, amount double, currency string, "
                                     "country string, merchant_id string, risk_score int, decision string")
    targets = df.where(F.col("risk_score") % 7 == 0)
    got = RM.recent_user_rows(df, targets, n=4, bucket_us=5_000_000).collect()
    got_map = {}
    for r in got:
        got_map.setdefault(r["transaction_id"], []).append((r["recent_rank"], r["recent_transaction_id"]))
    for t in targets.collect():
        cands = [x for x in rows if x[1] == t["user_id"] and x[2] <= t["us"] and x[0] != t["transaction_id"]]
        cands.sort(key=lambda x: (x[2], x[0]), reverse=True)
        exp = [(k + 1, x[0]) for k, x in enumerate(cands[:4])]
        assert sorted(got_map.get(t["transaction_id"], [])) == exp, t["transaction_id"]


def test_feed_filter_validation():
    with pytest.raises(ValueError):
        RM.FeedFilter(min_risk=50, max_risk=10)
    with pytest.raises(ValueError):
        RM.FeedFilter(limit=501)
    with pytest.raises(ValueError):
        RM.FeedFilter(hours=0)
    assert RM.FeedFilter(country="us").country == "us"


def test_labels_are_dealt_by_number_of_rows(spark, small_dir, monkeypatch):
    from riskline.operators import segments
    from riskline.plans.store import build_store

    monkeypatch.setattr(segments, "TASK_ROWS", 64)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were large
    try:
        st = build_store(spark, small_dir)
        rows = st.txns.count()
        labels = st.labels(as_of=False)
        assert labels.rdd.getNumPartitions() >= -(-rows // 64)  # not joined by adaptive execution
        assert labels.count() == labels.select("transaction_id").distinct().count() == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
