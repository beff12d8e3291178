"""Plan-shape checks: no single-partition windows or cartesian products over row tables,
one exchange for all user windows, pushed-down filters and pruned scans."""

import re

from riskline.plans.catalog import transactions
from riskline.operators.features import online_features
from riskline.operators.readmodels import lookup
from riskline.sources.tables import read_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_single_user_exchange(spark, small_dir):
    p = plan(online_features(transactions(spark, small_dir)))
    assert "SinglePartition" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert len(exchanges) == 1 and "user_id" in exchanges[0] and "_pb" in exchanges[0]


def test_scan_prunes_columns(spark, small_dir):
    p = plan(transactions(spark, small_dir).select("transaction_id", "us"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "value" not in schema and "props" not in schema and "event_type" not in schema


def test_point_lookup_pushed_down(spark, small_dir):
    p = plan(lookup(read_table(spark, small_dir, "orders"), "o_orderkey", 7))
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,7)]" in p


def test_no_cartesian_products_in_registered_queries(spark, small_dir):
    import __spark_entry__ as E

    for name, fn in E.queries().items():
        p = plan(fn(spark, small_dir))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
