"""Driver contract + every registered query against its DuckDB twin at sf0.001."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1000
    assert df.columns == ["transaction_id", "fraud_probability", "risk_score", "decision", "rule_reasons",
                          "model_version"]
    assert {r["decision"] for r in rows} == {"APPROVE", "MANUAL_REVIEW", "BLOCK"}


def test_every_query_has_a_twin_or_is_documented():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_twin(spark, con, name):
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)


def test_twin_column_types_match(spark, con):
    from tools.check_types import SPARK_TO_DUCK

    for name, sql in E.oracle_sql().items():
        sdf = E.queries()[name](spark, SF)
        s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
        d_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        assert s_types == d_types, name
