"""Every registered query against its SQL on the test tables."""

import oracle
import pytest

import __spark_entry__ as entry
from quotemill.plans import analytics, ingestion, oracles

@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    own = set(ingestion.QUERIES | analytics.QUERIES)
    assert own == set(oracles.SQL)
    assert own <= set(entry.queries())
    assert not set(entry.oracle_sql()) - set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert slow not in plan
    ours = oracle.spark_rows(df)
    theirs = oracle.duck_rows(duck, oracles.SQL[name])
    assert ours == theirs


def test_entry_is_lazy_and_typed(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["id", "trade_conditions", "last_price", "symbol", "datetime", "volume"]
    assert rows.count() == 1000
