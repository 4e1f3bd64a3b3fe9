"""Driver contract and plan shape (no Python UDFs, no unbounded cartesian products)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tillroll.oracle import build
from tillroll.queries import QUERIES

from conftest import SF_SMALL


def test_entry_rows(spark):
    df = entry(spark)
    assert df.columns == ["StockCode", "recs"]
    assert df.count() > 0


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) == set(build()) <= set(queries())
    assert set(build()) <= set(oracle_sql())


PLAN_QUERIES = ["clean_transactions", "load_products", "customer_segments", "update_segments",
                "baskets", "frequently_bought", "embedding_euclidean", "segment_transactions"]


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_plans_are_jvm_only(spark, name):
    df = queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert bad not in plan, f"{name}: {bad}"
    # the only nested-loop joins are against one-row aggregates
    if "BroadcastNestedLoopJoin" in plan:
        assert name in ("customer_segments", "update_segments", "segment_transactions")


def test_fixture_join_feeds_basket_grouping_without_reshuffle(spark):
    from tillroll import operators as ops
    from tillroll.sources.fixtures import transactions
    plan = ops.baskets(transactions(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    # exactly the two join-input exchanges; the purchase-key aggregation reuses them
    assert plan.count("Exchange hashpartitioning") == 2
