"""Chained pipeline (C7) and lineage independence of mined rules."""

import sys

from tillroll import operators as ops
from tillroll.plans.pipeline import GENERAL_LABEL, SEGMENT_LABELS, pipeline_recommendations, run_pipeline
from tillroll.sources.fixtures import raw_transactions, transactions

from conftest import SF_SMALL


def as_dict(df):
    return {(r["segment"], r["StockCode"]): r["recs"] for r in df.collect()}


def test_pipeline_leaves_nothing_cached_and_clears_its_scratch(spark):
    from pathlib import Path

    from tillroll.session import clear_scratch, scratch_root
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    a = as_dict(pipeline_recommendations(raw_transactions(spark, SF_SMALL), min_support=0.014, min_confidence=0.117))
    assert {s for s, _ in a} == {GENERAL_LABEL, *SEGMENT_LABELS}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    root = Path(scratch_root(spark).removeprefix("file:"))
    # One stored copy of the item sets.
    assert len(list(root.glob("purchases-*"))) >= 1 and not list(root.glob("tagged*"))
    clear_scratch(spark)
    assert not root.exists()


def test_pipeline_parts(spark):
    res = run_pipeline(raw_transactions(spark, SF_SMALL), min_support=0.02, min_confidence=0.15)
    customers = res["customers"]
    # every customer of the initial load is kept; segmented ones carry "1"/"2"
    assert customers.count() == ops.load_customers(raw_transactions(spark, SF_SMALL)).count()
    assert {r["segment"] for r in customers.collect()} <= {"1", "2", "null"}
    for label in SEGMENT_LABELS:
        gen = {r["StockCode"] for r in res[GENERAL_LABEL].collect()}
        seg = {r["StockCode"] for r in res[label].collect()}
        assert gen <= seg  # filled from the general lists


def test_rules_survive_cache_loss(spark):
    b = ops.baskets(transactions(spark, SF_SMALL, "p_type"))
    rs = ops.mine_rules(b, 0.01, 0.2)
    before = sorted(map(tuple, rs.rules.select("antecedent", "consequent", "confidence").collect()))
    spark.catalog.clearCache()
    plan = rs.rules._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan  # read from the checkpoint, not recomputed from the tables
    after = sorted(map(tuple, rs.rules.select("antecedent", "consequent", "confidence").collect()))
    assert before == after and len(after) > 0


def test_pipeline_reads_the_raw_lines_once(spark, monkeypatch):
    """Whatever the pipeline writes or returns, one plan scans the line table, once."""
    from tillroll.plans import pipeline, strategies
    plans, real = [], strategies.cut_lineage

    def seen(s, df, name, *a):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(s, df, name, *a)
    for mod in (pipeline, sys.modules["tillroll.operators.baskets"], sys.modules["tillroll.operators.segment_recs"]):
        monkeypatch.setattr(mod, "cut_lineage", seen)
    out = pipeline_recommendations(raw_transactions(spark, SF_SMALL), min_support=0.02, min_confidence=0.15)
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert sum("l_partkey" in p for p in plans) == 1 and len(plans) > 4
