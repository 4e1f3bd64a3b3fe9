"""Published fixture expectations (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll.sources.fixtures import raw_transactions, transactions

from conftest import SF_MID, SF_SMALL


def one_item(rules):
    return rules.filter(F.size("antecedent") == 1)


def test_cleaning_count(spark):
    assert ops.clean_transactions(raw_transactions(spark, SF_MID)).count() == 45472
    bad = ops.clean_transactions(raw_transactions(spark, SF_MID)).filter(F.col("InvoiceDate") == "bad date")
    assert bad.count() == 914


def test_segments_and_rule_counts(spark):
    tx = transactions(spark, SF_MID)
    segs = ops.segment_customers(tx)
    assert {r[0]: r[1] for r in ops.segment_stats(segs).collect()} == {"1": 735, "2": 765}
    r = one_item(ops.mine_rules(ops.baskets(tx), 0.02, 0.17).rules)
    assert r.count() == 55 and r.select(F.col("antecedent")[0]).distinct().count() == 21
    assert one_item(ops.mine_rules(ops.baskets(tx), 0.027, 0.17).rules).count() == 24
    for label, n in (("1", 3), ("2", 193)):
        b = ops.baskets(tx).join(segs.filter(F.col("segment") == label).select("CustomerID"), "CustomerID",
                                 "left_semi")
        assert one_item(ops.mine_rules(b, 0.02, 0.17).rules).count() == n


def test_flagship_rule_count(spark):
    rules = ops.mine_rules(ops.baskets(transactions(spark, SF_SMALL)), 0.01, 0.2).rules
    assert one_item(rules).count() == 72


def test_type_rules_by_antecedent_size(spark):
    rules = ops.mine_rules(ops.baskets(transactions(spark, SF_MID, "p_type")), 0.01, 0.2).rules
    sizes = {r[0]: r[1] for r in rules.groupBy(F.size("antecedent")).count().collect()}
    assert sizes == {1: 30, 2: 60, 3: 60, 4: 30, 5: 6}


def test_latest_name_rows(spark):
    assert ops.load_products(raw_transactions(spark, SF_MID)).filter(F.col("StockCode") != "POST").count() == 25
