"""Segmentation."""

import math

import pytest
from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll.schema import CLEAN_SCHEMA

TX = [
    # InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
    ("1", "A", "a", 2, "d1", 1.0, "c1", "UK"),
    ("1", "A", "a", 1, "d1", 1.0, "c1", "UK"),
    ("1", "B", "b", 1, "d1", 4.0, "c1", "UK"),
    ("2", "A", "a", 5, "d2", 1.0, "c1", "UK"),
    ("3", "C", "c", 10, "d3", 2.0, "c2", "FR"),
    ("4", "C", "c", 1, "d4", 2.0, "c3", "FR"),
    ("5", "A", "a", 1, "d5", 1.0, "c3", "FR"),
]


def tx_df(spark):
    return spark.createDataFrame(TX, CLEAN_SCHEMA)


def test_purchase_features(spark):
    pf = {r["InvoiceNo"]: r for r in ops.purchase_features(tx_df(spark)).collect()}
    assert pf["1"]["pricePerPurchase"] == 7.0
    assert pf["1"]["productsPerPurchase"] == 2 and pf["1"]["quantityPerPurchase"] == 4
    pt = {r["InvoiceNo"]: r for r in ops.purchase_table(tx_df(spark)).collect()}
    for k, r in pf.items():
        assert pt[k]["productsPerPurchase"] == r["productsPerPurchase"]
        assert pt[k]["pricePerPurchase"] == r["pricePerPurchase"]
    assert pt["1"]["items"] == ["A", "B"]


def test_customer_features_and_segments(spark):
    cf = {r["CustomerID"]: r for r in ops.customer_features(tx_df(spark)).collect()}
    assert cf["c1"]["purchasesPerCustomer"] == 2 and cf["c2"]["purchasesPerCustomer"] == 1
    assert cf["c1"]["scaled_purchasesPerCustomer"] == 100.0
    assert cf["c2"]["scaled_purchasesPerCustomer"] == 1.0
    sim = {r["CustomerID"]: r["similarity"]
           for r in ops.customer_similarity(ops.customer_features(tx_df(spark))).collect()}
    # brute force: distance of the scaled vector from (1, 1, 1, 1)
    for c, r in cf.items():
        vec = [r[f"scaled_{k}"] for k in ("purchasesPerCustomer", "avgPricePerPurchasePerCustomer",
                                          "avgProductsPerPurchasePerCustomer",
                                          "avgQuantityPerPurchasePerCustomer")]
        assert sim[c] == pytest.approx(math.sqrt(sum((1.0 - v) ** 2 for v in vec)))
    avg = sum(sim.values()) / len(sim)
    seg = {r["CustomerID"]: r["segment"] for r in ops.segment_customers(tx_df(spark)).collect()}
    assert seg == {c: ("1" if s < avg else "2") for c, s in sim.items()}
    stats = {r["segment"]: r["noOfCustomers"] for r in ops.segment_stats(ops.segment_customers(tx_df(spark))).collect()}
    assert sum(stats.values()) == 3
    summary = ops.similarity_summary(ops.customer_similarity(ops.customer_features(tx_df(spark)))).first()
    assert summary["avg_similarity"] == pytest.approx(avg)


def test_degenerate_scale_gives_segment_2(spark):
    same = [("1", "A", "a", 1, "d", 1.0, "c1", "UK"), ("2", "A", "a", 1, "d", 1.0, "c2", "UK")]
    df = spark.createDataFrame(same, CLEAN_SCHEMA)
    segs = {r["segment"] for r in ops.segment_customers(df).collect()}
    assert segs == {"2"}
    feats = ops.customer_features(df, degenerate="min").first()
    assert feats["scaled_purchasesPerCustomer"] == 1.0


def test_update_segments(spark):
    old = spark.createDataFrame([("c1", "null"), ("c9", "null"), ("c9", "null")], "CustomerID string, segment string")
    new = spark.createDataFrame([("c1", "2"), ("c5", "1")], "CustomerID string, segment string")
    got = sorted(tuple(r) for r in ops.update_segments(old, new).collect())
    assert got == [("c1", "2"), ("c9", "null")]  # c5 is not added, duplicates removed


def test_segment_transactions(spark):
    segs = spark.createDataFrame([("c1", "1"), ("c2", "2")], "CustomerID string, segment string")
    dup = tx_df(spark).unionByName(tx_df(spark))
    out = ops.segment_transactions(dup, segs, "1")
    assert out.count() == 4  # c1's four distinct lines
    assert out.columns[-1] == "segment" and {r["segment"] for r in out.collect()} == {"1"}
    assert out.filter(F.col("CustomerID") != "c1").count() == 0
