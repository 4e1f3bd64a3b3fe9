"""Retail-shaped views over the TPC-H-style test tables.

``transactions`` gives typed, clean purchase lines; ``raw_transactions`` gives
the same lines as all-string text with deterministic dirt (cancelled
invoices, service codes, blanks, malformed numbers and dates) for the
cleaning and loading jobs.

Join order is chosen for scale: orders meet customer and nation first,
lineitem meets part on the part key, and the two halves meet on the
invoice text.  The last join leaves the lines partitioned by InvoiceNo,
which every later purchase-level aggregate reuses.  Small dimension tables (nation, and part while its file is under
the broadcast threshold) are broadcast by Catalyst from file statistics; AQE
re-plans at run time from the exchanged sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schema import (
    COUNTRY, CUSTOMER_ID, DESCRIPTION, INVOICE_DATE, INVOICE_NO, QUANTITY,
    STOCK_CODE, UNIT_PRICE,
)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``, with its files as they are now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}


def _halves(spark: SparkSession, sf_dir: str, item: str, invoice=None) -> tuple[DataFrame, DataFrame]:
    """The two sides of the line join, each keyed by the invoice text.

    ``bought``: lineitem with its part columns; ``buyer``: orders with the
    customer's nation.  ``invoice`` maps an order-key column to the invoice
    text; it must be one-to-one.
    """
    invoice = invoice or (lambda k: k.cast("string"))
    orders = table(spark, sf_dir, "orders").select(
        invoice(F.col("o_orderkey")).alias(INVOICE_NO), "o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col(item).alias("_item"))
    lineitem = table(spark, sf_dir, "lineitem").select(
        invoice(F.col("l_orderkey")).alias(INVOICE_NO), "l_orderkey", "l_partkey", "l_quantity",
        "l_extendedprice")

    buyer = (orders.join(customer, orders.o_custkey == customer.c_custkey)
             .join(nation, customer.c_nationkey == nation.n_nationkey)
             .select(INVOICE_NO, "o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    bought = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    return bought, buyer


def _lines(spark: SparkSession, sf_dir: str, item: str, invoice=None) -> DataFrame:
    """One row per line item with its order, customer, nation and part columns.

    The two halves join on the invoice text itself.  The join output is then
    hash-partitioned by InvoiceNo, so grouping by the purchase key (which
    starts with InvoiceNo) needs no further shuffle.
    """
    bought, buyer = _halves(spark, sf_dir, item, invoice)
    return bought.join(buyer, INVOICE_NO)


def transactions(spark: SparkSession, sf_dir: str, item: str = "p_brand") -> DataFrame:
    """Clean, typed transactions.  ``item`` picks the part column used as StockCode.

    InvoiceDate is the order timestamp; it only serves as part of the
    purchase key.
    """
    return _lines(spark, sf_dir, item).select(
        F.col(INVOICE_NO),
        F.col("_item").alias(STOCK_CODE),
        F.col("p_name").alias(DESCRIPTION),
        F.col("l_quantity").cast("int").alias(QUANTITY),
        F.col("o_orderdate").alias(INVOICE_DATE),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias(UNIT_PRICE),
        F.col("o_custkey").cast("string").alias(CUSTOMER_ID),
        F.col("n_name").alias(COUNTRY),
    )


# The deterministic dirt of the raw view (moduli, markers and
# the date text pattern), shared with the SQL oracle.
RAW_DATE_PATTERN = "M/d/yyyy H:mm"


def _raw_invoice(k):
    """Invoice text of the raw view: cancelled orders carry a "C" prefix."""
    return F.when(k % 23 == 0, F.concat(F.lit("C"), k.cast("string"))).otherwise(k.cast("string"))


def raw_transactions(spark: SparkSession, sf_dir: str, item: str = "p_brand") -> DataFrame:
    """All-string purchase lines with deterministic dirt.

    Each column's dirt is computed on the side of the join that owns its
    inputs (order-level text on the orders side, line-level text on the
    lineitem side), so predicates on those columns -- the cleaning and
    loading filters -- are pushed below the join and drop rows before the
    shuffle.
    """
    bought, buyer = _halves(spark, sf_dir, item, invoice=_raw_invoice)
    ok = F.col("l_orderkey")
    pk = F.col("l_partkey")
    qty = F.col("l_quantity").cast("int").cast("string")
    lines = bought.select(
        F.col(INVOICE_NO),
        F.when(pk % 29 == 0, F.lit("POST")).when(pk % 31 == 0, F.lit(""))
         .otherwise(F.col("_item")).alias(STOCK_CODE),
        F.col("p_name").alias(DESCRIPTION),
        F.when(ok % 19 == 0, F.concat(F.lit("-"), qty))
         .when(ok % 37 == 0, F.lit("n/a"))
         .when(ok % 67 == 0, F.concat(qty, F.lit(".7"))).otherwise(qty).alias(QUANTITY),
        F.when(pk % 41 == 0, F.lit("0.0"))
         .otherwise(F.concat(F.floor(F.col("l_extendedprice") / F.col("l_quantity"))
                             .cast("bigint").cast("string"), F.lit(".5"))).alias(UNIT_PRICE),
    )
    ok = F.col("o_orderkey")
    ck = F.col("o_custkey")
    orders = buyer.select(
        F.col(INVOICE_NO),
        F.when(ok % 53 == 0, F.lit("bad date"))
         .when(ok % 59 == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format(F.col("o_orderdate"), RAW_DATE_PATTERN)).alias(INVOICE_DATE),
        F.when(ck % 43 == 0, F.lit(None).cast("string")).when(ck % 47 == 0, F.lit(""))
         .otherwise(ck.cast("string")).alias(CUSTOMER_ID),
        F.col("n_name").alias(COUNTRY),
    )
    return lines.join(orders, INVOICE_NO).select(
        INVOICE_NO, STOCK_CODE, DESCRIPTION, QUANTITY, INVOICE_DATE, UNIT_PRICE, CUSTOMER_ID, COUNTRY)
