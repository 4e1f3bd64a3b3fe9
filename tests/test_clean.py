"""Cleaning and initial load."""

from tillroll import operators as ops
from tillroll.schema import RAW_SCHEMA
from tillroll.sources.fixtures import raw_transactions

from conftest import SF_SMALL

RAW = [
    # InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
    ("1", "A1", "first", "2", "12/1/2010 8:26", "2.5", "10", "UK"),      # valid
    ("C2", "A1", "cancel", "2", "12/1/2010 8:26", "2.5", "10", "UK"),    # cancelled invoice
    ("3", "POST", "postage", "1", "12/1/2010 9:00", "1.0", "10", "UK"),  # service code
    ("4", "", "blank code", "1", "12/1/2010 9:00", "1.0", "10", "UK"),
    ("5", "B2", "neg qty", "-1", "12/1/2010 9:00", "1.0", "10", "UK"),
    ("6", "B2", "bad qty", "n/a", "12/1/2010 9:00", "1.0", "10", "UK"),
    ("7", "B2", "fraction", "3.7", "12/1/2010 9:00", "1.0", "10", "UK"),
    ("8", "B2", "spaced", " 3 ", "12/1/2010 14:05", "1.0", "11", "UK"),  # try_cast trims
    ("9", "B2", "zero price", "1", "12/1/2010 9:00", "0.0", "11", "UK"),
    ("10", "B2", "no customer", "1", "12/1/2010 9:00", "1.0", None, "UK"),
    ("11", "B2", "blank customer", "1", "12/1/2010 9:00", "1.0", "", "UK"),
    ("12", "B2", "bad customer", "1", "12/1/2010 9:00", "1.0", "1x", "UK"),
    ("13", "B2", "no date", "1", None, "1.0", "12", "UK"),
    ("14", "B2", "bad date", "1", "bad date", "1.0", "12", "UK"),        # cleaning keeps it
]


def raw_df(spark):
    return spark.createDataFrame(RAW, RAW_SCHEMA)


def test_clean_rows(spark):
    out = ops.clean_transactions(raw_df(spark))
    got = sorted(r["InvoiceNo"] for r in out.collect())
    assert got == ["1", "14", "7", "8"]
    row = {r["InvoiceNo"]: r for r in out.collect()}["8"]
    assert row["Quantity"] == 3 and row["UnitPrice"] == 1.0
    assert dict(out.dtypes)["Quantity"] == "int" and dict(out.dtypes)["InvoiceDate"] == "string"


def test_load_products_latest_and_default(spark):
    rows = [
        ("1", "P1", "old name", "1", "1/5/2010 8:00", "1.5", "1", "UK"),
        ("2", "P1", "afternoon name", "1", "1/5/2010 14:00", "2.5", "1", "UK"),  # 24-hour parse
        ("3", "P2", "dated", "1", "1/5/2010 8:00", "3.5", "1", "UK"),
        ("4", "P2", "undated", "1", "garbage", "4.5", "1", "UK"),  # default 2010-12-01 08:34
        ("5", "P3", "tie b", "1", "2/2/2010 8:00", "5.5", "1", "UK"),
        ("6", "P3", "tie a", "1", "2/2/2010 8:00", "6.5", "1", "UK"),
        ("7", "P4", "priced zero", "1", "2/2/2010 8:00", "0", "1", "UK"),  # loader drops
        ("8", "P5", "cancel kept", "-3", "2/2/2010 8:00", "1.0", "2", "UK"),  # loader ignores qty
    ]
    out = {r["StockCode"]: (r["Description"], r["UnitPrice"])
           for r in ops.load_products(spark.createDataFrame(rows, RAW_SCHEMA)).collect()}
    assert out["P1"] == ("afternoon name", 2.5)
    assert out["P2"] == ("undated", 4.5)  # the default (Dec 2010) is the latest
    assert out["P3"] == ("tie b", 6.5)  # ties: greatest value of each column
    assert "P4" not in out and out["P5"] == ("cancel kept", 1.0)
    early = {r["StockCode"]: r["Description"]
             for r in ops.load_products(spark.createDataFrame(rows, RAW_SCHEMA),
                                        default_ts="1900-01-01 00:00:00").collect()}
    assert early["P2"] == "dated"


def test_load_customers_literal_null(spark):
    out = ops.load_customers(raw_df(spark)).collect()
    segs = {r["CustomerID"]: r["segment"] for r in out}
    assert set(segs) == {"10", "11", "12", "1x"}
    assert set(segs.values()) == {"null"}
    real_null = ops.load_customers(raw_df(spark), unsegmented=None).collect()
    assert {r["segment"] for r in real_null} == {None}


def test_fractional_quantities_are_truncated(spark):
    """As the original string-to-int cast: the fraction is cut off, other text gives null."""
    values = ["3.7", "3.", "3", "0.9", "-3.7", "n/a", "1.2.3", "", None, "7.5x", "2e3"]
    raw = spark.createDataFrame([("1", "A1", "d", v, "1/2/2010 3:04", "1.5", "9", "UK") for v in values],
                                "InvoiceNo string, StockCode string, Description string, Quantity string, "
                                "InvoiceDate string, UnitPrice string, CustomerID string, Country string")
    assert sorted(r.Quantity for r in ops.clean_transactions(raw).collect()) == [3, 3, 3]


def test_table_sees_appended_files(spark, tmp_path):
    from tillroll.sources.fixtures import table
    path = f"{tmp_path}/part.parquet"
    spark.range(10).write.parquet(path)
    assert table(spark, str(tmp_path), "part").count() == 10
    spark.range(25).write.mode("append").parquet(path)
    assert table(spark, str(tmp_path), "part").count() == 35


def test_latest_values_sort_no_lines(spark):
    """The aggregate over the lines is by hash; only its few rows are sorted."""
    plan = ops.load_products(raw_transactions(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    lines = plan[plan.rindex("Exchange hashpartitioning(StockCode"):] if "Exchange hashpartitioning(StockCode" in plan else plan
    assert "SortAggregate" not in lines.split("Exchange", 2)[1]


def test_flags_tell_the_lines_of_both_jobs(spark):
    raw = raw_transactions(spark, SF_SMALL)
    flagged = ops.flagged_lines(raw)
    assert flagged.where("_clean").count() == ops.clean_transactions(raw).count()
    table = ops.raw_purchase_table(raw)
    assert sorted(map(tuple, ops.customers_of(table).collect())) == sorted(map(tuple, ops.load_customers(raw).collect()))
    as_rows = lambda df: sorted((r["InvoiceNo"], tuple(r["items"]), round(r["pricePerPurchase"], 6), r["quantityPerPurchase"])
                                for r in df.collect())
    assert as_rows(ops.purchases_of(table)) == as_rows(ops.purchase_table(ops.clean_transactions(raw)))
