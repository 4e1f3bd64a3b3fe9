"""Sources and sinks (S1-S7): delimited round trip, JDBC into embedded Derby, table swap."""

import os
import tempfile

from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll.schema import CLEAN_SCHEMA, CUSTOMERS_SCHEMA, RAW_COLUMNS
from tillroll.sources import (
    read_delimited, read_delimited_with_schema, read_table, replace_table, write_delimited, write_jdbc,
    write_partitioned_recommendations,
)
from tillroll.sources.fixtures import raw_transactions

from conftest import SF_SMALL


def fresh_dir():
    return tempfile.mkdtemp(prefix="tillroll-io-", dir="/tmp")


def test_raw_header_round_trip_and_clean(spark):
    raw = raw_transactions(spark, SF_SMALL)
    path = os.path.join(fresh_dir(), "raw")
    write_delimited(raw, path, header=True)
    back = read_delimited(spark, path, header=True)
    assert back.columns == RAW_COLUMNS
    # CSV cannot tell "" from null: both read back as null, and cleaning drops both
    assert ops.clean_transactions(back).count() == ops.clean_transactions(raw).count()


def test_schema_round_trip(spark):
    clean = ops.clean_transactions(raw_transactions(spark, SF_SMALL))
    path = os.path.join(fresh_dir(), "clean")
    write_delimited(clean, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    back = read_delimited_with_schema(spark, path, CLEAN_SCHEMA)
    assert back.schema == CLEAN_SCHEMA
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, clean.collect()))


def test_malformed_field_is_null_with_corrupt_column(spark):
    path = os.path.join(fresh_dir(), "bad")
    os.makedirs(path)
    with open(os.path.join(path, "x.tsv"), "w") as fh:
        fh.write("1\tA1\td\tnotanint\td\t1.5\t7\tUK\n")
    df = read_delimited_with_schema(spark, path, CLEAN_SCHEMA, corrupt_column="_bad")
    r = df.first()
    assert r["Quantity"] is None and r["UnitPrice"] == 1.5 and r["_bad"] is not None


def test_jdbc_embedded_derby(spark):
    df = spark.createDataFrame([("c1", "1"), ("c2", "2")], CUSTOMERS_SCHEMA)
    url = "jdbc:derby:memory:tillroll_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    write_jdbc(df, url, "customers", props)
    write_jdbc(df.filter(F.col("segment") == "2"), url, "customers", props)  # overwrite
    back = spark.read.jdbc(url, "customers", properties=props)
    assert [tuple(r) for r in back.collect()] == [("c2", "2")]


def test_replace_table_from_itself(spark):
    base = fresh_dir()
    path, staging = os.path.join(base, "customers"), os.path.join(base, "customers-staging")
    write_delimited(spark.createDataFrame([("c1", "null"), ("c2", "null")], CUSTOMERS_SCHEMA), path)
    current = read_delimited_with_schema(spark, path, CUSTOMERS_SCHEMA)
    segs = spark.createDataFrame([("c1", "1")], CUSTOMERS_SCHEMA)
    out = replace_table(spark, ops.update_segments(current, segs), path, staging, CUSTOMERS_SCHEMA)
    assert sorted(map(tuple, out.collect())) == [("c1", "1"), ("c2", "null")]


def test_partitioned_recommendations(spark):
    path = os.path.join(fresh_dir(), "recs")
    gen = spark.createDataFrame([("A", "b,c", "gen")], "StockCode string, recs string, segment string")
    seg = spark.createDataFrame([("A", "c", "1")], "StockCode string, recs string, segment string")
    write_partitioned_recommendations(gen, path)
    write_partitioned_recommendations(seg, path)  # dynamic overwrite keeps segment=gen
    assert {d for d in os.listdir(path) if d.startswith("segment=")} == {"segment=1", "segment=gen"}


def test_replace_is_seen_whole_or_not_at_all(spark, monkeypatch):
    """A failure while the new version is written, or before it is committed, leaves the old table."""
    import pytest

    from tillroll.sources import delimited
    base = fresh_dir()
    path = os.path.join(base, "customers")
    rows = lambda n: spark.createDataFrame([(f"c{k}", str(n)) for k in range(3)], CUSTOMERS_SCHEMA)
    read = lambda: sorted(map(tuple, read_table(spark, path, CUSTOMERS_SCHEMA).collect()))
    want = lambda n: [(f"c{k}", str(n)) for k in range(3)]
    write_delimited(rows(0), path)
    assert read() == want(0)
    replace_table(spark, rows(1), path, os.path.join(base, "v1"), CUSTOMERS_SCHEMA)
    assert read() == want(1)
    broken = rows(2).withColumn("segment", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        replace_table(spark, broken, path, os.path.join(base, "v2"), CUSTOMERS_SCHEMA)
    assert read() == want(1)
    with monkeypatch.context() as m:
        m.setattr(delimited, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            replace_table(spark, rows(3), path, os.path.join(base, "v3"), CUSTOMERS_SCHEMA)
    assert read() == want(1)
    old = read_table(spark, path, CUSTOMERS_SCHEMA)
    replace_table(spark, rows(4), path, os.path.join(base, "v4"), CUSTOMERS_SCHEMA)
    assert read() == want(4) and sorted(map(tuple, old.collect())) == want(1)  # those who read on are not disturbed
    write_delimited(rows(5), path)
    assert read() == want(5)
