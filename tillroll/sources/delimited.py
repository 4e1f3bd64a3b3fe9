"""Delimited text and JDBC sources and sinks.

Reads never infer a schema: either every column is a string (``read_delimited``)
or a declared ``StructType`` is given (``read_delimited_with_schema``).
Writes leave the partitioning alone by default so large outputs are written
by all tasks in parallel; ``single_file=True`` coalesces to one part file
for small results only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TAB = "\t"


def read_delimited(spark: SparkSession, path: str, columns: list[str] | None = None,
                   sep: str = TAB, header: bool = False) -> DataFrame:
    """Delimited text with every column read as a string.

    With ``columns`` the all-string schema is declared up front (no extra
    pass over the data); without it the header (or ``_c0``...) names them.
    """
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType(), True) for c in columns]))
    return reader.csv(path)


def read_delimited_with_schema(spark: SparkSession, path: str, schema: T.StructType,
                               sep: str = TAB, corrupt_column: str | None = None) -> DataFrame:
    """Delimited text under a declared schema, no header.

    PERMISSIVE mode: a malformed field becomes null.  ``corrupt_column``
    adds a string column holding the raw text of malformed lines.
    """
    reader = spark.read.option("sep", sep).option("header", "false").option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = TAB, header: bool = False,
                    single_file: bool = False, mode: str = "overwrite") -> None:
    """Write delimited text (overwrite by default)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("sep", sep).option("header", str(header).lower()).csv(path)


def write_partitioned_recommendations(df: DataFrame, path: str, partition_col: str = "segment",
                                      sep: str = TAB) -> None:
    """One recommendations table partitioned by segment.

    Dynamic partition overwrite replaces only the segments present in ``df``,
    so general and per-segment runs can write to the same table.
    """
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("sep", sep)
       .partitionBy(partition_col)
       .csv(path))


def read_partitioned_recommendations(spark: SparkSession, path: str, partition_col: str = "segment",
                                     sep: str = TAB) -> DataFrame:
    """(StockCode, recs) and the partition column, as text, of a table by segment."""
    schema = T.StructType([T.StructField("StockCode", T.StringType()), T.StructField("recs", T.StringType()),
                           T.StructField(partition_col, T.StringType())])
    return spark.read.option("sep", sep).schema(schema).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "overwrite") -> None:
    """Replace a database table with ``df``.  Connection settings come from the caller."""
    df.write.mode(mode).jdbc(url, table, properties=properties or {})


_POINTER = "_current"


def _file_context(spark: SparkSession, path: str):
    """Hadoop's file context of a path's store, and functions that make its paths and options."""
    jvm = spark._jvm
    to_path = jvm.org.apache.hadoop.fs.Path
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(to_path(path).toUri(), spark._jsc.hadoopConfiguration()), to_path


def _commit(spark: SparkSession, path: str, version: str) -> None:
    """Makes ``version`` the table at ``path``: one rename of a small pointer file."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    context, to_path = _file_context(spark, path)
    fs.mkdirs(to_path(path))
    new = to_path(f"{path}/{_POINTER}-{uuid.uuid4().hex}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, to_path(f"{path}/{_POINTER}"), over)


def current_version(spark: SparkSession, path: str) -> str:
    """The folder that holds the table at ``path``: the last committed version, or ``path`` itself."""
    jvm = spark._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path}/{_POINTER}")
    fs = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(pointer):
        return path
    stream = fs.open(pointer)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str, schema: T.StructType, sep: str = TAB) -> DataFrame:
    """The delimited table at ``path``, whichever version of it is committed."""
    return read_delimited_with_schema(spark, current_version(spark, path), schema, sep=sep)


def replace_table(spark: SparkSession, df: DataFrame, path: str, staging_path: str,
                  schema: T.StructType, sep: str = TAB) -> DataFrame:
    """Replace the delimited table at ``path`` with ``df`` although ``df`` may
    be computed from that same table (S7).

    ``df`` is written to ``staging_path`` as a new version, a folder that must not be there yet, and
    committed by one rename of a pointer file in ``path`` that names it.  Readers follow the pointer
    (``read_table``), so they see the old version or the new one, whole: a failure before the rename
    leaves the old table as it was.  Returns the new version.  Earlier versions stay for those
    who still read them, and for the caller to delete; writing ``path`` anew drops the pointer.
    """
    write_delimited(df, staging_path, sep=sep, mode="error")
    _commit(spark, path, staging_path)
    return read_table(spark, path, schema, sep=sep)
