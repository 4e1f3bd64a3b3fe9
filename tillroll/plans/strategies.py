"""Plan helpers that a Spark user writes around joins and long lineages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import scratch_path, splitting_skew

# Default bound for broadcasting a derived table (rules, centroids ...), in estimated bytes.
DEFAULT_BROADCAST_BYTES = 64 << 20


def _value_bytes(kind: T.DataType, value: Column) -> Column | int:
    """Estimated bytes of a value: 8 for a fixed-width one, lengths for text and arrays."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if isinstance(inner, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            each = F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + _as_column(_value_bytes(inner, x)).cast("long"))
            return F.coalesce(each, F.lit(0)) + 8
        return F.greatest(F.size(value), F.lit(0)) * 8 + 8
    if isinstance(kind, T.StructType):
        parts = [_as_column(_value_bytes(f.dataType, value.getField(f.name))) for f in kind.fields]
        return sum(parts, F.lit(8))
    return 8


def _as_column(n) -> Column:
    return F.lit(n) if isinstance(n, int) else n


def row_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of a row."""
    return sum((_as_column(_value_bytes(f.dataType, F.col(f.name))).cast("long") for f in schema.fields), F.lit(8).cast("long"))


def broadcast_if_bounded(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only when its rows add up to at most ``max_bytes``, by their estimated width.

    The check is a sum over the table, added up within tasks first, so that only one row a task moves.
    Beyond the bound the plain DataFrame is returned and
    Spark shuffles both sides (AQE may still split skewed partitions).  ``df`` should be
    cheap to read twice: a written table, or derived from one.
    """
    total = df.agg(F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0))).first()[0]
    return (F.broadcast(df), True) if total <= max_bytes else (df, False)


def cut_lineage(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    A written table survives executor loss (unlike a local checkpoint) and
    ends the lineage, so later stages never recompute what came before.
    Skewed joins below are split, so a purchase with a large share of all
    lines is pre-aggregated by several tasks, without any session setting.
    ``tillroll.session.clear_scratch`` deletes what a session has written so.
    """
    path = scratch_path(spark, name)
    with splitting_skew(spark):
        df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.schema(df.schema).format(fmt).load(path)
