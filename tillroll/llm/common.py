"""Helpers the operators of this subpackage share: document keys, written intermediates,
a bounded bitmap filter and vectorised text hashing.

Key rules, the same for every operator that matches documents with each other
(``keyed``): a null text counts as empty, a null id is one document of its own that
sorts before all others, and rows that repeat an id are one document with the smallest
of its texts.  Only the id and text columns are read, so further columns, whatever
their names, cannot clash.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import scratch_path

NULL_ID = -(1 << 63)
# The C library's call, where it has one (glibc).
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
# Bits of the bitmap filter: 2**23 bits travel as at most 256 rows of 4 KB (1 MB).
BITMAP_BITS = 1 << 23


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` (long, never null) and ``_text`` (never null), one row per id."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    repeated = rows.groupBy("_id").count().where("count > 1").select("_id")
    if repeated.isEmpty():  # reads the id column alone
        return rows
    merged = rows.join(repeated, "_id", "left_semi").groupBy("_id").agg(F.min("_text").alias("_text"))
    return rows.join(repeated, "_id", "left_anti").unionByName(merged)


def public_id(name: str = "doc_id") -> Column:
    return F.when(F.col("_id") != F.lit(NULL_ID), F.col("_id")).alias(name)


_SHIPPED: set[str] = set()
# Bytes of an Arrow batch, which a task holds a few times over; Spark's default is 64 MB.
BATCH_BYTES = 16 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Gives the executors this package, once an application, where it is not installed on them, and
    the session smaller Arrow batches, where it sets none."""
    if spark.conf.get(_BATCH_SETTING, None) is None:  # the session has Spark's default
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="tillroll-package-")) / "tillroll.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))


def let_go() -> None:
    """Gives memory that this Python worker has freed back to the system.  Arrow's pool and the C library
    would keep it, and Spark keeps its workers for the stages that follow."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: survives lost executors, read many times."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores in front until the columns have none of them (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str) -> Column:
    """The column of that very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns named by their places: ``mapInArrow`` does not take every name."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def mark_probable(docs: DataFrame, ids: DataFrame, key: str = "_id", hit: str = "_hit", bits: int = BITMAP_BITS) -> DataFrame:
    """``docs`` with the column ``hit``: false means that the key is surely not in ``ids``.

    The ids (in a column of the key's name) go into a bitmap of a fixed number of bits, broadcast
    as at most bits / 32768 rows of 4 KB whatever the input; more ids only mean more rows
    that hit by chance, which the exact join after it sorts out.  It keeps the texts of
    rows that nothing concerns out of that join's shuffle.  All columns of ``docs`` are kept as
    they are; ``hit`` must be a new name (``fresh``).
    """
    at_row, bucket, bitmap = fresh([*docs.columns, hit], "_bno", "_bn", "_bm")
    maps = (ids.select(_bit(column(key), bits).alias(at_row))
            .groupBy(F.bitmap_bucket_number(at_row).alias(bucket))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at_row)).alias(bitmap)))
    at = F.bitmap_bit_position(_bit(column(key), bits))
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pow(F.lit(2), F.pmod(at, F.lit(8))).cast("int")
    found = F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False))
    return (docs.withColumn(at_row, F.bitmap_bucket_number(_bit(column(key), bits)))
            .join(F.broadcast(maps), F.col(at_row) == F.col(bucket), "left")
            .select(*map(column, docs.columns), found.alias(hit)))


# ---------------------------------------------------------------- vectorised hashing

MUL = 0x9E3779B97F4A7C15  # odd, so that powers of it can be undone modulo 2**64
_TABLE = 1 << 16
_U = np.uint64


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = powers(MUL, _TABLE)
_POW_OF_TABLES = powers(pow(MUL, _TABLE, 1 << 64), 1 << 15)  # enough for 2**31 bytes, more than a text has
# Bytes of white space: 0x20 and 0x09-0x0D; A-Z map to a-z.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of adjoining texts, and each word's text number.

    ``data``: bytes; text i is data[offsets[i]:offsets[i + 1]].  Words end at white space
    and at the end of a text.
    """
    inside = ~_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    start[edges] = inside[edges]
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pos = np.flatnonzero(inside)
    word = np.cumsum(start[pos]) - 1
    place = pos - at[word]
    part = (_LOWER[data[pos]].astype(np.uint64) + _U(1)) * _POW[place & (_TABLE - 1)]
    if place.max() >= _TABLE:
        part *= _POW_OF_TABLES[place >> 16]
    first = np.searchsorted(pos, at)
    return mix(np.add.reduceat(part, first)), np.searchsorted(offsets, at, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles; a text with fewer
    words has its whole sequence as its one shingle, one without words has none."""
    words, doc = word_hashes(data, offsets)
    n = len(offsets) - 1
    lo = np.searchsorted(doc, np.arange(n))
    hi = np.searchsorted(doc, np.arange(n), side="right")
    grams = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        grams += words[j:j + len(grams)] * _POW[j + 1]
    grams = mix(grams)
    out = []
    for a, b in zip(lo.tolist(), hi.tolist()):
        if b - a >= width:
            g = np.sort(grams[a:b - width + 1])
            out.append(g[np.concatenate(([True], g[1:] != g[:-1]))])
        elif b > a:
            out.append(mix((words[a:b] * _POW[1:1 + b - a]).sum(dtype=np.uint64, keepdims=True) + _U(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_chunks(column, max_bytes: int = 1 << 19):
    """(first row, bytes, offsets) of runs of rows of an Arrow string column without nulls."""
    import pyarrow as pa

    if len(column) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, off, buf = column.buffers()
    off = np.frombuffer(off, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(off, off[row] + max_bytes, side="right")) - 1)
        end = min(end, len(column))
        yield row, data[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end
