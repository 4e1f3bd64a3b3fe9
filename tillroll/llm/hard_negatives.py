"""Hard-negative mining with segment summaries that bound scores before they are computed.

A row's score is its integer inner product with the anchor, after each component x became
floor(256 * x).  An anchor's positives are its first ``k`` other rows of its label; a positive's
hard negatives are the first ``k`` rows of other labels that score from 80 % of it up to it.

Method.  A vector is divided into segments, and of each are stored its mean and its deviation (the
root of the summed squared differences from the mean).  The product of two segments is
width * mean * mean' plus a product of two differences, which by Cauchy-Schwarz lies within the
product of the deviations.  So summed means' products plus or minus summed deviation products
bound the score.  The bounds start with one segment and are refined in the levels of SEGMENTS, each
segment divided in four, for the pairs that are left:

* positives: a row goes if its upper bound is below the k-th largest lower bound;
* negatives: a row goes if its bounds miss the positive's range, or if its upper bound is below
  the k-th largest lower bound of rows that are surely within the range.

What is left is scored exactly in integers.  Bounds are widened by more than the rounding error of
doubles, so nothing is lost.

The rows are dealt into blocks of about BLOCK rows by a hash of their id, whatever their label, and
all anchors (a stated set: ids divisible by ``every``) meet every block, ANCHORS at a time: a task
holds one block and a batch of anchors.  Each block gives its own first ``k``, and windows of at
most ``k`` rows a block choose among these.

Results for odd input: rows with a null label or vector, with a null, not finite or (so that
scores fit a long) absolute component of 65,536 or more take no part; a null id is an ordinary row
that sorts first and is no anchor; of rows that repeat an id that with the smallest (label, vector)
counts; of vectors of unequal length the missing components are 0; ties go by the smaller id; an
empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import NULL_ID, written

FIRST = 5
EVERY = 100
SEGMENTS = (1, 4, 16)
BLOCK = 2048
ANCHORS = 64
LIMIT = 65536.0
SPARSE = 0.1   # share of pairs below which they are gathered one by one


def vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``_id``, ``_label`` and ``_vec`` (floor(256 x) as integers) of the rows that take part, one an id."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda c: c.isNull() | (F.abs(c.cast("double")) >= LIMIT))  # NaN is above every number
    label = F.col(label_col).cast("long")
    own = F.col(id_col).cast("long")
    rows = (rows.where(label.isNotNull() & x.isNotNull() & ~bad)
            .select(F.coalesce(own, F.lit(NULL_ID)).alias("_id"),
                    F.when(own % 7 == 0, (label + 1) % 10).otherwise(label).alias("_label"),
                    F.transform(x, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("int")).alias("_vec")))
    repeated = rows.groupBy("_id").count().where("count > 1").select("_id")
    if repeated.isEmpty():
        return rows
    least = (rows.join(repeated, "_id", "left_semi").groupBy("_id").agg(F.min(F.struct("_label", "_vec")).alias("m"))
             .select("_id", "m._label", "m._vec"))
    return rows.join(repeated, "_id", "left_anti").unionByName(least)


# ---------------------------------------------------------------- bounds

def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column, filled up with zeros to the longest."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def summaries(m: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the scaled means (times the root of the width) and deviations of each vector's segments."""
    out = []
    for count in SEGMENTS:
        width = max(1, -(-m.shape[1] // count))
        parts = widened(m, width * count).astype(np.float64).reshape(len(m), count, width)
        mean = parts.mean(2)
        out.append((mean * np.sqrt(width), np.sqrt(((parts - mean[:, :, None]) ** 2).sum(2))))
    return out


class _Side:
    """Vectors of a block or of some anchors, with their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, m: np.ndarray):
        self.ids, self.labels, self.m = ids, labels, m

    def prepare(self, width: int) -> "_Side":
        self.m = widened(self.m, width)
        self.levels = summaries(self.m)
        self.norm = np.sqrt((self.m.astype(np.float64) ** 2).sum(1))
        self.most = int(np.abs(self.m).max(initial=0))
        return self


def _products(x: np.ndarray, y: np.ndarray, alive: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Inner products of the rows of x and y into ``out``, at least where ``alive`` is set."""
    if alive.mean() > SPARSE:
        np.matmul(x, y.T, out=out)
    else:
        i, j = np.nonzero(alive)
        out[i, j] = np.einsum("ij,ij->i", x[i], y[j])
    return out


def _bounds(a: _Side, b: _Side, level: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = _products(a.levels[level][0], b.levels[level][0], alive, np.zeros(alive.shape))
    reach = _products(a.levels[level][1], b.levels[level][1], alive, np.zeros(alive.shape))
    reach += 1e-11 * a.norm[:, None] * b.norm[None, :] + 1e-6
    return mean - reach, mean + reach


def _exact(a: _Side, b: _Side, alive: np.ndarray) -> np.ndarray:
    if a.most * b.most * max(1, a.m.shape[1]) < 1 << 53:  # doubles hold such sums exactly
        return _products(a.m.astype(np.float64), b.m.astype(np.float64), alive, np.zeros(alive.shape)).astype(np.int64)
    return _products(a.m, b.m, alive, np.zeros(alive.shape, np.int64))


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf with fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _first(score: np.ndarray, ids: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first k alive pairs of each row: largest score, then smallest id."""
    i, j = np.nonzero(alive)
    order = np.lexsort((ids[j], -score[i, j], i))
    i, j = i[order], j[order]
    start = np.searchsorted(i, i)
    keep = np.arange(len(i)) - start < k
    return i[keep], j[keep]


def block_positives(a: _Side, b: _Side, k: int) -> list[np.ndarray]:
    """(anchor, row, score) of the first k rows of the block with each anchor's label."""
    alive = (a.labels[:, None] == b.labels) & (a.ids[:, None] != b.ids)
    for level in range(len(SEGMENTS)):
        low, high = _bounds(a, b, level, alive)
        alive &= high >= _kth(np.where(alive, low, -np.inf), k)[:, None]
    score = _exact(a, b, alive)
    i, j = _first(score, b.ids, alive, k)
    return [a.ids[i], b.ids[j], score[i, j]]


def block_negatives(a: _Side, b: _Side, positives: list[list[dict]], k: int) -> list[np.ndarray]:
    """(anchor, positive, its score, row, score) of the first k rows of the block within each positive's range."""
    other = a.labels[:, None] != b.labels
    ranges = []  # by number of the positive: anchors that have it, its ids and scores, the least score of a negative
    for n in range(max(map(len, positives), default=0)):
        own = np.array([x for x, p in enumerate(positives) if len(p) > n])
        ids, hi = (np.array([positives[x][n][f] for x in own], np.int64) for f in ("id", "score"))
        ranges.append((own, ids, hi, -(-4 * hi // 5)))
    left = [other[own] for own, *_ in ranges]
    for level in range(len(SEGMENTS)):
        low, high = _bounds(a, b, level, _either(other.shape, ranges, left))
        for n, (own, _, hi, lo) in enumerate(ranges):
            near_low, near_high = low[own], high[own]
            left[n] &= (near_high >= lo[:, None]) & (near_low <= hi[:, None])
            sure = left[n] & (near_low >= lo[:, None]) & (near_high <= hi[:, None])
            left[n] &= near_high >= _kth(np.where(sure, near_low, -np.inf), k)[:, None]
    score = _exact(a, b, _either(other.shape, ranges, left))
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(5)]
    for (own, ids, hi, lo), alive in zip(ranges, left):
        near = score[own]
        i, j = _first(near, b.ids, alive & (near >= lo[:, None]) & (near <= hi[:, None]), k)
        for col, v in zip(out, (a.ids[own[i]], ids[i], hi[i], b.ids[j], near[i, j])):
            col.append(v)
    return [np.concatenate(c) for c in out]


def _either(shape: tuple[int, int], ranges: list, left: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(shape, bool)
    for (own, *_), alive in zip(ranges, left):
        out[own] |= alive
    return out


# ---------------------------------------------------------------- blocks

def _met(batches: Iterator[pa.RecordBatch], names: list[str], work: Callable) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, and in it the block's rows before the anchors: ``work`` for each block and some anchors."""
    shard, held, block = None, [], None
    for batch in batches:
        at = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1, [len(at)]))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if lo == hi:
                continue
            if at[lo] // 2 != shard:
                shard, held, block = int(at[lo] // 2), [], None
            run = batch.slice(lo, hi - lo)
            if at[lo] % 2 == 0:
                held.append(_side(run))
                continue
            if not held:
                continue  # no row of this block
            for x in range(0, run.num_rows, ANCHORS):
                part = run.slice(x, ANCHORS)
                anchors = _side(part)
                width = max(anchors.m.shape[1], *(s.m.shape[1] for s in held))
                if block is None or block.m.shape[1] < width:
                    block = _Side(np.concatenate([s.ids for s in held]), np.concatenate([s.labels for s in held]),
                                  np.concatenate([widened(s.m, width) for s in held])).prepare(width)
                found = work(anchors.prepare(block.m.shape[1]), block, part.column(5))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=names)


def _side(run: pa.RecordBatch) -> _Side:
    return _Side(run.column(2).to_numpy(), run.column(3).to_numpy(), matrix(run.column(4)))


def _in_blocks(rows: DataFrame, anchors: DataFrame, shards: int, names: list[str], work: Callable) -> DataFrame:
    none = F.lit(None).cast("array<struct<id:long,score:long>>")
    own = rows.select(F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int").alias("_shard"), F.lit(0).alias("_kind"),
                      "_id", "_label", "_vec", none.alias("_pos"))
    met = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"), F.lit(1).alias("_kind"),
                         "_id", "_label", "_vec", "_pos" if "_pos" in anchors.columns else none.alias("_pos"))
    dealt = own.unionByName(met).repartition("_shard").sortWithinPartitions("_shard", "_kind", "_id")
    return dealt.mapInArrow(lambda it: _met(it, names, work), ", ".join(f"{c} long" for c in names))


def _ranked(found: DataFrame, keys: list[str], score: str, other: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, k: int = FIRST, every: int = EVERY, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    rows = written(spark, vectors(rows, id_col, vec_col, label_col), "vectors")
    shards = max(1, -(-rows.count() // BLOCK))
    anchors = rows.where(F.col("_id") % every == 0)
    names = ["anchor_id", "positive_id", "positive_score"]
    found = _in_blocks(rows, anchors, shards, names, lambda a, b, _: block_positives(a, b, k))
    positives = written(spark, _ranked(found, names[:1], names[2], names[1], k), "positives")
    lists = positives.groupBy(F.col("anchor_id").alias("_id")).agg(  # k rows at most
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("_pos"))
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    found = _in_blocks(rows, anchors.join(lists, "_id"), shards, names,
                       lambda a, b, pos: block_negatives(a, b, pos.to_pylist(), k))
    public = lambda c: F.when(F.col(c) != F.lit(NULL_ID), F.col(c)).alias(c)
    return _ranked(found, names[:2], "negative_score", "negative_id", k).select(
        "anchor_id", public("positive_id"), "rank", public("negative_id"), "positive_score", "negative_score")


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
