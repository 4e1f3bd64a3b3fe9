"""Exact n-gram Jaccard join by pivots in a metric space, and the classes of linked documents.

A document's set holds the distinct hashes of its 5-word shingles (lower-cased A-Z, words
between white space; fewer words: the whole sequence as one).  Two documents link when
100 * |intersection| >= percent * |union|, that is when their Jaccard distance, a metric, is
at most r.  The classes are the connected components of the links.

1. Documents with equal sets become one (their class is theirs).
2. Regions.  Unrelated texts all are at distance 1, so the first pivots are sets of one shingle: a
   document is nearest to those that it contains, at 1 - 1/|x|, all alike.  It is copied to the
   regions of the |x| - ceil(percent/100 * |x|) + 1 first of them, in one order for all documents
   that has very frequent shingles last; documents that link share one of these at least.  Most
   regions hold one document and are dropped at once.  Of the regions that two documents share only
   the first counts, so a region all of whose documents also share the same region before it goes,
   and in other regions pairs with the same region before it are left out: a passage that many
   documents have is one region, not one for each of its shingles.
3. Cells.  A region's first pivot is one of its documents.  Each document is compared with the
   pivot that most of its regions share, its nearest by the number of shared shingles, and then with
   those pivots of its other regions that are in another class by then.  Documents linked to a pivot are in
   its class; they need not be compared with each other.
4. Regions with several classes go on.  With at most FEW documents their pairs are tried at once; with at most
   SMALL documents outside of the largest class all of these are pivots and look at the whole region.  Larger
   regions go on in rounds: about PIVOTS documents outside of the largest class
   look at all documents of the region, and of every other class
   the nearest document within the window is compared with the pivot: one link joins two classes,
   however large.  When a round no longer joins a fifth of the open classes (SHRINK), a last one takes all documents
   outside of the largest class as pivots and compares whatever is within the windows.
5. Windows.  A pivot and a document of a region are compared by their sets only if all that is
   known of them leaves a link possible: other classes, sizes within the ratio, distances to the
   region's first pivot that differ by at most r (triangle inequality), and the
   distance to virtual pivots: the numbers of a set's shingles in each of CELLS parts of all
   shingles differ in sum by no more than the symmetric difference of the two sets.  Pairs that pass
   are tried again with as many parts as a quarter of the set's size, which tells unrelated long texts apart too.

In 4 and 5 a task holds about PIVOT_BLOCK pivots of a region and streams about CHUNK documents past
them, whatever the region's size; what it sends on are pairs within the windows.  Every pair that can link is
compared, or is in one class already: the classes are exact.  What is frequent is found by counts
within tasks; it only orders shingles, the same way for all documents, and so changes no result.

Results for odd input: see ``common.keyed``; a document without words has an empty set and
links with nothing, not even with another one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import NULL_ID, keyed, mark_probable, mix, public_id, shingle_sets, text_chunks, written

PERCENT = 75
WIDTH = 5
CELLS, FEWEST = 128, 64
FEW, SMALL, PIVOTS, SHRINK = 6, 64, 16, 0.8
PIVOT_BLOCK, CHUNK = 64, 4096
SALTS = 16
TASK_LINKS = 1_000_000
ROWS_AT_ONCE = 100_000    # that a task sends on together
CELL_BYTES = 1 << 24    # of texts that meet a pivot in one task
FREQUENT = 50_000       # shingles put last, at most
COUNTED_SHINGLES = 1 << 21  # what a task counts at once
FREQUENT_SHARE = 0.0025
SHARED_BITS = 1 << 25   # of the bitmap of shared shingles: 4 MB
_U = np.uint64


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(id, set) of each row (id, text)."""
    ids = batch.column(0).to_pylist()
    for at, data, offsets in text_chunks(batch.column(1)):
        for k, s in enumerate(shingle_sets(data, offsets, WIDTH)):
            yield ids[at + k], s


def fine_cells(s: np.ndarray) -> bytes:
    """Numbers of shingles (255 at most) in as many equal parts as the next power of two to a quarter
    of the set's size, FEWEST at least."""
    bits = max(FEWEST.bit_length() - 1, (max(len(s), 1) // 4).bit_length())
    count = np.bincount((s >> _U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(count, 255).astype(np.uint8).tobytes()


def coarse_cells(s: np.ndarray) -> bytes:
    """Numbers of shingles (255 at most) in CELLS equal parts."""
    count = np.bincount((s >> _U(64 - (CELLS.bit_length() - 1))).astype(np.int64), minlength=CELLS)
    return np.minimum(count, 255).astype(np.uint8).tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of two sets' symmetric difference from their fine cells."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if max(a.max(initial=0), b.max(initial=0)) == 255 and len(a) != len(b):
        return 0  # sums of cut numbers would not bound anything
    a, b = a.astype(np.int32), b.astype(np.int32)
    while len(a) > len(b):
        a = a.reshape(-1, 2).sum(1)
    while len(b) > len(a):
        b = b.reshape(-1, 2).sum(1)
    return int(np.abs(a - b).sum())


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: size, two sums that identify the set, cells.  And shingles that many documents
    of the task have, as rows without cells: hash and count."""
    names = ["_id", "n", "h1", "h2", "bytes", "cells", "fine"]
    kinds = [pa.int64()] * 5 + [pa.binary()] * 2
    held: list[np.ndarray] = []
    total = 0

    def frequent() -> pa.RecordBatch:
        h, count = np.unique(np.concatenate(held), return_counts=True)
        most = count >= max(8, FREQUENT_SHARE * len(held))
        n = int(most.sum())
        return pa.RecordBatch.from_arrays([pa.array(h[most].astype(np.int64)), pa.array(count[most]),
                                           *(pa.nulls(n, t) for t in kinds[2:])], names=names)

    def summary(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    for batch in batches:
        out: list[tuple] = []
        lengths = pc.binary_length(batch.column(1)).to_pylist()
        for length, (doc, s) in zip(lengths, _sets(batch)):
            out.append((doc, len(s), int(mix(s).sum(dtype=_U).astype(np.int64)),
                        int(mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U).astype(np.int64)), length, coarse_cells(s), fine_cells(s)))
            held.append(s)
            total += len(s)
            if total >= COUNTED_SHINGLES:
                yield frequent()
                held, total = [], 0
            if len(out) >= 1000:
                yield summary(out)
                out = []
        if out:
            yield summary(out)
    if held:
        yield frequent()


def signature(s: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a sorted set, frequent ones last."""
    size = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
    if len(frequent) and size:
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        often = frequent[at] == s
        s = np.concatenate([s[~often], s[often]])
    return s[:size]


def _signatures(batches: Iterator[pa.RecordBatch], frequent, percent: int) -> Iterator[pa.RecordBatch]:
    often = frequent.value
    sigs, ids, total = [np.zeros(0, _U)], [], 0

    def made() -> pa.RecordBatch:
        own = np.repeat(np.array(ids, np.int64), np.array(list(map(len, sigs[1:])), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).astype(np.int64)), pa.array(own)], names=["sig", "_id"])

    for batch in batches:
        for doc, s in _sets(batch):
            sigs.append(signature(s, often, percent))
            ids.append(doc)
            total += len(sigs[-1])
            if total >= ROWS_AT_ONCE:
                yield made()
                sigs, ids, total = sigs[:1], [], 0
    yield made()


# ---------------------------------------------------------------- windows

def sizes_may_link(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)


def differences_may_link(least: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """With s = |x| + |y| and d = |x symmetric difference y| a link means (100 + percent) * d <= (100 - percent) * s."""
    return (100 + percent) * least <= (100 - percent) * (na + nb)


def _cell_array(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16)


def _may_link(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, n of a, n of b, cells of a, of b): the pairs whose windows leave a link possible."""
    for b in batches:
        na, nb = (b.column(k).to_numpy() for k in (2, 3))
        least = np.abs(_cell_array(b.column(4)) - _cell_array(b.column(5))).sum(1)
        yield b.filter(pa.array(differences_may_link(least, na, nb, percent) & sizes_may_link(na, nb, percent))).select([0, 1])


def _may_link_finely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, n of a, n of b, fine cells of a, of b): as _may_link."""
    for b in batches:
        na, nb = (b.column(k).to_numpy() for k in (2, 3))
        least = np.array([least_difference(x, y) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())], np.int64)
        yield b.filter(pa.array(differences_may_link(least, na, nb, percent))).select([0, 1])


class _Members:
    """Documents of a region: ids, classes, the region before, distances to the first pivot, sizes and cells."""

    def __init__(self, rows: pa.RecordBatch):
        self.ids, self.classes = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        before = rows.column(2)
        self.has_before = ~before.is_null().to_numpy(zero_copy_only=False)
        self.before = before.fill_null(0).to_numpy(zero_copy_only=False)
        self.d = rows.column(3).cast(pa.float64()).to_numpy(zero_copy_only=False)  # NaN: not known
        self.n = rows.column(4).to_numpy()
        self.cells = _cell_array(rows.column(5))
        self.chosen = rows.column(6).to_numpy(zero_copy_only=False)


def windows(p: _Members, x: _Members, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pivot, document) places of the pairs that may link, and their least differences."""
    ok = p.classes[:, None] != x.classes
    ok &= ~((p.before[:, None] == x.before) & p.has_before[:, None] & x.has_before)
    ok &= ~x.chosen | (p.ids[:, None] < x.ids)     # two pivots meet twice
    ok &= sizes_may_link(p.n[:, None], x.n, percent)
    with np.errstate(invalid="ignore"):
        ok &= ~(np.abs(p.d[:, None] - x.d) > 1 - percent / 100 + 1e-9)
    i, j = np.nonzero(ok)
    least = np.zeros(len(i), np.int64)
    for at in range(0, len(i), 8192):
        least[at:at + 8192] = np.abs(p.cells[i[at:at + 8192]] - x.cells[j[at:at + 8192]]).sum(1)
    keep = differences_may_link(least, p.n[i], x.n[j], percent)
    return i[keep], j[keep], least[keep]


def nearest(p: _Members, x: _Members, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each pivot's pairs with a class the one of the least difference."""
    order = np.lexsort((x.ids[j], least, x.classes[j], i))
    i, j = i[order], j[order]
    first = np.ones(len(i), bool)
    first[1:] = (i[1:] != i[:-1]) | (x.classes[j[1:]] != x.classes[j[:-1]])
    return i[first], j[first]


def _met(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (region, block, chunk), in these the pivots before the documents: pairs within the windows,
    ``every`` one (last column) or the nearest of each class."""
    place, held, pivots = None, [], None
    for batch in batches:
        where = np.stack([batch.column(k).to_numpy() for k in range(4)], 1)
        edges = np.concatenate(([0], np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1, [len(where)]))
        out = [np.zeros((2, 0), np.int64)]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if lo == hi:
                continue
            if tuple(where[lo, :3]) != place:
                place, held, pivots = tuple(where[lo, :3]), [], None
            rows = batch.slice(lo, hi - lo).select(list(range(4, 11)))
            if where[lo, 3] == 0:
                held.append(rows)
                continue
            if not held:
                continue
            if pivots is None:
                pivots = _Members(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
            for at in range(0, rows.num_rows, 1024):
                x = _Members(rows.slice(at, 1024))
                i, j, least = windows(pivots, x, percent)
                if not batch.column(11)[lo].as_py():
                    i, j = nearest(pivots, x, i, j, least)
                out.append(np.stack([np.minimum(pivots.ids[i], x.ids[j]), np.maximum(pivots.ids[i], x.ids[j])]))
        a, b = np.concatenate(out, 1)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, part, b, text) sorted so that the pivot a, without b, comes before its documents b."""
    pivot, own = None, np.zeros(0, _U)
    for batch in batches:
        out: list[tuple] = []
        keys = zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)))
        texts = batch.select([2, 3])
        for (a, part, b), (_, s) in zip(keys, _sets(texts)):
            if b is None:
                pivot, own = (a, part), s
            else:
                assert pivot == (a, part)
                both = len(np.intersect1d(own, s, assume_unique=True))
                out.append((a, b, both, len(own) + len(s) - both))
        cols = zip(*out) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "shared", "either"])


class _Join:
    def __init__(self, rows: DataFrame, percent: int):
        self.rows, self.percent, self.spark = rows, percent, rows.sparkSession
        made = written(self.spark, rows.mapInArrow(_summaries, "_id long, n long, h1 long, h2 long, bytes long, cells binary, fine binary"),
                       "summaries")
        self.docs = made.where("fine IS NOT NULL")
        often = (made.where("fine IS NULL").groupBy("_id").agg(F.sum("n").alias("n"))
                 .orderBy(F.desc("n"), "_id").limit(FREQUENT).select("_id").collect())
        self.frequent = self.spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in often], np.int64).astype(_U)))

    def copies(self) -> DataFrame:
        """Documents with an equal set of a smaller id: ``_id``, ``kept``."""
        some = self.docs.where("n > 0")
        first = (some.groupBy("n", "h1", "h2").agg(F.min("_id").alias("kept"), F.count(F.lit(1)).alias("c")).where("c > 1")
                 .select("n", "h1", "h2", "kept", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
        salted = some.select("_id", "n", "h1", "h2", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("salt"))
        return salted.join(first, ["n", "h1", "h2", "salt"]).where("_id > kept").select("_id", "kept")

    def regions(self, copies: DataFrame) -> DataFrame:
        """``sig``, ``_id``, ``pivot`` and ``before`` (the document's region before this) of regions that count."""
        marked = mark_probable(self.rows, copies.select("_id"))
        rest = marked.where("NOT _hit").drop("_hit").unionByName(
            marked.where("_hit").drop("_hit").join(copies.select("_id"), "_id", "left_anti"))
        frequent, percent = self.frequent, self.percent
        sigs = rest.mapInArrow(lambda it: _signatures(it, frequent, percent), "sig long, _id long")
        shared = written(self.spark, sigs.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sig"), "shared")
        rows = mark_probable(sigs, shared, "sig", bits=SHARED_BITS).where("_hit").drop("_hit").join(shared, "sig")
        before = F.lag("sig").over(Window.partitionBy("_id").orderBy("sig"))  # a document's own rows
        rows = written(self.spark, rows.withColumn("before", before), "shared-regions")
        first = rows.groupBy("sig").agg(F.min("_id").alias("pivot"), F.min("before").alias("lo"), F.max("before").alias("hi"),
                                        F.count("before").alias("some"), F.count(F.lit(1)).alias("c"))
        first = first.where(~((F.col("some") == F.col("c")) & (F.col("lo") == F.col("hi")))).select("sig", "pivot")
        return rows.join(first, "sig")

    def concerned(self, table: DataFrame, pairs: DataFrame) -> DataFrame:
        """The rows of ``table`` that may be of a document in ``pairs``, by one bitmap."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("_id"))
        return mark_probable(table, ids).where("_hit").drop("_hit")

    def with_summary(self, pairs: DataFrame, column: str) -> DataFrame:
        """(a, b, their sizes, their ``column``)."""
        some = self.concerned(self.docs.select("_id", "n", column), pairs)
        of = lambda k: some.select(F.col("_id").alias(k), F.col("n").alias(f"n{k}"), F.col(column).alias(f"c{k}"))
        return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "nb", "ca", "cb")

    def may_link(self, pairs: DataFrame, name: str) -> DataFrame:
        """The distinct pairs (a, b; a written table) that the windows let pass."""
        percent = self.percent
        near = self.with_summary(pairs, "cells").mapInArrow(lambda it: _may_link(it, percent), "a long, b long")
        return self.may_link_finely(written(self.spark, near, f"{name}-coarse"))

    def may_link_finely(self, near: DataFrame) -> DataFrame:
        percent = self.percent
        return self.with_summary(near, "fine").mapInArrow(lambda it: _may_link_finely(it, percent), "a long, b long")

    def compare(self, pairs: DataFrame, name: str) -> DataFrame:
        """Shared and united shingles of the pairs (a written table of distinct a, b)."""
        pairs = pairs.join(self.docs.select(F.col("_id").alias("b"), "bytes"), "b")
        pairs = written(self.spark, pairs, f"{name}-sizes")
        cells = pairs.groupBy("a").agg(F.sum("bytes").alias("m"))
        part = F.pmod(F.xxhash64("b"), F.ceil((F.col("m") + 1) / CELL_BYTES)).cast("int").alias("part")
        dealt = written(self.spark, pairs.join(cells, "a").select("a", "b", part), f"{name}-dealt")
        # Whose text goes where: each document's to its pivot's cell, a pivot's to each part of its cell.
        none = F.lit(None).cast("long")
        wanted = dealt.select(F.col("b").alias("_id"), "a", "part", "b").unionByName(
            dealt.select("a", "part").distinct().select(F.col("a").alias("_id"), "a", "part", none.alias("b")))
        met = wanted.join(self.concerned(self.rows, pairs), "_id").select("a", "part", "b", "_text")
        met = met.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        return written(self.spark, met.mapInArrow(_compared, "a long, b long, shared long, either long"), name)

    def links(self, distances: DataFrame) -> DataFrame:
        return distances.where(F.col("shared") * 100 >= F.col("either") * self.percent).select("a", "b")

    def run(self) -> tuple[DataFrame, DataFrame]:
        """Copies (``_id``, ``kept``) and the class of each document in a link (``_id``, ``class``)."""
        copies = written(self.spark, self.copies(), "copies")
        regions = written(self.spark, self.regions(copies), "regions")
        counted = (regions.where("_id != pivot").groupBy(F.col("pivot").alias("a"), F.col("_id").alias("b"))
                   .agg(F.count(F.lit(1)).alias("c")))
        counted = written(self.spark, counted, "pivot-counts")
        near = written(self.spark, self.may_link(counted.select("a", "b"), "pivots").join(counted, ["a", "b"]), "pivots")
        best = near.groupBy("b").agg(F.max(F.struct("c", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), "b")
        best = written(self.spark, best, "cells")
        distances = self.compare(best, "distances0")
        classes = components(self.links(distances))
        of = lambda k: classes.select(F.col("_id").alias(k), F.col("class").alias(f"class{k}"))
        rest = (near.select("a", "b").join(best, ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left")
                .where("coalesce(classa, a) != coalesce(classb, b)").select("a", "b"))
        rest = written(self.spark, rest, "other-pivots")
        if not rest.isEmpty():
            more = self.compare(rest, "distances1")
            distances = distances.unionByName(more)
            classes = joined(classes, self.links(more))
        # Distances to a region's first pivot, where known; the pivot's own is 0, and it has met all others.
        own = distances.select(F.col("a").alias("pivot"), F.col("b").alias("_id"), (1 - F.col("shared") / F.col("either")).alias("d"))
        left = regions.where("_id != pivot").join(own, ["pivot", "_id"], "left").select("sig", "_id", "before", "d")
        left = written(self.spark, left, "left")
        k, was = 1, 0
        while True:
            k += 1
            open_ = self.open(left, classes, k)
            now, large = open_.agg(F.count(F.lit(1)), F.sum(F.when(F.col("outside") > SMALL, F.col("c")))).first()
            if not now:
                return copies, classes
            last = not large or (bool(was) and large > SHRINK * was)
            pairs = self.round(left, classes, open_, k, last)
            if not pairs.isEmpty():
                classes = joined(classes, self.links(self.compare(pairs, f"distances{k}")))
            if last:
                return copies, classes
            left = written(self.spark, left.join(open_.where(F.col("outside") > SMALL).select("sig"), "sig"), f"left{k}")
            was = large

    def open(self, left: DataFrame, classes: DataFrame, k: int) -> DataFrame:
        """The regions with several classes: ``sig``, ``largest`` class, ``m`` documents, ``outside`` of the largest class,
        ``c`` classes.  ``left``: region, document, the document's region before, distance to the region's first pivot."""
        rows = left.join(classes, "_id", "left").withColumn("class", F.coalesce("class", "_id"))
        sizes = rows.groupBy("sig", "class").agg(F.count(F.lit(1)).alias("size"))
        open_ = (sizes.groupBy("sig").agg(F.max(F.struct("size", "class")).alias("top"), F.sum("size").alias("m"), F.count(F.lit(1)).alias("c"))
                 .where("c > 1").select("sig", F.col("top.class").alias("largest"), "m", (F.col("m") - F.col("top.size")).alias("outside"), "c"))
        return written(self.spark, open_, f"open{k}")

    def round(self, left: DataFrame, classes: DataFrame, open_: DataFrame, k: int, last: bool) -> DataFrame:
        """The pairs that the next pivots of the open regions are to be compared with."""
        rows = left.join(open_, "sig").join(classes, "_id", "left").withColumn("class", F.coalesce("class", "_id"))
        every = F.lit(last) | (F.col("outside") <= SMALL)
        turn = every | (F.pmod(F.xxhash64("_id", F.lit(k)), F.ceil(F.col("outside") / PIVOTS)) == 0)
        rows = rows.withColumn("chosen", (F.col("class") != F.col("largest")) & turn).withColumn("every", every)
        rows = written(self.spark, rows.join(self.docs.select("_id", "n"), "_id").select(
            "sig", "_id", "class", "before", "d", "n", "chosen", "every", "m", "outside"), f"members{k}")
        percent = self.percent

        # A few documents: their pairs within the windows but for the cells, once each, whatever the regions they share.
        few = rows.where(F.col("m") <= FEW).groupBy("sig").agg(F.collect_list(F.struct("_id", "class", "before", "d", "n")).alias("x"))
        tried = few.select(F.explode(F.expr(f"""flatten(transform(x, (p, i) -> transform(filter(slice(x, i + 2, {FEW}), q ->
            p.class != q.class AND coalesce(p.before != q.before, true) AND 100 * least(p.n, q.n) >= {percent} * greatest(p.n, q.n)
            AND coalesce(abs(p.d - q.d) <= {1 - percent / 100 + 1e-9}D, true)),
            q -> struct(least(p._id, q._id) AS a, greatest(p._id, q._id) AS b))))""")).alias("p")).select("p.a", "p.b").distinct()
        tried = written(self.spark, tried, f"tried{k}")
        near = self.with_summary(tried, "cells").mapInArrow(lambda it: _may_link(it, percent), "a long, b long")

        # Pivots in blocks, documents in chunks; each block meets each chunk.
        more = rows.where(F.col("m") > FEW)
        if not more.isEmpty():
            more = written(self.spark, more.join(self.docs.select("_id", "cells"), "_id"), f"looking{k}")
            payload = ["_id", "class", "before", "d", "n", "cells", "chosen", "every"]
            blocks = F.ceil(F.when(F.col("every"), F.col("outside")).otherwise(PIVOTS) / PIVOT_BLOCK).cast("int")
            chunks = F.ceil(F.col("m") / CHUNK).cast("int")
            each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
            pivots = more.where("chosen").select("sig", F.pmod(F.xxhash64("_id", F.lit(-1)), blocks).cast("int").alias("block"), each(chunks).alias("chunk"),
                                                 F.lit(0).alias("kind"), *payload)
            others = more.select("sig", each(blocks).alias("block"), F.pmod(F.xxhash64("_id", F.lit(-2)), chunks).cast("int").alias("chunk"),
                                 F.lit(1).alias("kind"), *payload)
            met = pivots.unionByName(others).repartition("sig", "block", "chunk").sortWithinPartitions("sig", "block", "chunk", "kind")
            near = near.unionByName(met.mapInArrow(lambda it: _met(it, percent), "a long, b long"))
        near = written(self.spark, near.distinct(), f"near{k}-coarse")
        return written(self.spark, self.may_link_finely(near), f"near{k}")


def joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (of documents in a link) with further links: only the classes that these touch are labelled anew."""
    of = lambda k: classes.select(F.col("_id").alias(k), F.col("class").alias(f"class{k}"))
    ends = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .select(F.coalesce("classa", "a").alias("a"), F.coalesce("classb", "b").alias("b")).where("a != b").distinct())
    ends = written(links.sparkSession, ends, "class-links")
    if ends.isEmpty():
        return classes
    roots = components(ends)
    new = roots.join(classes.select("_id"), "_id", "left_anti").select("_id", F.col("_id").alias("class"))
    every = classes.unionByName(new).join(roots.select(F.col("_id").alias("class"), F.col("class").alias("root")), "class", "left")
    return written(links.sparkSession, every.select("_id", F.coalesce("root", "class").alias("class")), "classes")


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) links of a task: each end and the smallest id that the task's links lead to."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    ids = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([root(x) for x in ids], pa.int64())], names=["_id", "class"])


def components(links: DataFrame) -> DataFrame:
    """The smallest id reachable by links: ``_id``, ``class``, for every id in a link.

    At most TASK_LINKS links (16 MB) are one task's; more are followed in rounds.
    """
    links = written(links.sparkSession, links.select("a", "b"), "links")
    if links.count() <= TASK_LINKS:
        return written(links.sparkSession, links.coalesce(1).mapInArrow(_roots, "_id long, class long"), "labels")
    return _components_in_rounds(links)


def _components_in_rounds(links: DataFrame) -> DataFrame:
    """The smallest id reachable by links: ``_id``, ``class``, for every id in a link.

    Each round a node takes the smallest label among its own, its neighbours' and its
    label's label, so the labels of a path meet in a number of rounds that grows with the
    logarithm of its length.
    """
    spark = links.sparkSession
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    ends = written(spark, ends, "ends")
    labels = written(spark, ends.groupBy(F.col("a").alias("_id")).agg(F.min("b").alias("m"))
                     .select("_id", F.least("_id", "m").alias("class")), "labels0")
    k = 0
    while True:
        k += 1
        near = ends.join(labels.withColumnRenamed("_id", "b"), "b").groupBy(F.col("a").alias("_id")).agg(F.min("class").alias("m"))
        # A label's own label, and what its members have found for it.
        up = labels.select(F.col("_id").alias("class"), F.col("class").alias("u"))
        found = labels.join(near, "_id").join(up, "class").select("_id", "class", F.least("class", "m", "u").alias("new"))
        found = written(spark, found, f"found{k}")
        hooks = found.groupBy(F.col("class").alias("_id")).agg(F.min("new").alias("h"))
        after = written(spark, found.join(hooks, "_id", "left").select("_id", F.least("new", "h").alias("class"),
                                                                       F.col("class").alias("was")), f"labels{k}")
        if after.where("class != was").isEmpty():
            return after.select("_id", "class")
        labels = after.select("_id", "class")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``_id``, n_shingles, ``_class`` (the smallest id reachable by links)."""
    join = _Join(keyed(docs, id_col, text_col), percent)
    copies, classes = join.run()
    kept = join.docs.select("_id", F.col("n").alias("n_shingles")).join(copies, "_id", "left")
    kept = kept.withColumn("kept", F.coalesce("kept", "_id"))
    return (kept.join(classes.select(F.col("_id").alias("kept"), "class"), "kept", "left")
            .select("_id", "n_shingles", F.coalesce("class", "kept").alias("_class")))


def classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    out = near_duplicates(docs, percent)
    return out.select(public_id(), "n_shingles", F.when(F.col("_class") != F.lit(NULL_ID), F.col("_class")).alias("component_id"))
