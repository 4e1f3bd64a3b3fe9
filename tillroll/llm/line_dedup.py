"""Line dedup: blocks of lines that an earlier document has too are deleted from the later one.

A block is a run of adjoining lines of a document that some earlier document (smaller id) has
as adjoining lines too, grown over equal lines on both sides (blank and repeated ones as well)
and of at least ``min_words`` words; two characters of scripts without spaces (Chinese,
Japanese, Thai, Lao, Khmer, Burmese) count as a word more.  What is deleted is judged on the input,
not on what is left.

Method.  Lines are compared by 64-bit hashes.

1. Pairs.  A line with words that comes at most RARE times in all documents is rare.  Documents that share a
   rare line overlap: each with every other holder, at most RARE * (RARE - 1) / 2 pairs a line.
2. Alignment.  Both line lists of a pair are aligned by patience diff: equal lines at both ends, then the
   lines that are unique on both sides, of which the longest sequence in order on both is kept, then the same
   between these.  Adjoining aligned lines are blocks, grown over equal lines.  A block that moved or comes again has no place in an
   alignment; in the same pair it is found by its shortest runs (below), if the alignment left any shared line over.
3. Lines too frequent to pair (and lines without words).  A block with a rare line is a pair's.  Blocks of
   frequent lines alone need no pairs: of every line the shortest run of frequent lines that begins there, and
   the shortest that ends there, with ``min_words`` words are hashed.  A block is the union of those inside
   it: from a line of it, either the run to its last line or the run back from its last line that
   holds the line is inside.  So the first document with a run tells whether it goes, whatever the
   others hold: one row for each distinct run, n - 1 links for n documents with it.

So every block that any earlier document has goes, whatever the number of documents that have it.

Results for odd input: see ``common.keyed``; a document without text has no lines and stays;
lines are split at line feeds, and a text all of whose lines go becomes empty; documents
keep their rows and all columns, whatever their names; repeated rows of one id get the same deletions by line
number; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import MUL, NULL_ID, column, fresh, keyed, mark_probable, mix, positional, powers, written

MIN_WORDS = 10
RARE = 6
SALTS = 16
# Thai, Lao, Burmese, Khmer, kana and Han characters.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
                      "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def line_sizes(text: str) -> list[int]:
    """Words of each line; two characters of scripts without spaces count as a word more."""
    lines = text.split("\n")
    if text.isascii() or not UNSPACED.search(text):
        return [len(x.split()) for x in lines]
    return [len(x.split()) + len(UNSPACED.findall(x)) // 2 for x in lines]


# ---------------------------------------------------------------- runs

def shortest_runs(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of the shortest runs from each line on and up to each line, without repeats."""
    n = len(words)
    total = np.concatenate(([0], np.cumsum(words)))
    line = np.arange(n)
    to = np.searchsorted(total, total[:-1] + max(min_words, 1), side="left") - 1
    start = np.searchsorted(total, total[1:] - max(min_words, 1), side="right") - 1
    on, back = to < n, start >= 0
    runs = np.unique(np.concatenate((line[on] * n + to[on], start[back] * n + line[back])))
    return runs // max(n, 1), runs % max(n, 1)


_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def run_hashes(lines: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of runs of line hashes: a polynomial over the run's lines, moved to power 0, and their number."""
    if len(_POWERS[0]) < len(lines):
        n = 2 * len(lines)
        _POWERS[:] = [powers(MUL, n), powers(pow(MUL, -1, 1 << 64), n)]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(lines) * _POWERS[0][:len(lines)], dtype=np.uint64)))
    return mix(mix((total[last + 1] - total[first]) * _POWERS[1][first]) + (last - first).astype(np.uint64))


# ---------------------------------------------------------------- patience diff

def aligned(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of (earlier line, later line) pairs that increases in both."""
    pairs = sorted(pairs, key=lambda p: (p[1], p[0]))
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (a, _) in enumerate(pairs):
        k = bisect_left(tails, a)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(a)
            at.append(n)
        else:
            tails[k], at[k] = a, n
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Aligned blocks (line of a, line of b, number of lines) of two lists, in order."""
    matched: list[tuple[int, int]] = []
    ranges = [(0, len(a), 0, len(b))]
    while ranges:
        a0, a1, b0, b1 = ranges.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and in_b.get(x) == 1}
        anchors = aligned([(place[x], j) for j, x in enumerate(b[b0:b1], b0) if x in place])
        if not anchors:
            continue
        i, j = a0, b0
        for x, y in [*anchors, (a1, b1)]:
            ranges.append((i, x, j, y))
            i, j = x, y
        # An anchor begins the range after it, where it is matched as its equal first line.
    out: list[tuple[int, int, int]] = []
    for i, j in sorted(matched):
        if out and (i, j) == (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]):
            out[-1] = (*out[-1][:2], out[-1][2] + 1)
        else:
            out.append((i, j, 1))
    return out


def grown(a: list[int], b: list[int], block: tuple[int, int, int]) -> tuple[int, int]:
    """First and last line in b of a block grown over equal lines on both sides."""
    i, j, n = block
    up = 0
    while i - up > 0 and j - up > 0 and a[i - up - 1] == b[j - up - 1]:
        up += 1
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return j - up, j + n - 1


def common_runs(a: np.ndarray, b: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Runs of lines of b, in order, that cover its blocks of ``min_words`` words in a; ``words``: of b's lines."""
    shared = np.isin(b, a)
    if words[shared].sum() < min_words:
        return []
    total = np.concatenate(([0], np.cumsum(words)))
    out = []
    x, y = a.tolist(), b.tolist()
    for block in patience(x, y):
        first, last = grown(x, y, block)
        if total[last + 1] - total[first] >= min_words:
            out.append((first, last))
    left = shared.copy()
    for first, last in out:
        left[first:last + 1] = False
    if left.any():  # blocks that moved, or come again
        size = words.copy()
        first, last = shortest_runs(size, min_words)
        outside = np.concatenate(([0], np.cumsum(~shared)))
        inside = outside[last + 1] == outside[first]  # runs of shared lines only
        first, last = first[inside], last[inside]
        if len(first):
            size = np.zeros(len(a), words.dtype)
            order = np.argsort(b, kind="stable")
            at = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
            same = b[order[at]] == a
            size[same] = words[order[at[same]]]
            theirs = shortest_runs(size, min_words)
            held = np.isin(run_hashes(b, first, last), run_hashes(a, *theirs))
            out += zip(first[held].tolist(), last[held].tolist())
    return sorted(out)


# ---------------------------------------------------------------- Spark

LINES = "_id long, _lines binary, _words array<int>"


def _line_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text): the hashes of its lines, eight bytes each, and their words."""
    import xxhash
    for batch in batches:
        out: list[tuple] = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                h = np.array([xxhash.xxh3_64_intdigest(x) for x in text.split("\n")], np.uint64)
                out.append((doc, h.tobytes(), line_sizes(text)))
        cols = list(zip(*out)) if out else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()),
                                          pa.array(cols[2], pa.list_(pa.int32()))], names=["_id", "_lines", "_words"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lines, words): a row for each line with words."""
    for batch in batches:
        words = batch.column(2)
        lines = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        ids = np.repeat(batch.column(0).to_numpy(), words.value_lengths().to_numpy(zero_copy_only=False))
        some = words.flatten().to_numpy(zero_copy_only=False) > 0
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(lines[some])], names=["_id", "_h"])


def _list(lines: bytes) -> np.ndarray:
    return np.frombuffer(lines, np.uint64)


def _pair_runs(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(later, earlier, lines, words) sorted so that a later document's own list, without earlier, comes first."""
    own, lines, words = None, None, None
    for batch in batches:
        out: list[tuple] = []
        for later, earlier, theirs, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                                batch.column(3)):
            if earlier is None:
                own, lines, words = later, _list(theirs), size.values.to_numpy().astype(np.int64)
            else:
                assert own == later
                out += [(later, *run) for run in common_runs(_list(theirs), lines, words, min_words)]
        cols = list(zip(*out)) if out else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())],
                                         names=["_id", "_from", "_to"])


def _frequent_runs(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(id, lines, words, frequent hashes): hashed shortest runs of frequent lines and lines without words."""
    names = ["_id", "_from", "_to", "_h"]
    for batch in batches:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names]
        for doc, lines, words, often in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
            h = _list(lines)
            size = words.values.to_numpy().astype(np.int64)
            gone = ~np.isin(h.view(np.int64), often.values.to_numpy(zero_copy_only=False)) & (size > 0)
            first, last = shortest_runs(size, min_words)
            outside = np.concatenate(([0], np.cumsum(gone)))
            inside = outside[last + 1] == outside[first]
            first, last = first[inside], last[inside]
            if len(first):
                key = run_hashes(h, first, last).view(np.int64)
                for col, v in zip(out, (np.full(len(first), doc, np.int64), first, last, key)):
                    col.append(v)
        kinds = [np.int64, np.int32, np.int32, np.int64]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t)) for c, t in zip(out, kinds)], names=names)


def _deleted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, runs): the lines in any run, in time linear in the runs and lines."""
    for batch in batches:
        lines = []
        for runs in batch.column(1):
            first, last = (runs.values.field(k).to_numpy() for k in (0, 1))
            edge = np.zeros(int(last.max()) + 2, np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, last + 1, -1)
            lines.append(np.flatnonzero(np.cumsum(edge)[:-1]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.list_(pa.int32()))], names=["_id", "_drop"])


def duplicate_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and ``_drop`` (line numbers) of the documents that lose lines."""
    spark = docs.sparkSession
    lists = written(spark, keyed(docs, id_col, text_col).mapInArrow(_line_lists, LINES), "line-lists")
    hashes = lists.mapInArrow(_hashes, "_id long, _h long")
    kinds = hashes.groupBy("_h").agg(F.min("_id").alias("_lo"), F.max("_id").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    kinds = written(spark, kinds.where("_lo < _hi").select("_h", (F.col("_n") <= RARE).alias("_rare")), "shared-lines")
    rare, frequent = kinds.where("_rare").select("_h"), kinds.where("NOT _rare").select("_h")
    holders = written(spark, mark_probable(hashes, rare, "_h").where("_hit").drop("_hit").join(rare, "_h"), "rare-holders")

    # Documents that share a rare line, and their alignments.
    group = holders.groupBy("_h").agg(F.sort_array(F.collect_set("_id")).alias("_ids"))  # RARE at most
    pairs = group.select(F.explode(F.expr("flatten(transform(_ids, (x, i) -> transform(slice(_ids, 1, i), y -> struct(x AS later, y AS earlier))))"))
                         .alias("p")).select("p.later", "p.earlier").distinct()
    pairs = written(spark, pairs, "overlapping")
    of = lambda k: mark_probable(lists, pairs.select(F.col(k).alias("_id"))).where("_hit").select(F.col("_id").alias(k), "_lines", "_words")
    own = of("later").join(pairs.select("later").distinct(), "later").select("later", F.lit(None).cast("long").alias("earlier"), "_lines", "_words")
    met = pairs.join(of("earlier"), "earlier").select("later", "earlier", "_lines", "_words").unionByName(own)
    met = met.repartition("later").sortWithinPartitions("later", F.col("earlier").asc_nulls_first())
    runs = met.mapInArrow(lambda it: _pair_runs(it, min_words), "_id long, _from int, _to int")

    # Runs of frequent lines; other lines that the bitmap lets pass only add runs that no other document has, or has too.
    own_lines = mark_probable(hashes, frequent, "_h").where("_hit").groupBy("_id").agg(F.collect_set("_h").alias("_often"))  # of one document
    keys = lists.join(own_lines, "_id").mapInArrow(lambda it: _frequent_runs(it, min_words), "_id long, _from int, _to int, _h long")
    keys = written(spark, keys, "blocks")
    # First holder of each run that more than one document has; one row a run, pre-aggregated.
    first = (keys.groupBy("_h").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
             .where("_last > _first").select("_h", "_first"))
    # A run may be in a third of all documents: its later holders spread over SALTS tasks.
    first = first.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    later = keys.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"))
    # The same plan at every size: by shuffle, as neither side has a bound.
    links = later.join(first.hint("merge"), ["_h", "_salt"]).where("_id > _first").select("_id", "_from", "_to")

    # Runs of one document: bounded by its length.
    per_doc = links.unionByName(runs).distinct().groupBy("_id").agg(F.collect_list(F.struct("_from", "_to")).alias("_runs"))
    return per_doc.mapInArrow(_deleted, "_id long, _drop array<int>")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                dropped_col: str | None = None) -> DataFrame:
    """``docs``, all columns, with the lines deleted from the text; ``dropped_col``: how many."""
    drops = written(docs.sparkSession, duplicate_lines(docs, min_words, id_col, text_col), "deletions")
    cols = [c for c in docs.columns if c != dropped_col]
    key, hit, lines, count = fresh(cols, "_key", "_hit", "_drop", "_n")
    own = list(map(column, cols))
    rows = docs.select(*own, F.coalesce(column(id_col).cast("long"), F.lit(NULL_ID)).alias(key))
    rows = mark_probable(rows, drops.select(F.col("_id").alias(key)), key, hit)
    touched = rows.where(column(hit)).join(drops.select(F.col("_id").alias(key), F.col("_drop").alias(lines)).hint("merge"), key, "left")
    schema = T.StructType([*docs.select(*own).schema.fields, T.StructField(count, T.IntegerType())])
    at = cols.index(text_col)
    edited = positional(touched.select(*own, column(lines))).mapInArrow(lambda it: _edited(it, at, schema.names), schema)
    out = rows.where(~column(hit)).select(*own, F.lit(0).alias(count)).unionByName(edited)
    return out.withColumnRenamed(count, dropped_col) if dropped_col else out.drop(count)


def _edited(batches: Iterator[pa.RecordBatch], text: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Deletes the lines that the last column numbers; puts their number in its place."""
    for batch in batches:
        texts, dropped = batch.column(text).to_pylist(), []
        for i, drop in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            gone = set(drop or ())
            if gone and texts[i]:
                texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone)
            dropped.append(len(gone))
        columns = [*batch.columns[:-1], pa.array(dropped, pa.int32())]
        columns[text] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=names)


def report(docs: DataFrame) -> DataFrame:
    """Per document: lines, deleted lines and a digest of the text that is left."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0).alias("n_lines"))
    return dedup_lines(rows, dropped_col="n_deleted").select(
        "doc_id", "n_lines", "n_deleted", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
