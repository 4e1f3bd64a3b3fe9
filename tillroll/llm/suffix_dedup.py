"""Exact removal of repeated byte strings, by a depth-limited radix sort of suffixes.

Every byte covered by a string of THRESHOLD bytes (a window) that also starts earlier, in a
document with a smaller id or earlier in the same one, is removed; strings are judged on
the input.  Two suffixes need ordering only through their first THRESHOLD bytes, and equal
groups at that depth are exactly the repeated windows.  The digits are taken most
significant first, and a suffix that is alone in its bucket goes no further:

1. The first digit of a window is its anchor, the smallest hash among its ANCHOR-byte
   strings (the leftmost of ties).  Equal windows have equal anchors at equal places, and
   adjoining windows share an anchor, so a row stands for a region of up to 69 windows: one
   row for about 35 bytes.  A region alone with its anchor is done.
2. The second digit is the whole region's bytes: a region equal to an earlier one has only
   repeated windows.  Tasks settle this among their own rows before the shuffle, so copies
   of a passage send one row a task, however many there are; then the first of each class
   is found among tasks.
3. The last digit is each window itself, only for the first regions of classes that share an
   anchor, that is for the edges of passages.  Their bytes are fetched from the texts.
   Buckets of more than ``bucket_limit`` regions are not held in one task: their windows
   become rows, whose first ones are found by an aggregate and joined back.

Digits are 64-bit hashes; windows taken for equal agree in two of one polynomial family, at their anchor and as a whole.

Results for odd input: see ``common.keyed``; texts shorter than THRESHOLD bytes lose
nothing; overlapping repeats count; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import MUL, keyed, mark_probable, mix, powers, public_id, text_chunks, written

THRESHOLD = 100
ANCHOR = 32
SPAN = THRESHOLD - ANCHOR + 1  # anchors a window has, and the most windows of a region
_PIECE = 1 << 20               # bytes hashed at once; positions in it take 20 bits
_LOW = np.uint64(_PIECE - 1)
FLUSH_ROWS = 1 << 20           # regions a task settles among themselves at once
BUCKET_LIMIT = 20_000          # regions with one anchor that a task compares at once
_U = np.uint64
_ROWS = "kg long, ctx long, doc long, pos long"
_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _TABLES:
        _TABLES.extend((powers(MUL, _PIECE + 1), powers(pow(MUL, -1, 1 << 64), _PIECE + 1)))
    return _TABLES


def _prefix_hash(data: np.ndarray) -> np.ndarray:
    h = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _tables()[0][:len(data)], out=h[1:])
    return h


def regions(data: np.ndarray, offsets: np.ndarray):
    """Regions of adjoining texts of at most _PIECE bytes: text, start, anchor - start, number of
    windows, hash of the anchor and of the region."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < THRESHOLD:
        return none, none, none, none, none.astype(_U), none.astype(_U)
    undo = _tables()[1]
    h = _prefix_hash(data)
    gram = mix((h[ANCHOR:] - h[:-ANCHOR]) * undo[:n - ANCHOR + 1])
    low = (gram & ~_LOW) | np.arange(len(gram), dtype=_U)
    step = 1
    while step * 2 <= SPAN:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    windows = n - THRESHOLD + 1
    low = np.minimum(low[:windows], low[SPAN - step:SPAN - step + windows])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(text[:windows] == text[THRESHOLD - 1:])
    if not len(at):
        return none, none, none, none, none.astype(_U), none.astype(_U)
    anchor = (low[at] & _LOW).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    start, anchor = at[first], anchor[first]
    count = np.diff(np.append(first, len(at)))
    shape = ((anchor - start) * 128 + count).astype(_U)
    whole = mix((h[start + count - 1 + THRESHOLD] - h[start]) * undo[start] + mix(shape))
    return text[start], start - offsets[text[start]], anchor - start, count, gram[anchor], whole


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """Parts of adjoining texts: (first text, bytes, offsets, bytes before in a cut text)."""
    if len(data) <= _PIECE:
        yield 0, data, offsets, 0
        return
    for i in range(len(offsets) - 1):  # a chunk is over the size only if it is one long text
        size = int(offsets[i + 1] - offsets[i])
        for at in range(0, max(size - THRESHOLD + 1, 1), _PIECE - THRESHOLD + 1):
            part = data[offsets[i] + at:min(offsets[i] + at + _PIECE, offsets[i + 1])]
            yield i, part, np.array([0, len(part)]), at


def pack(start, lead, count):
    return start * (1 << 14) + lead * 128 + count


def unpack(pos):
    return pos >> 14, (pos >> 7) & 127, pos & 127


def _first_of_task(kg, ctx, doc, pos) -> pa.RecordBatch:
    """The first region of each class; the others as merged intervals, with a position below 0
    and the end in ``ctx``."""
    order = np.lexsort((pos, doc, ctx, kg))
    kg, ctx, doc, pos = kg[order], ctx[order], doc[order], pos[order]
    first = np.ones(len(kg), bool)
    first[1:] = (kg[1:] != kg[:-1]) | (ctx[1:] != ctx[:-1])
    d, s, e = merge(doc[~first], pos[~first] >> 14, (pos[~first] >> 14) + (pos[~first] & 127) - 1 + THRESHOLD)
    spread = mix(d.astype(_U) * _U(MUL) + s.astype(_U)).astype(np.int64)
    cols = ((kg[first], spread), (ctx[first], e), (doc[first], d), (pos[first], -1 - s))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a.astype(np.int64), b])) for a, b in cols],
                                      names=["kg", "ctx", "doc", "pos"])


def merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Intervals by document, those that overlap or touch as one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    group = np.concatenate(([0], np.cumsum(doc[1:] != doc[:-1])))
    far = np.maximum.accumulate(end + group * (1 << 40))  # running largest end within a document
    new[1:] = start[1:] + group[1:] * (1 << 40) > far[:-1]
    first = np.flatnonzero(new)
    return doc[first], start[first], far[np.append(first[1:], len(doc)) - 1] - group[first] * (1 << 40)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    rows = 0
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for at, data, offsets in text_chunks(batch.column(1), _PIECE):
            for i, part, ends, base in _pieces(data, offsets):
                text, start, lead, count, kg, ctx = regions(part, ends)
                held.append((kg.astype(np.int64), ctx.astype(np.int64), ids[at + i + text], pack(start + base, lead, count)))
                rows += len(kg)
        if rows >= FLUSH_ROWS:
            yield _first_of_task(*map(np.concatenate, zip(*held)))
            held, rows = [], 0
    if rows:
        yield _first_of_task(*map(np.concatenate, zip(*held)))


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, [(kg, pos)]) as one row a region with its bytes."""
    for batch in batches:
        kg, doc, pos, data = [], [], [], []
        for d, text, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = text.encode("utf-8")
            for x in want:
                start, _, count = unpack(x["pos"])
                kg.append(x["kg"])
                doc.append(d)
                pos.append(x["pos"])
                data.append(raw[start:start + count - 1 + THRESHOLD])
        yield pa.RecordBatch.from_arrays([pa.array(kg, pa.int64()), pa.array(doc, pa.int64()), pa.array(pos, pa.int64()),
                                          pa.array(data, pa.binary())], names=["kg", "doc", "pos", "data"])


def _window_hashes(kg, pos, data: list[bytes]):
    """Of all windows of regions: region, start, and two hashes (anchor and place; bytes)."""
    start, lead, count = unpack(pos)
    size = count - 1 + THRESHOLD
    base = np.cumsum(size) - size
    h = _prefix_hash(np.frombuffer(b"".join(data), np.uint8))
    region = np.repeat(np.arange(len(pos)), count)
    j = np.arange(len(region)) - np.repeat(np.cumsum(count) - count, count)
    at = base[region] + j
    whole = mix((h[at + THRESHOLD] - h[at]) * _tables()[1][at])
    place = mix(kg[region].astype(_U) * _U(MUL) + (lead[region] - j).astype(_U))
    return region, start[region] + j, place, whole


_REGIONS_AT_ONCE = 6_000  # of 168 bytes at most, so that they fit the tables of powers


def _repeated_windows(kg, doc, pos, data: list[bytes]):
    """Intervals of the windows of whole buckets (in order of document and place) that an earlier
    region has."""
    parts = [_window_hashes(kg[i:i + _REGIONS_AT_ONCE], pos[i:i + _REGIONS_AT_ONCE], data[i:i + _REGIONS_AT_ONCE])
             for i in range(0, len(kg), _REGIONS_AT_ONCE)]
    region = np.concatenate([p[0] + i * _REGIONS_AT_ONCE for i, p in enumerate(parts)])
    start, place, whole = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
    order = np.argsort(place * _U(MUL) ^ whole, kind="stable")
    again = np.zeros(len(order), bool)
    again[order[1:]] = (place[order[1:]] == place[order[:-1]]) & (whole[order[1:]] == whole[order[:-1]])
    return merge(doc[region[again]], start[again], start[again] + THRESHOLD)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (kg, doc, pos): the repeated windows, a run of whole buckets at a time."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        if rest.num_rows >= BUCKET_LIMIT:
            kg = rest.column("kg").to_numpy()
            cut = int(np.searchsorted(kg, kg[-1]))  # the last bucket may go on
            if cut:
                yield _intervals(rest.slice(0, cut))
                rest = rest.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield _intervals(rest)


def _intervals(t: pa.Table) -> pa.RecordBatch:
    cols = _repeated_windows(*(t.column(c).to_numpy() for c in ("kg", "doc", "pos")), t.column("data").to_pylist())
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["doc", "s", "e"])


def _as_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _REGIONS_AT_ONCE):
            b = batch.slice(at, _REGIONS_AT_ONCE)
            doc = b.column(1).to_numpy()
            region, start, place, whole = _window_hashes(b.column(0).to_numpy(), b.column(2).to_numpy(), b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(whole.astype(np.int64)),
                                              pa.array(doc[region]), pa.array(start)], names=["k1", "k2", "doc", "p"])


def repeated_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       bucket_limit: int = BUCKET_LIMIT) -> tuple[DataFrame, DataFrame]:
    """The keyed documents (``_id``, ``_text``) and ``_id``, ``_cuts`` (array of byte intervals, which
    may overlap) of those that lose bytes."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    near = F.expr("lag(ctx) OVER (PARTITION BY kg ORDER BY ctx, doc, pos)"), \
        F.expr("lead(ctx) OVER (PARTITION BY kg ORDER BY ctx, doc, pos)")
    anchored = rows.mapInArrow(_anchored, _ROWS).select("*", near[0].alias("before"), near[1].alias("after"))
    settled = (F.col("pos") < 0) | F.col("ctx").eqNullSafe(F.col("before"))
    shared = written(spark, anchored.where("pos < 0 OR before IS NOT NULL OR after IS NOT NULL")
                     .select("kg", "ctx", "doc", "pos", settled.alias("settled")), "shared-regions")
    start, count = F.shiftright("pos", 14), F.col("pos").bitwiseAND(127)
    done = shared.where("settled").select(
        "doc", F.when(F.col("pos") < 0, -1 - F.col("pos")).otherwise(start).alias("s"),
        F.when(F.col("pos") < 0, F.col("ctx")).otherwise(start + count - 1 + THRESHOLD).alias("e"))

    open_ = shared.where("NOT settled").select("kg", "doc", "pos")
    sizes = open_.groupBy("kg").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    open_ = written(spark, open_.join(sizes, "kg"), "open-regions")

    def fetch(part: DataFrame) -> DataFrame:
        want = part.groupBy(F.col("doc").alias("_id")).agg(F.collect_list(F.struct("kg", "pos")).alias("want"))
        texts = mark_probable(rows, part.select(F.col("doc").alias("_id"))).where("_hit").select("_id", "_text")
        return texts.join(want, "_id").mapInArrow(_fetched, "kg long, doc long, pos long, data binary")

    small = (fetch(open_.where(F.col("n") <= bucket_limit)).repartition("kg").sortWithinPartitions("kg", "doc", "pos")
             .mapInArrow(_settled, "doc long, s long, e long"))
    parts = [done, small]
    if not open_.where(F.col("n") > bucket_limit).isEmpty():
        windows = written(spark, fetch(open_.where(F.col("n") > bucket_limit))
                          .mapInArrow(_as_windows, "k1 long, k2 long, doc long, p long"), "windows")
        first = windows.groupBy("k1", "k2").agg(F.min(F.struct("doc", "p")).alias("first"), F.count(F.lit(1)).alias("n"))
        again = windows.join(first.where("n > 1"), ["k1", "k2"]).where("doc != first.doc OR p != first.p")
        parts.append(again.select("doc", F.col("p").alias("s"), (F.col("p") + THRESHOLD).alias("e")))
    cuts = parts[0]
    for p in parts[1:]:
        cuts = cuts.unionByName(p)
    cuts = cuts.groupBy(F.col("doc").alias("_id")).agg(F.collect_list(F.struct("s", "e")).alias("_cuts"))
    return rows, written(spark, cuts, "cuts")


def spans(cuts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """The maximal removed runs of a document."""
    s, e = np.array([c["s"] for c in cuts], np.int64), np.array([c["e"] for c in cuts], np.int64)
    return merge(np.zeros(len(s), np.int64), s, e)[1:]


def kept_bytes(raw: bytes, cuts: list[dict]) -> tuple[bytes, int]:
    """What is left of a text and the number of maximal removed runs."""
    starts, ends = spans(cuts)
    edges = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])), len(starts)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = text.encode("utf-8")
            kept, n = kept_bytes(raw, cuts or [])
            out.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest()))
        a, b, c, d = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (a, b, c)), pa.array(d, pa.string())],
            names=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs and the SHA-256 of the rest."""
    rows, cuts = repeated_intervals(docs, id_col, text_col, bucket_limit)
    marked = mark_probable(rows, cuts.select("_id"))
    hit = marked.where("_hit").select("_id", "_text").join(cuts, "_id", "left").select("_id", "_text", "_cuts")
    edited = hit.mapInArrow(_digests, "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    whole = marked.where("NOT _hit").select(
        "_id", F.octet_length("_text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.encode("_text", "UTF-8"), 256).alias("kept_sha256"))
    out = edited.unionByName(whole)
    return out.select(public_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256")
