"""Test items contained in documents (DataFrame functions only).

An item's containment in a document is the share of the item's distinct 5-word shingles
(lower-cased A-Z, words between white space) that the document has; a text with fewer
words is one shingle.  Matches have a containment of at least ``threshold``.

Method (size-partitioned MinHash containment search): an item of n shingles that is
contained lacks at most n - ceil(threshold * n) of them, so of its n - ceil(threshold * n)
+ 1 smallest hashes (its bottom-k MinHash sketch, k growing with the size) at least one is
in the document: the search misses nothing, however long the document.  Sketch length and
least document size are set per size class of items, and documents probe only the classes
that they are large enough for.  Candidates are verified by counting all shingles that item
and document share.

The item index is broadcast while it has at most ``max_broadcast`` rows of two longs and
an int (checked by a count), else it joins by shuffle, where adaptive execution splits
frequent shingles.  Documents are never shuffled, but for the texts of candidates.

Results for odd input: see ``common.keyed`` for nulls and repeated ids of items and
documents; a text without words matches nothing; an empty table on either side gives no
rows; ties cannot arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import keyed, mark_probable, public_id, written

WIDTH = 5
THRESHOLD_PERCENT = 75
MAX_BROADCAST = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    parts = F.split(F.translate(F.col(text), _UPPER, _LOWER), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def with_shingles(rows: DataFrame) -> DataFrame:
    """``_id`` and ``_set``: the distinct shingle hashes of ``_text``.

    Explode ``_set`` by the outer form: for the plain one the optimizer adds a filter on the
    array's size below, with the whole expression for each of its words.
    """
    w = rows.select("_id", words("_text").alias("_w"))
    many = F.transform(F.sequence(F.lit(1), F.size("_w") - (WIDTH - 1)),
                       lambda i: F.xxhash64(F.slice(F.col("_w"), i, F.lit(WIDTH))))
    grams = (F.when(F.size("_w") >= WIDTH, many).when(F.size("_w") > 0, F.array(F.xxhash64("_w")))
             .otherwise(F.array().cast("array<long>")))
    return w.select("_id", F.array_distinct(grams).alias("_set"))


def item_index(items: DataFrame, percent: int) -> DataFrame:
    """One row per item and shingle: ``_item``, ``_h``, ``_n`` (shingles), ``_least`` (shared ones
    needed), ``_class`` (size class: bits of the size), ``_probe`` (in the bottom-k sketch)."""
    sets = with_shingles(items).withColumn("_n", F.size("_set"))
    sets = sets.withColumn("_least", F.expr(f"cast((_n * {percent} + 99) div 100 as int)"))
    # Of a class with sizes in [2**(c-1), 2**c) the longest item needs this many smallest hashes.
    sets = sets.withColumn("_class", F.length(F.bin(F.col("_n").cast("long"))))
    top = F.expr("shiftleft(1, _class) - 1")
    k = top - F.expr(f"cast(((shiftleft(1, _class) - 1) * {percent} + 99) div 100 as int)") + 1
    return (sets.withColumn("_k", k).select(F.col("_id").alias("_item"), "_n", "_least", "_class", "_k",
                                            F.posexplode_outer(F.array_sort("_set")).alias("_rank", "_h"))
            .where("_h IS NOT NULL").select("_item", "_h", "_n", "_least", "_class", (F.col("_rank") < F.col("_k")).alias("_probe")))


def contaminated(docs: DataFrame, items: DataFrame, percent: int = THRESHOLD_PERCENT,
                 max_broadcast: int = MAX_BROADCAST, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents and the items they contain: doc_id, item_id, n_item, n_shared, containment."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    index = written(spark, item_index(keyed(items, item_col, item_text), percent), "item-index")
    small = index.count() <= max_broadcast
    place = F.broadcast if small else (lambda df: df)

    probes = index.where("_probe").select("_h", "_item", "_least")
    found = (with_shingles(rows).withColumn("_size", F.size("_set"))
             .select("_id", "_size", F.explode_outer("_set").alias("_h"))
             .join(place(probes), "_h").where("_size >= _least").select("_id", "_item").distinct())
    found = written(spark, found, "candidates")

    near = mark_probable(rows, found.select("_id").distinct()).where("_hit").drop("_hit")
    near = near.join(found.select("_id").distinct(), "_id", "left_semi")
    shared = (with_shingles(near).select("_id", F.explode_outer("_set").alias("_h"))
              .join(place(index.select("_h", "_item", "_n", "_least")), "_h")
              .groupBy("_id", "_item", "_n", "_least").agg(F.count(F.lit(1)).alias("n_shared")))
    return (shared.join(found, ["_id", "_item"]).where("n_shared >= _least")
            .select(public_id(), F.when(F.col("_item") != F.lit(-(1 << 63)), F.col("_item")).alias("item_id"),
                    F.col("_n").cast("long").alias("n_item"), "n_shared",
                    (F.col("n_shared") / F.col("_n")).alias("containment")))


def _shingles_sql(table: str, key: str) -> str:
    return f"""
    SELECT DISTINCT k, unnest(CASE WHEN len(w) >= {WIDTH}
             THEN [array_to_string(w[i:i + {WIDTH - 1}], ' ') for i in range(1, len(w) - {WIDTH - 2})]
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM (SELECT k, [x for x in u if x <> ''] AS w FROM (
            SELECT {key} AS k, string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                  '[\\x20\\x09-\\x0D]+') AS u FROM {table}))"""


ORACLE_SQL = f"""
WITH d AS ({_shingles_sql('documents', 'doc_id')}),
i AS ({_shingles_sql('benchmark', 'item_id')}),
size AS (SELECT k, count(*) AS n FROM i GROUP BY k)
SELECT d.k AS doc_id, i.k AS item_id, any_value(n) AS n_item, count(*) AS n_shared,
       count(*) / any_value(n) AS containment
FROM d JOIN i ON d.s = i.s JOIN size ON size.k = i.k
GROUP BY d.k, i.k HAVING 100 * count(*) >= {THRESHOLD_PERCENT} * any_value(n)
"""
