"""Baskets and frequent-itemset mining.

Mining uses Spark ML's ``FPGrowth`` (parallel FP-growth: item counts, then
conditional transactions hashed to ``num_partitions`` groups, one FP-tree
per group).  Its frequent-item list is bounded by the support threshold:
at most (average basket size / min_support) items can be frequent.  The
itemsets are not: up to all subsets of the frequent items may pass, so
full rule tables are written in parallel.  Where one-item rules are
enough no itemset is grown at all: ``pair_rules`` counts pairs of
frequent items (Apriori to level two), for all labels in one aggregate.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.plans.strategies import broadcast_if_bounded, cut_lineage
from tillroll.schema import BASKET_KEY, ITEMS, RECS, STOCK_CODE
from tillroll.session import checkpoint_root

# Default thresholds of the recommendation jobs.
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.2
# Frequent items of a purchase whose pairs one row gives.
PAIR_BLOCK = 128


def baskets(tx: DataFrame, item_col: str = STOCK_CODE, key_cols=BASKET_KEY) -> DataFrame:
    """One row per purchase with its distinct items, sorted.

    ``collect_set`` is a map-side-combined aggregate; nulls are dropped.
    """
    return tx.groupBy(*key_cols).agg(F.array_sort(F.collect_set(item_col)).alias(ITEMS))


def fit_rules(basket_df: DataFrame, min_support: float = MIN_SUPPORT,
              min_confidence: float = MIN_CONFIDENCE, items_col: str = ITEMS,
              num_partitions: int | None = None) -> FPGrowthModel:
    """Fit FPGrowth on a basket column.

    ``num_partitions`` sets the number of FP-tree groups (FPGrowth's own
    default is the input's partition count).  Input items must be distinct per row
    (``baskets`` guarantees it).
    """
    fp = (FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=min_confidence,
                   predictionCol=RECS))
    if num_partitions:
        fp = fp.setNumPartitions(int(num_partitions))
    return fp.fit(basket_df.select(items_col))


def frequent_itemsets(model: FPGrowthModel) -> DataFrame:
    """(items sorted, freq) for every frequent itemset."""
    fi = model.freqItemsets
    return fi.select(F.array_sort(F.col("items")).alias("items"), F.col("freq"))


def association_rules(model: FPGrowthModel) -> DataFrame:
    """(antecedent sorted, consequent, confidence, lift, support); consequents have one item."""
    r = model.associationRules
    return r.select(F.array_sort(F.col("antecedent")).alias("antecedent"), F.col("consequent"),
                    F.col("confidence"), F.col("lift"), F.col("support"))


class RuleSet(NamedTuple):
    """Frequent itemsets (None when not kept) and association rules of one mining run."""
    itemsets: DataFrame | None
    rules: DataFrame


@contextmanager
def _fitted(basket_df: DataFrame, min_support: float, min_confidence: float, items_col: str,
            num_partitions: int | None, stored: bool):
    """A fitted model, whose input stays cached meanwhile unless it is ``stored``.

    FPGrowth reads its input three times (count, item frequencies, FP-tree
    growth) and builds its outputs lazily.  An input that is a written table
    (or a cheap join of such) is read again; any other is persisted.
    """
    if not num_partitions:
        # FP-tree groups follow the shuffle setting: the input may arrive in a
        # few coalesced partitions, and a job may start on few executors.
        num_partitions = int(basket_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = basket_df.select(items_col)
    if not stored:
        items = items.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield fit_rules(items, min_support, min_confidence, items_col, num_partitions)
    finally:
        if not stored:
            items.unpersist()


def pair_rules(purchases: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               items_col: str = ITEMS, label_col: str | None = None) -> DataFrame:
    """Rules with one item on either side, (_item, _cons, confidence), and their label first if there are labels.

    Counts are keyed by (label, item) and (label, a, b), so any number of labels (a purchase's
    rows, one a label) is one job; support is relative to the label's own purchases.  First
    the frequent items, then only pairs of these, counted map-side.  The items that a label keeps are
    bounded by its threshold.  A purchase of more than PAIR_BLOCK frequent items is dealt in pairs of blocks
    to all tasks, so none makes all pairs of a large purchase.  ``purchases`` is read twice: a
    written table, or derived from one.
    """
    spark = purchases.sparkSession
    label = F.col(label_col) if label_col else F.lit("")
    rows = purchases.select(label.alias("_label"), F.col(items_col).alias("_items"))
    total = rows.groupBy("_label").agg(F.ceil(F.lit(min_support) * F.count(F.lit(1))).alias("_least"))
    total = cut_lineage(spark, total, "label-thresholds")
    single = (rows.select("_label", F.explode("_items").alias("_item")).groupBy("_label", "_item").agg(F.count(F.lit(1)).alias("_n"))
              .join(total, "_label").where(F.col("_n") >= F.col("_least")).select("_label", "_item", "_n"))
    single = cut_lineage(spark, single, "frequent-items")
    lists, _ = broadcast_if_bounded(cut_lineage(
        spark, single.groupBy("_label").agg(F.collect_set("_item").alias("_frequent")), "frequent-lists"))
    kept = rows.join(lists, "_label").select("_label", F.array_sort(F.array_intersect("_items", "_frequent")).alias("_items"))
    size = F.size("_items")
    small = kept.where((size > 1) & (size <= PAIR_BLOCK)).select("_label", F.col("_items").alias("_a"), F.lit(None).cast("array<string>").alias("_b"))
    blocks = F.expr(f"""flatten(transform(sequence(0, (size(_items) - 1) div {PAIR_BLOCK}), i -> transform(
        sequence(i, (size(_items) - 1) div {PAIR_BLOCK}), j -> struct(
            slice(_items, i * {PAIR_BLOCK} + 1, {PAIR_BLOCK}) AS a,
            IF(i = j, CAST(NULL AS array<string>), slice(_items, j * {PAIR_BLOCK} + 1, {PAIR_BLOCK})) AS b))))""")
    large = (kept.where(size > PAIR_BLOCK).select("_label", F.explode(blocks).alias("p")).select("_label", F.col("p.a").alias("_a"), F.col("p.b").alias("_b"))
             .repartition(F.xxhash64("_a", "_b")))
    # Within a block each item with those after it, between blocks each with each; items are sorted.
    pairs = F.expr("""flatten(transform(_a, (x, i) -> transform(
        coalesce(_b, slice(_a, i + 2, size(_a))), y -> struct(x AS a, y AS c))))""")
    counts = (small.unionByName(large).select("_label", F.explode(pairs).alias("p"))
              .groupBy("_label", F.col("p.a").alias("_a"), F.col("p.c").alias("_c")).agg(F.count(F.lit(1)).alias("_both")))
    counts = cut_lineage(spark, counts.join(total, "_label").where(F.col("_both") >= F.col("_least")).drop("_least"), "pair-counts")
    both = counts.select("_label", "_both", F.explode(F.array(F.struct(F.col("_a").alias("a"), F.col("_c").alias("c")),
                                                              F.struct(F.col("_c").alias("a"), F.col("_a").alias("c")))).alias("p"))
    rules = both.select("_label", F.col("p.a").alias("_item"), F.col("p.c").alias("_cons"), "_both").join(single, ["_label", "_item"])
    confidence = F.col("_both").cast("double") / F.col("_n").cast("double")
    keep = ([F.col("_label").alias(label_col)] if label_col else []) + [F.col("_item"), F.col("_cons"), confidence.alias("confidence")]
    return rules.select(*keep).where(F.col("confidence") >= min_confidence)


def mine_pair_rules(basket_df: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
                    items_col: str = ITEMS, stored: bool = False) -> DataFrame:
    """``pair_rules`` of unlabelled baskets, which are written first unless they are ``stored``."""
    if not stored:
        basket_df = cut_lineage(basket_df.sparkSession, basket_df.select(items_col), "baskets")
    return pair_rules(basket_df, min_support, min_confidence, items_col)


def mine_rules(basket_df: DataFrame, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, items_col: str = ITEMS,
               num_partitions: int | None = None, with_itemsets: bool = True, stored: bool = False) -> RuleSet:
    """Fit FPGrowth and return its itemsets and rules as checkpointed tables.

    ``with_itemsets=False`` skips writing the itemsets when only the rules
    are needed (``RuleSet.itemsets`` is then None).  ``stored`` tells that
    the input is a written table, which needs no cache.

    The itemsets are cached while the rules are derived from them, and both
    results are checkpointed into ``spark.checkpoint.dir``, by all tasks in
    parallel.  Afterwards nothing downstream depends on the basket lineage
    or on cached blocks.
    """
    checkpoint_root(basket_df.sparkSession)
    with _fitted(basket_df, min_support, min_confidence, items_col, num_partitions, stored) as model:
        fi = model.freqItemsets.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rules = association_rules(model).checkpoint(eager=True)
            itemsets = frequent_itemsets(model).checkpoint(eager=True) if with_itemsets else None
        finally:
            fi.unpersist()
    return RuleSet(itemsets, rules)
