"""Confidence-ranked recommendations from association rules.

Rules are applied with joins, not by collecting them to the driver: a rule
fires for a basket when every antecedent item is in the basket and its
consequent is not.  The antecedents are a prefix tree, each with its rarest item
first, and the baskets' items descend it level by level: a basket is at a node if it is at
the parent and has the node's item.  Rows are a basket's number and an item or a node; the
baskets' arrays are joined back once, at the end.  Levels and rules are broadcast only after a
check of their bytes, otherwise both sides shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import merge_lists, split_list_dropping_trailing
from tillroll.plans.strategies import DEFAULT_BROADCAST_BYTES, broadcast_if_bounded, cut_lineage
from tillroll.schema import BASKET_KEY, ITEMS, KEY, RECS, RECS2, STOCK_CODE


def _ranked(conf_col: str, item_col: str):
    """Aggregate: items ordered by confidence desc, then item asc, first
    occurrence of each item kept (its highest confidence)."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col(conf_col)).alias("_nc"),
                                                   F.col(item_col).alias("_it"))))
    return F.array_distinct(F.transform(ordered, lambda s: s.getField("_it")))


def one_item_rules(rules: DataFrame) -> DataFrame:
    """(item, consequent, confidence) of rules with a one-item antecedent."""
    return (rules.filter(F.size("antecedent") == 1)
            .select(F.col("antecedent").getItem(0).alias("_item"),
                    F.explode("consequent").alias("_cons"), F.col("confidence")))


def frequently_bought(rules: DataFrame, as_array: bool = False, label_col: str | None = None) -> DataFrame:
    """Per product, the products bought with it, highest confidence first.

    Equivalent to applying the rules to each product as a one-item basket:
    only rules whose antecedent is exactly that product can fire, and their
    consequent is never the product itself.  Products with no rule are
    absent (R6).  ``rules`` are association rules, or one-item rules as
    ``pair_rules`` gives them, with ``label_col`` one list a label and product.  Output
    ([label,] StockCode, recs) with recs comma-joined, or an array with ``as_array=True``.
    """
    single = rules if "_item" in rules.columns else one_item_rules(rules)
    labels = [label_col] if label_col else []
    ranked = single.groupBy(*labels, "_item").agg(_ranked("confidence", "_cons").alias(RECS))
    recs = F.col(RECS) if as_array else F.array_join(F.col(RECS), ",")
    return ranked.select(*labels, F.col("_item").alias(STOCK_CODE), recs.alias(RECS))


def _rarity(rules: DataFrame) -> DataFrame:
    """(_ante, _items): each distinct antecedent's items, (support, item), rarest first.

    An item's support is the confidence of any rule that concludes it divided
    by the rule's lift; an item that none concludes counts as rarest.  The order
    only matters for how often an antecedent is looked up.
    """
    items = rules.select(F.col("antecedent").alias("_ante")).distinct().select("_ante", F.explode("_ante").alias("_item"))
    if "lift" in rules.columns:
        support = (rules.select(F.explode("consequent").alias("_item"), (F.col("confidence") / F.col("lift")).alias("s"))
                   .groupBy("_item").agg(F.max("s").alias("_support")))
        items = items.join(support, "_item", "left")
    else:
        items = items.withColumn("_support", F.lit(0.0))
    return items.groupBy("_ante").agg(F.array_sort(F.collect_list(F.struct(
        F.coalesce("_support", F.lit(0.0)).alias("s"), F.col("_item").alias("i")))).alias("_items"))


def rule_index(rules: DataFrame) -> DataFrame:
    """(_item, _ante, _fires): each distinct antecedent with its rules, under its rarest item."""
    rows = rules.select("antecedent", F.explode("consequent").alias("_cons"), "confidence")
    fires = rows.groupBy(F.col("antecedent").alias("_ante")).agg(
        F.collect_list(F.struct((-F.col("confidence")).alias("_nc"), F.col("_cons").alias("_it"))).alias("_fires"))
    return fires.join(_rarity(rules), "_ante").select(F.col("_items")[0].i.alias("_item"), "_ante", "_fires")


def antecedent_tree(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The antecedents' prefix tree (written tables): nodes (_node, _parent, _item, _depth) and what fires at a
    node (_node, _cons, confidence)."""
    spark = rules.sparkSession
    paths = _rarity(rules).select("_ante", F.transform("_items", lambda x: x.i).alias("_path"))
    prefixes = (paths.select("_path", F.explode(F.sequence(F.lit(1), F.size("_path"))).alias("_depth"))
                .select(F.slice("_path", F.lit(1), F.col("_depth")).alias("_prefix"), "_depth").distinct()
                .withColumn("_node", F.monotonically_increasing_id()))
    prefixes = cut_lineage(spark, prefixes, "antecedent-prefixes")
    above = prefixes.select(F.col("_prefix").alias("_above"), F.col("_node").alias("_parent"))
    nodes = (prefixes.join(above, F.slice("_prefix", F.lit(1), F.col("_depth") - 1) == F.col("_above"), "left")
             .select("_node", "_parent", F.element_at("_prefix", -1).alias("_item"), "_depth"))
    ends = paths.join(prefixes.select(F.col("_prefix").alias("_path"), "_node"), "_path").select("_ante", "_node")
    fires = (rules.select(F.col("antecedent").alias("_ante"), F.explode("consequent").alias("_cons"), "confidence")
             .join(ends, "_ante").groupBy("_node", "_cons").agg(F.max("confidence").alias("confidence")))
    return cut_lineage(spark, nodes, "antecedent-tree"), cut_lineage(spark, fires, "antecedent-rules")


def recommend(basket_df: DataFrame, rules: DataFrame, key_cols=BASKET_KEY, items_col: str = ITEMS,
              keep_empty: bool = False, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Apply rules to baskets: ranked consequents not already in the basket.

    ``items_col`` must be an array column (checked before planning).
    Output: the columns of ``basket_df`` and ``recs`` (array, confidence
    descending, ties by item).  Baskets with no recommendation are dropped
    unless ``keep_empty`` (then ``recs`` is an empty array).  One row per
    value of ``key_cols`` is expected.

    Plan: the baskets are written with a number.  (number, item) rows meet the first level of the
    antecedents' tree, and for each further level (number, node) rows meet their children and the
    basket's items again; a basket meets each node once at most.  The consequents at the
    nodes reached are ranked per basket, and the arrays are joined back to drop those the basket has.
    No step holds more than one basket's candidates.
    """
    item_type = basket_df.schema[items_col].dataType
    if not isinstance(item_type, T.ArrayType):
        raise TypeError(f"column {items_col!r} must be an array of items, not {item_type.simpleString()}")
    spark = basket_df.sparkSession
    numbered = cut_lineage(spark, basket_df.withColumn("_basket", F.monotonically_increasing_id()), "numbered-baskets")
    items = numbered.select("_basket", F.explode(items_col).alias("_item")).distinct()
    nodes, fires = antecedent_tree(rules)
    fires, _ = broadcast_if_bounded(fires, max_broadcast_bytes)
    reached, at = None, None
    for depth in range(1, (nodes.agg(F.max("_depth")).first()[0] or 0) + 1):
        level, _ = broadcast_if_bounded(nodes.where(F.col("_depth") == depth).select("_parent", "_item", F.col("_node").alias("_child")),
                                        max_broadcast_bytes)
        if at is None:
            at = items.join(level, "_item")
        else:
            at = at.join(level, F.col("_node") == F.col("_parent")).select("_basket", "_item", "_child").join(items, ["_basket", "_item"])
        at = cut_lineage(spark, at.select("_basket", F.col("_child").alias("_node")), f"antecedent-level{depth}")
        reached = at if reached is None else reached.unionByName(at)
    empty = F.array().cast(item_type)
    if reached is None:
        out = numbered.withColumn(RECS, empty)
        return (out if keep_empty else out.limit(0)).drop("_basket")
    ranked = reached.join(fires, "_node").groupBy("_basket").agg(_ranked("confidence", "_cons").alias("_ranked"))
    out = numbered.join(ranked, "_basket", "left" if keep_empty else "inner")
    out = out.select(*basket_df.columns, F.coalesce(F.array_except("_ranked", items_col), empty).alias(RECS))
    return out if keep_empty else out.where(F.size(RECS) > 0)


def merge_recommendations(segment_recs: DataFrame, general_recs: DataFrame, as_array: bool = False) -> DataFrame:
    """Fill segment recommendations with general ones.

    Inputs are (StockCode, recs), the lists as arrays or as comma-joined text (a side at a time), as the
    result is.  Every product on
    either side is kept; where both have a list, the segment list comes
    first, followed by the general items it lacks, in their order.
    """
    def lists(df: DataFrame):
        text = not isinstance(df.schema[RECS].dataType, T.ArrayType)
        return split_list_dropping_trailing(F.col(RECS)) if text else F.col(RECS)
    seg = segment_recs.select(F.col(STOCK_CODE).alias(KEY), lists(segment_recs).alias(RECS), F.col(RECS).alias("_given"))
    gen = general_recs.select(F.col(STOCK_CODE).alias(KEY), lists(general_recs).alias(RECS2), F.col(RECS).alias("_given2"))
    merged = merge_lists(F.col(RECS), F.col(RECS2))
    if not as_array:
        # A list on one side only stays as it was written.
        one, two = (F.array_join(F.col(c), ",") if isinstance(df.schema[RECS].dataType, T.ArrayType) else F.col(c)
                    for c, df in (("_given", segment_recs), ("_given2", general_recs)))
        merged = F.when(F.col(RECS).isNull(), two).when(F.col(RECS2).isNull(), one).otherwise(F.array_join(merged, ","))
    return seg.join(gen, KEY, "full_outer").select(F.col(KEY).alias(STOCK_CODE), merged.alias(RECS))
