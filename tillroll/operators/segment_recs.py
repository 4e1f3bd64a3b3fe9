"""Recommendation jobs over all transactions or one customer segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.baskets import MIN_CONFIDENCE, MIN_SUPPORT, baskets, mine_pair_rules, pair_rules
from tillroll.operators.recommend import frequently_bought, merge_recommendations
from tillroll.operators.segments import purchase_table, segment_customers, update_segments
from tillroll.plans.strategies import cut_lineage
from tillroll.schema import (
    ITEMS, RECS, COUNTRY, CUSTOMER_ID, DESCRIPTION, INVOICE_DATE, INVOICE_NO, QUANTITY, SEGMENT,
    STOCK_CODE, UNIT_PRICE,
)


def segment_transactions(tx: DataFrame, segments: DataFrame, segment: str) -> DataFrame:
    """Distinct transactions of customers in ``segment``.

    The segment filter runs on the customer table before the join.
    """
    seg = segments.filter(F.col(SEGMENT) == F.lit(segment)).select(CUSTOMER_ID, SEGMENT)
    return (tx.join(seg, CUSTOMER_ID)
            .select(INVOICE_NO, STOCK_CODE, DESCRIPTION, QUANTITY, UNIT_PRICE, CUSTOMER_ID,
                    INVOICE_DATE, COUNTRY, SEGMENT)
            .distinct())


def general_recommendations(tx: DataFrame, min_support: float = MIN_SUPPORT,
                            min_confidence: float = MIN_CONFIDENCE,
                            basket_df: DataFrame | None = None) -> DataFrame:
    """(StockCode, recs) mined from all transactions.

    ``basket_df`` reuses baskets already built from ``tx``.
    """
    return frequently_bought(mine_pair_rules(basket_df if basket_df is not None else baskets(tx), min_support, min_confidence))


def segment_baskets(basket_df: DataFrame, segments: DataFrame) -> DataFrame:
    """Baskets tagged with their customer's segment.

    Baskets (not lines) meet the customer table: one shuffle of the much
    smaller basket table on CustomerID; the customer table is shuffled too
    unless it is small enough for the planner to broadcast.
    """
    seg = segments.select(CUSTOMER_ID, SEGMENT)
    return basket_df.join(seg, CUSTOMER_ID)


def segment_recommendations(tx: DataFrame, segments: DataFrame, segment: str,
                            min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
                            fill: DataFrame | None = None,
                            basket_df: DataFrame | None = None) -> DataFrame:
    """(StockCode, recs) mined from one segment's purchases, optionally filled
    with general recommendations (R10, R11).

    Support is relative to the segment's own purchases.  A purchase belongs
    to a segment through its customer, who is part of the purchase key, so
    the segment's baskets are the baskets of its customers; no row
    ``distinct`` is needed because baskets are item sets.
    """
    b = basket_df if basket_df is not None else baskets(tx)
    seg = segments.filter(F.col(SEGMENT) == F.lit(segment)).select(CUSTOMER_ID)
    seg_b = b.join(seg, CUSTOMER_ID, "left_semi")
    rules = mine_pair_rules(seg_b, min_support, min_confidence)
    if fill is None:
        return frequently_bought(rules)
    return merge_recommendations(frequently_bought(rules, as_array=True), fill)


def recommendations_by_segment(tx: DataFrame, labels, segments: DataFrame | None = None,
                               previous: DataFrame | None = None,
                               general: bool = False, fill: DataFrame | None = None,
                               min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
                               general_label: str = "gen", as_array: bool = False,
                               purchases: DataFrame | None = None) -> dict[str, DataFrame]:
    """Recommendations for several segments from one pass over the lines.

    One aggregation builds the purchase table (item set and features per
    purchase), written below ``spark.checkpoint.dir``: the only stored copy
    of the item sets, durable, and read by every step (``purchases`` gives it where it is there already).  Unless ``segments``
    is given, the customers are segmented from it.  With ``previous`` (the
    earlier customer table) the new segments update it first and the updated
    table assigns the purchases to segments; this small table is written too.
    With ``general`` all purchases also give the general recommendations,
    which fill the segment lists unless ``fill`` is given.
    A purchase then counts under its customer's label and the general one, and the pairs of
    all labels are counted in one aggregate (``pair_rules``).
    Returns {label: (StockCode, recs)} plus "segments" (and "customers")
    when computed here; lists are arrays until the end, and with ``as_array`` in the result.  Nothing
    stays cached; ``clear_scratch`` deletes the
    written tables once the results are stored.
    """
    spark = tx.sparkSession
    if purchases is None:
        purchases = cut_lineage(spark, purchase_table(tx), "purchases")
    out: dict[str, DataFrame] = {}
    if segments is None:
        segments = out["segments"] = cut_lineage(spark, segment_customers(tx, purchases=purchases), "segments")
    if previous is not None:
        segments = out["customers"] = cut_lineage(spark, update_segments(previous, segments), "customers")
    members = segments.filter(F.col(SEGMENT).isin(list(labels))).select(CUSTOMER_ID, F.col(SEGMENT).alias("_label"))
    labelled = purchases.select(CUSTOMER_ID, ITEMS).join(members.distinct(), CUSTOMER_ID).select("_label", ITEMS)
    if general:
        labelled = labelled.unionByName(purchases.select(F.lit(general_label).alias("_label"), ITEMS))
    lists = cut_lineage(spark, frequently_bought(pair_rules(labelled, min_support, min_confidence, label_col="_label"),
                                                 as_array=True, label_col="_label"), "recommendations")
    of = lambda label: lists.where(F.col("_label") == F.lit(label)).drop("_label")
    as_text = lambda df: df if as_array else df.select(STOCK_CODE, F.array_join(RECS, ",").alias(RECS))
    if general:
        out[general_label] = as_text(of(general_label))
        if fill is None:
            fill = of(general_label)
    for label in labels:
        out[label] = merge_recommendations(of(label), fill, as_array) if fill is not None else as_text(of(label))
    return out
