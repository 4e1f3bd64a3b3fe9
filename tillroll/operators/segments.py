"""Customer features and two-way segmentation.

Plan shape: purchases are one hash aggregate on the purchase key (partial
aggregation map-side; the single distinct count is planned without an extra
shuffle), customers a second one on CustomerID.  Global minima, maxima and
the average are one-row aggregates; they meet the per-customer rows through
a broadcast of that single row (size bound: exactly one row), never through
an unpartitioned window.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import (
    euclidean_distance, keep_old_segment, min_max_scale, segment_label,
)
from tillroll.operators.clean import flagged_lines, initial_customers
from tillroll.plans.strategies import cut_lineage
from tillroll.schema import (
    AVG_PRICE_PER_PURCHASE, AVG_PRODUCTS_PER_PURCHASE, AVG_QUANTITY_PER_PURCHASE,
    BASKET_KEY, CUSTOMER_FEATURES, CUSTOMER_ID, ITEMS, NO_OF_CUSTOMERS, PRICE_PER_PURCHASE,
    PRODUCTS_PER_PURCHASE, PURCHASES_PER_CUSTOMER, QUANTITY, QUANTITY_PER_PURCHASE,
    SCALED_PREFIX, SEGMENT, SEGMENT_OLD, SIMILARITY, STOCK_CODE, UNIT_PRICE,
)

# Features are rescaled to the range 1 ... 100.
RANGE_MIN = 1.0
RANGE_MAX = 100.0


def purchase_features(tx: DataFrame) -> DataFrame:
    """Per purchase: total price, distinct products, total quantity (A1)."""
    return tx.groupBy(*BASKET_KEY).agg(
        F.sum(F.col(UNIT_PRICE) * F.col(QUANTITY)).alias(PRICE_PER_PURCHASE),
        F.countDistinct(STOCK_CODE).alias(PRODUCTS_PER_PURCHASE),
        F.sum(QUANTITY).cast("long").alias(QUANTITY_PER_PURCHASE),
    )


def purchase_table(tx: DataFrame, item_col: str = STOCK_CODE) -> DataFrame:
    """Per purchase: its sorted item set and the three purchase features.

    One aggregation serves both segmentation and basket mining; the number
    of distinct products is the size of the item set.  Partitioned by the
    purchase key, the result feeds every later per-purchase step.
    """
    agg = tx.groupBy(*BASKET_KEY).agg(
        F.array_sort(F.collect_set(item_col)).alias(ITEMS),
        F.sum(F.col(UNIT_PRICE) * F.col(QUANTITY)).alias(PRICE_PER_PURCHASE),
        F.sum(QUANTITY).cast("long").alias(QUANTITY_PER_PURCHASE),
    )
    return agg.select(*BASKET_KEY, ITEMS, PRICE_PER_PURCHASE,
                      F.size(ITEMS).cast("long").alias(PRODUCTS_PER_PURCHASE), QUANTITY_PER_PURCHASE)


def raw_purchase_table(raw: DataFrame, item_col: str = STOCK_CODE) -> DataFrame:
    """``purchase_table`` of the cleaned lines and the initial load's customers, from one scan of the raw lines.

    Conditional aggregates: only clean lines add to a purchase's items and features; ``_clean`` and
    ``_loadable`` tell whether it has such lines.  ``purchases_of`` and ``customers_of`` split a written copy.
    """
    clean = lambda c: F.when(F.col("_clean"), c)
    agg = flagged_lines(raw).groupBy(*BASKET_KEY).agg(
        F.array_sort(F.collect_set(clean(F.col(item_col)))).alias(ITEMS),
        F.sum(clean(F.col(UNIT_PRICE) * F.col(QUANTITY))).alias(PRICE_PER_PURCHASE),
        F.sum(clean(F.col(QUANTITY))).cast("long").alias(QUANTITY_PER_PURCHASE),
        F.max("_clean").alias("_clean"), F.max("_loadable").alias("_loadable"))
    return agg.select(*BASKET_KEY, ITEMS, PRICE_PER_PURCHASE,
                      F.size(ITEMS).cast("long").alias(PRODUCTS_PER_PURCHASE), QUANTITY_PER_PURCHASE, "_clean", "_loadable")


def purchases_of(table: DataFrame) -> DataFrame:
    """The purchases with clean lines of a ``raw_purchase_table``."""
    return table.where("_clean").drop("_clean", "_loadable")


def customers_of(table: DataFrame) -> DataFrame:
    """The initial load's customers of a ``raw_purchase_table``."""
    return initial_customers(table.where("_loadable"))


def customer_aggregates(tx: DataFrame, purchases: DataFrame | None = None) -> DataFrame:
    """Per customer: number of purchases and the three purchase averages (A2).

    ``purchases`` (from :func:`purchase_features` or :func:`purchase_table`)
    skips the per-purchase aggregation.
    """
    pp = purchases if purchases is not None else purchase_features(tx)
    return pp.groupBy(CUSTOMER_ID).agg(
        F.count(F.lit(1)).alias(PURCHASES_PER_CUSTOMER),
        F.avg(PRICE_PER_PURCHASE).alias(AVG_PRICE_PER_PURCHASE),
        F.avg(PRODUCTS_PER_PURCHASE).alias(AVG_PRODUCTS_PER_PURCHASE),
        F.avg(QUANTITY_PER_PURCHASE).alias(AVG_QUANTITY_PER_PURCHASE),
    )


def customer_features(tx: DataFrame, range_min: float = RANGE_MIN, range_max: float = RANGE_MAX,
                      degenerate: str = "nan", purchases: DataFrame | None = None) -> DataFrame:
    """Per-customer features with their min-max scaled forms.

    Columns: CustomerID, then for each feature ``scaled_<name>`` and
    ``<name>``.  Where all customers share a value the scale is degenerate;
    see :func:`min_max_scale`.
    """
    return _scaled(customer_aggregates(tx, purchases), range_min, range_max, degenerate)


def _scaled(per_customer: DataFrame, range_min: float, range_max: float, degenerate: str) -> DataFrame:
    bounds = per_customer.agg(*(
        [F.min(c).alias(f"_min_{c}") for c in CUSTOMER_FEATURES]
        + [F.max(c).alias(f"_max_{c}") for c in CUSTOMER_FEATURES]
    ))
    joined = per_customer.crossJoin(F.broadcast(bounds))
    cols = [F.col(CUSTOMER_ID)]
    for c in CUSTOMER_FEATURES:
        cols.append(min_max_scale(F.col(c).cast("double"), F.col(f"_min_{c}").cast("double"),
                                  F.col(f"_max_{c}").cast("double"), range_min, range_max,
                                  degenerate).alias(SCALED_PREFIX + c))
        cols.append(F.col(c))
    return joined.select(*cols)


def customer_similarity(features: DataFrame, origin: float = RANGE_MIN) -> DataFrame:
    """Distance of each customer's scaled feature vector from (origin, ...) (F2).

    Named "similarity" as in the original data model although it is a
    distance: larger means a heavier buyer.
    """
    vec = F.array(*[F.col(SCALED_PREFIX + c) for c in CUSTOMER_FEATURES])
    ref = F.array(*[F.lit(float(origin)) for _ in CUSTOMER_FEATURES])
    return features.select(CUSTOMER_ID, euclidean_distance(vec, ref).alias(SIMILARITY))


def customer_segments(similarity: DataFrame) -> DataFrame:
    """Segment "1" for customers below the average similarity, else "2" (A4, J7, F8)."""
    avg = similarity.agg(F.avg(SIMILARITY).alias("_avg_similarity"))
    return (similarity.crossJoin(F.broadcast(avg))
            .select(CUSTOMER_ID, segment_label(F.col(SIMILARITY), F.col("_avg_similarity")).alias(SEGMENT)))


def similarity_summary(similarity: DataFrame) -> DataFrame:
    """One row: max, min and average similarity (A4)."""
    return similarity.agg(F.max(SIMILARITY).alias("max_similarity"),
                          F.min(SIMILARITY).alias("min_similarity"),
                          F.avg(SIMILARITY).alias("avg_similarity"))


def segment_stats(segments: DataFrame) -> DataFrame:
    """Customers per segment (A5)."""
    return segments.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias(NO_OF_CUSTOMERS))


def segment_customers(tx: DataFrame, range_min: float = RANGE_MIN, range_max: float = RANGE_MAX,
                      degenerate: str = "nan", purchases: DataFrame | None = None) -> DataFrame:
    """Transactions (or their purchase table) to (CustomerID, segment) in one plan (C4 core)."""
    features = customer_features(tx, range_min, range_max, degenerate, purchases)
    return customer_segments(customer_similarity(features, range_min))


class Segmentation(NamedTuple):
    """The outputs of one segmentation run."""
    features: DataFrame
    similarity: DataFrame
    stats: DataFrame
    segments: DataFrame
    customers: DataFrame | None


def segmentation_job(tx: DataFrame, customers: DataFrame | None = None, range_min: float = RANGE_MIN,
                     range_max: float = RANGE_MAX, degenerate: str = "nan",
                     purchases: DataFrame | None = None) -> Segmentation:
    """Features, similarity, segment sizes, segments and updated customers from one pass (C4).

    The lines are aggregated once.  What they give per customer, one row each,
    is written to the shared folder, and all five outputs read that table, so
    none repeats the pass.  ``customers`` is the earlier (CustomerID, segment)
    table; without it there are no updated customers.
    """
    spark = tx.sparkSession
    per_customer = cut_lineage(spark, customer_aggregates(tx, purchases), "customer-aggregates")
    features = _scaled(per_customer, range_min, range_max, degenerate)
    similarity = customer_similarity(features, range_min)
    segments = customer_segments(similarity)
    updated = update_segments(customers, segments) if customers is not None else None
    return Segmentation(features, similarity, segment_stats(segments), segments, updated)


def update_segments(customers: DataFrame, segments: DataFrame) -> DataFrame:
    """New segment where one was computed, the previous one otherwise.

    ``customers`` has (CustomerID, segment); every customer is kept, a
    segmented customer missing from ``customers`` is not added.
    """
    old = customers.select(F.col(CUSTOMER_ID), F.col(SEGMENT).alias(SEGMENT_OLD))
    return (old.join(segments, CUSTOMER_ID, "left")
            .select(CUSTOMER_ID, keep_old_segment(F.col(SEGMENT_OLD), F.col(SEGMENT)).alias(SEGMENT))
            .distinct())
