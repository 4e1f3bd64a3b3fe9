"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each reads the whole test tables through the fixture views.  Parameters
are the defaults of the original jobs (support 0.01, confidence 0.2, scale
1 ... 100), except the brand-level recommendation queries (see the fixed
values below).  Array results are emitted as comma-joined sorted strings
and order-dependent floating sums rounded to 6 places so they compare with
the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import operators as ops
from tillroll.plans.pipeline import GENERAL_LABEL, SEGMENT_LABELS, pipeline_recommendations
from tillroll.plans.strategies import cut_lineage
from tillroll.schema import (
    AVG_PRICE_PER_PURCHASE, BASKET_KEY, CLEAN_SCHEMA, CMP_KEY, CMP_VAL1, CMP_VAL2, CUSTOMER_FEATURES, CUSTOMER_ID,
    INVOICE_DATE, ITEMS, JACCARD_DIS, JACCARD_SIM, NO_OF_CUSTOMERS, PRICE_PER_PURCHASE, RAW_COLUMNS, RECS, SCALED_PREFIX, SEGMENT,
    SIMILARITY, STOCK_CODE,
)
from tillroll.session import apply_job_conf, scratch_path
from tillroll.sources.delimited import (
    read_delimited, read_delimited_with_schema, read_partitioned_recommendations, replace_table, write_delimited,
    write_partitioned_recommendations,
)
from tillroll.sources.fixtures import raw_transactions, table, transactions

# Thresholds.  Item-type rules use the original jobs' defaults
# (support 0.01, confidence 0.2).  Brand rules use 0.02 / 0.15: every basket
# holds about 4 of 25 brands, so brand co-purchase confidence centres near
# 0.16 and the 0.2 default leaves no brand rule at all from sf0.01 upwards.
SUPPORT = 0.01
CONFIDENCE = 0.2
BRAND_SUPPORT = 0.02
BRAND_CONFIDENCE = 0.15
# Itemset and rule checks: between the smallest and the largest values of
# three-item sets and of rules with one and two items, so both thresholds
# keep some and reject some, at every fixture size.
TYPE_SUPPORT = 0.117
TYPE_CONFIDENCE = 0.487
# Segment runs, on clean and on raw lines: customers of segment "1" buy
# smaller baskets, and these values keep a part of its pairs.
SEGMENT_SUPPORT, SEGMENT_CONFIDENCE = 0.017, 0.13
RAW_SUPPORT, RAW_CONFIDENCE = 0.014, 0.117


def _r6(c):
    return F.round(c, 6)


def _key_text(df: DataFrame) -> DataFrame:
    """InvoiceDate as text so keys compare across engines."""
    return df.withColumn(INVOICE_DATE, F.col(INVOICE_DATE).cast("string"))


def _tx(spark, sf_dir, item="p_brand"):
    apply_job_conf(spark)
    return transactions(spark, sf_dir, item)


def _raw(spark, sf_dir):
    apply_job_conf(spark)
    return raw_transactions(spark, sf_dir)


# ------------------------------------------------------------ cleaning/load

def q_clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_transactions(_raw(spark, sf_dir))


def q_load_products(spark, sf_dir):
    return ops.load_products(_raw(spark, sf_dir))


def q_load_customers(spark, sf_dir):
    return ops.load_customers(_raw(spark, sf_dir))


def q_delimited_round_trip(spark, sf_dir):
    """Clean lines written as tab-separated text and read back under the schema."""
    path = scratch_path(spark, "clean-tsv")
    write_delimited(ops.clean_transactions(_raw(spark, sf_dir)), path)
    return read_delimited_with_schema(spark, path, CLEAN_SCHEMA)


def q_read_delimited_strings(spark, sf_dir):
    """Clean lines written with a header and read back with every column as text."""
    path = scratch_path(spark, "clean-csv")
    write_delimited(_key_text(ops.clean_transactions(_raw(spark, sf_dir))), path, sep="|", header=True)
    return read_delimited(spark, path, RAW_COLUMNS, sep="|", header=True)


def q_single_file(spark, sf_dir):
    """Segment sizes written as one file and read back, with the number of files."""
    path = scratch_path(spark, "stats-single")
    write_delimited(ops.segment_stats(ops.segment_customers(_tx(spark, sf_dir))), path, single_file=True)
    schema = T.StructType([T.StructField(SEGMENT, T.StringType()), T.StructField(NO_OF_CUSTOMERS, T.LongType())])
    back = read_delimited_with_schema(spark, path, schema)
    return back.withColumn("n_files", F.lit(len(back.inputFiles())).cast("long"))


def q_segment_target(spark, sf_dir):
    """Recommendations per segment, written run by run into one table by segment.

    The general run's rows are written twice, so the second write must replace
    its own partition and leave the others.
    """
    res = ops.recommendations_by_segment(_tx(spark, sf_dir), SEGMENT_LABELS, general=True,
                                         min_support=SEGMENT_SUPPORT, min_confidence=SEGMENT_CONFIDENCE)
    path = scratch_path(spark, "recs-by-segment")
    for label in (GENERAL_LABEL, *SEGMENT_LABELS, GENERAL_LABEL):
        write_partitioned_recommendations(res[label].withColumn(SEGMENT, F.lit(label)), path)
    return read_partitioned_recommendations(spark, path)


def q_replace_own_input(spark, sf_dir):
    """The customer table, replaced by its own update."""
    raw = _raw(spark, sf_dir)
    path = scratch_path(spark, "customers-tsv")
    write_delimited(ops.load_customers(raw), path)
    schema = T.StructType([T.StructField(CUSTOMER_ID, T.StringType()), T.StructField(SEGMENT, T.StringType())])
    stored = read_delimited_with_schema(spark, path, schema)
    updated = ops.update_segments(stored, ops.segment_customers(ops.clean_transactions(raw)))
    return replace_table(spark, updated, path, scratch_path(spark, "customers-staging"), schema)


# ------------------------------------------------------------ segmentation

def q_purchase_features(spark, sf_dir):
    pf = ops.purchase_features(_tx(spark, sf_dir))
    return _key_text(pf).withColumn(PRICE_PER_PURCHASE, _r6(F.col(PRICE_PER_PURCHASE)))


def q_customer_features(spark, sf_dir):
    cf = ops.customer_features(_tx(spark, sf_dir))
    # Averages of integer counts are exact in any summation order; only the
    # price average (and its scaled form) depends on the order of a float sum.
    cols = [F.col("CustomerID")]
    for c in CUSTOMER_FEATURES:
        exact = c != AVG_PRICE_PER_PURCHASE
        cols.append(F.col(SCALED_PREFIX + c) if exact else _r6(F.col(SCALED_PREFIX + c)).alias(SCALED_PREFIX + c))
        cols.append(F.col(c) if exact else _r6(F.col(c)).alias(c))
    return cf.select(*cols)


def q_customer_similarity(spark, sf_dir):
    sim = ops.customer_similarity(ops.customer_features(_tx(spark, sf_dir)))
    return sim.select("CustomerID", _r6(F.col(SIMILARITY)).alias(SIMILARITY))


def q_similarity_summary(spark, sf_dir):
    s = ops.similarity_summary(ops.customer_similarity(ops.customer_features(_tx(spark, sf_dir))))
    return s.select(*[_r6(F.col(c)).alias(c) for c in s.columns])


def q_customer_segments(spark, sf_dir):
    return ops.segment_customers(_tx(spark, sf_dir))


def q_segment_stats(spark, sf_dir):
    return ops.segment_stats(ops.segment_customers(_tx(spark, sf_dir)))


def q_update_segments(spark, sf_dir):
    """Initial customers of the raw load, updated with segments of the cleaned lines."""
    raw = _raw(spark, sf_dir)
    return ops.update_segments(ops.load_customers(raw), ops.segment_customers(ops.clean_transactions(raw)))


def q_segmentation_job(spark, sf_dir):
    """The five outputs of one segmentation run, told apart by ``output``."""
    raw = _raw(spark, sf_dir)
    run = ops.segmentation_job(ops.clean_transactions(raw), ops.load_customers(raw))
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def rows(df, output, key, num, txt):
        return df.select(F.lit(output).alias("output"), F.col(key).alias("key"), num.alias("num"), txt.alias("txt"))
    # Every feature column, one row each, named in ``txt``.
    names = [p + c for c in CUSTOMER_FEATURES for p in (SCALED_PREFIX, "")]
    features = run.features.select(CUSTOMER_ID, F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), _r6(F.col(c).cast("double")).alias("value")) for c in names])).alias("f"))
    return (rows(features, "features", CUSTOMER_ID, F.col("f.value"), F.col("f.name"))
            .unionByName(rows(run.similarity, "similarity", CUSTOMER_ID, _r6(F.col(SIMILARITY)), text))
            .unionByName(rows(run.stats, "stats", SEGMENT, F.col(NO_OF_CUSTOMERS).cast("double"), text))
            .unionByName(rows(run.segments, "segments", CUSTOMER_ID, none, F.col(SEGMENT)))
            .unionByName(rows(run.customers, "customers", CUSTOMER_ID, none, F.col(SEGMENT))))


def q_segment_transactions(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    return _key_text(ops.segment_transactions(tx, ops.segment_customers(tx), "1"))


# ------------------------------------------------------------ baskets/rules

def _joined(c):
    return F.array_join(F.col(c), ",")


def q_baskets(spark, sf_dir):
    b = ops.baskets(_tx(spark, sf_dir))
    return _key_text(b).withColumn(ITEMS, _joined(ITEMS))


def _type_rules(spark, sf_dir):
    return ops.mine_rules(ops.baskets(_tx(spark, sf_dir, "p_type")), TYPE_SUPPORT, TYPE_CONFIDENCE)


def q_frequent_itemsets(spark, sf_dir):
    fi = _type_rules(spark, sf_dir).itemsets
    return fi.select(_joined("items").alias("items"), "freq")


def q_association_rules(spark, sf_dir):
    r = _type_rules(spark, sf_dir).rules
    return r.select(_joined("antecedent").alias("antecedent"), _joined("consequent").alias("consequent"),
                    "confidence", "lift", "support")


def q_frequently_bought(spark, sf_dir):
    return ops.general_recommendations(_tx(spark, sf_dir), BRAND_SUPPORT, BRAND_CONFIDENCE)


def _per_segment(tx, fill: bool):
    res = ops.recommendations_by_segment(tx, SEGMENT_LABELS, general=fill,
                                         min_support=SEGMENT_SUPPORT, min_confidence=SEGMENT_CONFIDENCE)
    out = None
    for s in SEGMENT_LABELS:
        part = res[s].select(F.lit(s).alias(SEGMENT), STOCK_CODE, RECS)
        out = part if out is None else out.unionByName(part)
    return out


def q_frequently_bought_segment(spark, sf_dir):
    return _per_segment(_tx(spark, sf_dir), fill=False)


def q_merge_recommendations(spark, sf_dir):
    return _per_segment(_tx(spark, sf_dir), fill=True)


def q_recommend_for_baskets(spark, sf_dir):
    # Baskets feed both the mining and the rule application: written once.
    b = cut_lineage(spark, ops.baskets(_tx(spark, sf_dir, "p_type")), "baskets")
    rules = ops.mine_rules(b, SUPPORT, CONFIDENCE, with_itemsets=False, stored=True).rules
    out = ops.recommend(b, rules)
    return _key_text(out).select(*BASKET_KEY, _joined(ITEMS).alias(ITEMS), _joined(RECS).alias(RECS))


# ------------------------------------------------------------ comparison

def _general_vs_segments(spark, sf_dir):
    res = ops.recommendations_by_segment(_tx(spark, sf_dir), SEGMENT_LABELS, general=True,
                                         min_support=SEGMENT_SUPPORT, min_confidence=SEGMENT_CONFIDENCE)
    g = res["gen"].select(F.col(STOCK_CODE).alias(CMP_KEY), F.col(RECS).alias(CMP_VAL1))
    out = None
    for s in SEGMENT_LABELS:
        seg = res[s].select(F.col(STOCK_CODE).alias(CMP_KEY), F.col(RECS).alias(CMP_VAL2))
        part = ops.jaccard_compare(g, seg).withColumn(SEGMENT, F.lit(s))
        out = part if out is None else out.unionByName(part)
    return out


def q_jaccard_compare(spark, sf_dir):
    c = _general_vs_segments(spark, sf_dir)
    return c.select(SEGMENT, CMP_KEY, _r6(F.col(JACCARD_SIM)).alias(JACCARD_SIM),
                    _r6(F.col(JACCARD_DIS)).alias(JACCARD_DIS))


def q_jaccard_summary(spark, sf_dir):
    c = _general_vs_segments(spark, sf_dir)
    s = ops.jaccard_summary(c, by=[SEGMENT])
    return s.select(SEGMENT, _r6(F.col(JACCARD_DIS)).alias(JACCARD_DIS), _r6(F.col(JACCARD_SIM)).alias(JACCARD_SIM))


def _centroid(spark, sf_dir):
    apply_job_conf(spark)
    return ops.centroid_distances(table(spark, sf_dir, "embeddings"))


def q_embedding_euclidean(spark, sf_dir):
    d = _centroid(spark, sf_dir)
    return d.select("vec_id", "label", _r6(F.col("distance")).alias("distance"))


def q_embedding_vector_euclidean(spark, sf_dir):
    apply_job_conf(spark)
    d = ops.vector_centroid_distances(table(spark, sf_dir, "embeddings"))
    return d.select("vec_id", "label", _r6(F.col("distance")).alias("distance"))


def q_embedding_msd(spark, sf_dir):
    d = _centroid(spark, sf_dir)
    return d.select("vec_id", "label", _r6(F.col("msd")).alias("msd"),
                    _r6(F.col("ms_similarity")).alias("ms_similarity"))


# ------------------------------------------------------------ pipeline

def q_pipeline_recommendations(spark, sf_dir):
    return pipeline_recommendations(_raw(spark, sf_dir), min_support=RAW_SUPPORT,
                                    min_confidence=RAW_CONFIDENCE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_transactions": q_clean_transactions,
    "load_products": q_load_products,
    "load_customers": q_load_customers,
    "delimited_round_trip": q_delimited_round_trip,
    "read_delimited_strings": q_read_delimited_strings,
    "single_file": q_single_file,
    "segment_target": q_segment_target,
    "replace_own_input": q_replace_own_input,
    "purchase_features": q_purchase_features,
    "customer_features": q_customer_features,
    "customer_similarity": q_customer_similarity,
    "similarity_summary": q_similarity_summary,
    "customer_segments": q_customer_segments,
    "segment_stats": q_segment_stats,
    "update_segments": q_update_segments,
    "segmentation_job": q_segmentation_job,
    "segment_transactions": q_segment_transactions,
    "baskets": q_baskets,
    "frequent_itemsets": q_frequent_itemsets,
    "association_rules": q_association_rules,
    "frequently_bought": q_frequently_bought,
    "frequently_bought_segment": q_frequently_bought_segment,
    "merge_recommendations": q_merge_recommendations,
    "recommend_for_baskets": q_recommend_for_baskets,
    "jaccard_compare": q_jaccard_compare,
    "jaccard_summary": q_jaccard_summary,
    "embedding_euclidean": q_embedding_euclidean,
    "embedding_vector_euclidean": q_embedding_vector_euclidean,
    "embedding_msd": q_embedding_msd,
    "pipeline_recommendations": q_pipeline_recommendations,
}
