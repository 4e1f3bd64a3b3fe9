"""Comparing result sets and vectors.

``jaccard_compare`` joins two keyed lists and scores each common key.
``centroid_distances`` measures each vector against its label's centroid
with the distance functions (Euclidean, mean squared difference and
similarity): a linear job (one aggregate, one join against a bounded
table) rather than all pairs within a label.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import (
    euclidean_distance, jaccard_similarity, mean_squared_difference, mean_squared_similarity,
    split_list,
)
from tillroll.functions.vectors import vector_euclidean_distance
from tillroll.plans.strategies import DEFAULT_BROADCAST_BYTES, broadcast_if_bounded, cut_lineage
from tillroll.schema import CMP_KEY, CMP_VAL1, CMP_VAL2, JACCARD_DIS, JACCARD_SIM


def jaccard_compare(first: DataFrame, second: DataFrame, key: str = CMP_KEY,
                    val1: str = CMP_VAL1, val2: str = CMP_VAL2, split: bool = True) -> DataFrame:
    """(KEY, jaccard_similarity, jaccard_distance) for keys present on both sides.

    With ``split`` the value columns are comma-joined strings (split keeping
    trailing empty items); otherwise they are arrays already.
    """
    a = first.select(F.col(key), (split_list(val1) if split else F.col(val1)).alias(CMP_VAL1))
    b = second.select(F.col(key), (split_list(val2) if split else F.col(val2)).alias(CMP_VAL2))
    sim = jaccard_similarity(F.col(CMP_VAL1), F.col(CMP_VAL2))
    return (a.join(b, key, "inner")
            .select(F.col(key), sim.alias(JACCARD_SIM))
            .withColumn(JACCARD_DIS, F.lit(1.0) - F.col(JACCARD_SIM)))


def jaccard_summary(compared: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Average distance and average similarity over all keys.

    One row, or one row per value of the ``by`` columns.
    """
    aggs = [F.avg(JACCARD_DIS).alias(JACCARD_DIS), F.avg(JACCARD_SIM).alias(JACCARD_SIM)]
    return compared.groupBy(*by).agg(*aggs) if by else compared.agg(*aggs)


def vector_centroid_distances(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                              label_col: str = "label", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Per vector: Euclidean distance to its label's centroid, both as ML vectors.

    A vector whose size is not its centroid's raises an error.
    """
    cents = cut_lineage(vectors.sparkSession, label_centroids(vectors, vec_col, label_col), "centroids")
    cents, _ = broadcast_if_bounded(cents, max_broadcast_bytes)
    joined = vectors.join(cents, label_col)
    distance = vector_euclidean_distance(array_to_vector(F.col(vec_col)), array_to_vector(F.col("centroid")))
    return joined.select(id_col, label_col, distance.alias("distance"))


def label_centroids(vectors: DataFrame, vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(label, centroid array<double>): element-wise mean per label.

    ``Summarizer.mean`` is a JVM aggregate with a fixed-size buffer per
    label, merged map-side, so a label holding most of the rows costs no
    more than any other.
    """
    as_vec = vectors.select(F.col(label_col), array_to_vector(F.col(vec_col)).alias("_v"))
    means = as_vec.groupBy(label_col).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return means.select(F.col(label_col), vector_to_array(F.col("_m"), "float64").alias("centroid"))


def centroid_distances(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                       label_col: str = "label", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Per vector: Euclidean distance, mean squared difference and mean
    squared similarity to its label's centroid.

    The centroid table has one row per label; it is written once and
    broadcast after a check of its bytes (labels times width), otherwise
    joined by shuffle.
    """
    cents = cut_lineage(vectors.sparkSession, label_centroids(vectors, vec_col, label_col), "centroids")
    cents, _ = broadcast_if_bounded(cents, max_broadcast_bytes)
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    joined = vectors.join(cents, label_col)
    return joined.select(
        F.col(id_col), F.col(label_col),
        euclidean_distance(v, F.col("centroid")).alias("distance"),
        mean_squared_difference(v, F.col("centroid")).alias("msd"),
        mean_squared_similarity(v, F.col("centroid")).alias("ms_similarity"),
    )
