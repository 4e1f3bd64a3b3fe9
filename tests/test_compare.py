"""Comparison jobs (C6, J5, A9, F2-F7 on vectors)."""

import numpy as np
import pytest

from tillroll import operators as ops
from tillroll.sources.fixtures import table

from conftest import SF_SMALL


def test_jaccard_compare_and_summary(spark):
    a = spark.createDataFrame([("k1", "a,b"), ("k2", "a"), ("k3", "x")], "KEY string, VAL1 string")
    b = spark.createDataFrame([("k1", "b,c"), ("k2", "a"), ("k4", "y")], "KEY string, VAL2 string")
    cmp = {r["KEY"]: (r["jaccard_similarity"], r["jaccard_distance"]) for r in ops.jaccard_compare(a, b).collect()}
    assert cmp == {"k1": (pytest.approx(1 / 3), pytest.approx(2 / 3)), "k2": (1.0, 0.0)}
    s = ops.jaccard_summary(ops.jaccard_compare(a, b)).first()
    assert s["jaccard_similarity"] == pytest.approx((1 / 3 + 1) / 2)
    assert s["jaccard_distance"] == pytest.approx((2 / 3) / 2)


def test_centroid_distances_match_numpy(spark):
    emb = table(spark, SF_SMALL, "embeddings")
    rows = emb.collect()
    vecs = {r["vec_id"]: (r["label"], np.array(r["embedding"], dtype=np.float64)) for r in rows}
    cents = {}
    for lab in {v[0] for v in vecs.values()}:
        cents[lab] = np.mean([v for l, v in vecs.values() if l == lab], axis=0)
    got = {r["vec_id"]: r for r in ops.centroid_distances(emb).collect()}
    assert set(got) == set(vecs)
    for vid, (lab, v) in vecs.items():
        d = v - cents[lab]
        assert got[vid]["distance"] == pytest.approx(float(np.sqrt(np.sum(d * d))), rel=1e-9)
        assert got[vid]["msd"] == pytest.approx(float(np.sum(d * d) / len(v)), rel=1e-9)
        assert got[vid]["ms_similarity"] == pytest.approx(1.0 / (float(np.sum(d * d) / len(v)) + 1.0), rel=1e-9)


def test_centroid_shuffle_path_equals_broadcast(spark):
    emb = table(spark, SF_SMALL, "embeddings")
    a = {r["vec_id"]: r["distance"] for r in ops.centroid_distances(emb).collect()}
    b = {r["vec_id"]: r["distance"] for r in ops.centroid_distances(emb, max_broadcast_bytes=0).collect()}
    assert a == b


def test_wide_tables_are_not_broadcast(spark):
    """The bound is on bytes: few rows, but wide ones, take the shuffle join."""
    from pyspark.sql import functions as F

    from tillroll.plans.strategies import broadcast_if_bounded
    wide = spark.range(200).select("id", F.array_repeat(F.lit(1.5), 4096).alias("v"))
    texts = spark.range(200).select("id", F.repeat(F.lit("x"), 40_000).alias("t"))
    nested = spark.range(200).select(F.array(F.struct(F.repeat(F.lit("x"), 40_000).alias("t"))).alias("a"))
    for df in (wide, texts, nested):
        assert not broadcast_if_bounded(df, 1 << 20)[1]
        assert broadcast_if_bounded(df, 64 << 20)[1]
    assert broadcast_if_bounded(spark.range(10), 1 << 20)[1] and not broadcast_if_bounded(spark.range(10**6), 1 << 20)[1]


def test_centroid_distances_leave_nothing_cached(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    ops.centroid_distances(table(spark, SF_SMALL, "embeddings")).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
