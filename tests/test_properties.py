"""Randomised properties of the list functions, checked in one Spark job per property."""

import random

from pyspark.sql import types as T

from tillroll import functions as tf


def py_merge(seg, gen):
    if seg is None:
        return gen
    if gen is None:
        return seg
    out = list(seg)
    for g in gen:
        if g not in out:
            out.append(g)
    return out


def py_jaccard(a, b):
    sa, sb = set(a or []), set(b or [])
    if not sa or not sb:
        return 0.0
    return len(sa & sb) / len(sa | sb)


def random_lists(seed, n=400):
    rnd = random.Random(seed)
    alphabet = [f"i{k}" for k in range(12)]

    def one(distinct):
        if rnd.random() < 0.1:
            return None
        xs = rnd.sample(alphabet, rnd.randint(0, 6)) if distinct else [rnd.choice(alphabet) for _ in range(rnd.randint(0, 6))]
        return xs
    return [(one(True), one(False)) for _ in range(n)]


SCHEMA = T.StructType([T.StructField("a", T.ArrayType(T.StringType())),
                       T.StructField("b", T.ArrayType(T.StringType()))])


def test_merge_matches_sequential_definition(spark):
    cases = random_lists(7)
    got = spark.createDataFrame(cases, SCHEMA).select(tf.merge_lists("a", "b").alias("m"), "a", "b").collect()
    for r in got:
        expected = py_merge(r["a"], r["b"])
        assert r["m"] == expected, (r["a"], r["b"])
        if r["m"] is not None and r["a"] is not None:
            assert r["m"][: len(r["a"])] == r["a"]          # segment order kept
            assert len(set(r["m"])) == len(r["m"])           # no repeats (segment list is distinct)


def test_jaccard_matches_set_definition(spark):
    cases = random_lists(11)
    got = spark.createDataFrame(cases, SCHEMA).select(tf.jaccard_similarity("a", "b").alias("j"), "a", "b").collect()
    for r in got:
        assert abs(r["j"] - py_jaccard(r["a"], r["b"])) < 1e-15
        assert 0.0 <= r["j"] <= 1.0
