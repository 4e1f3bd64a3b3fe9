"""Column functions: predicates, scaling, distances, list handling."""

import math

import pytest
from pyspark.sql import types as T

from tillroll import functions as tf


def one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_digits_only(spark):
    vals = ["123", "", None, "C536", "12a", "123\n", "٣٤", "007"]
    got = one(spark, tf.digits_only("s"), [(v,) for v in vals], "s string")
    assert got == [True, False, False, False, False, False, False, True]


def test_has_digit_unicode(spark):
    vals = ["POST", "Brand#1", "", None, "x٣", "DOT"]
    got = one(spark, tf.has_digit("s"), [(v,) for v in vals], "s string")
    assert got == [False, True, False, False, True, False]


def test_non_blank(spark):
    got = one(spark, tf.non_blank("s"), [("a",), ("",), (None,)], "s string")
    assert got == [True, False, False]


def test_min_max_scale(spark):
    rows = [(5.0, 0.0, 10.0), (0.0, 0.0, 10.0), (3.0, 3.0, 3.0), (None, 0.0, 1.0)]
    schema = "x double, lo double, hi double"
    got = one(spark, tf.min_max_scale("x", "lo", "hi", 1.0, 100.0), rows, schema)
    assert got[0] == pytest.approx(50.5) and got[1] == 1.0
    assert math.isnan(got[2]) and got[3] is None
    got_min = one(spark, tf.min_max_scale("x", "lo", "hi", 1.0, 100.0, degenerate="min"), rows, schema)
    assert got_min[2] == 1.0


def test_euclidean_truncates_to_shorter(spark):
    schema = "a array<double>, b array<double>"
    rows = [([0.0, 0.0], [3.0, 4.0]), ([1.0, 2.0, 9.0], [1.0, 2.0]), ([], [1.0])]
    got = one(spark, tf.euclidean_distance("a", "b"), rows, schema)
    assert got == [5.0, 0.0, 0.0]


def test_mean_squared(spark):
    schema = "a array<double>, b array<double>"
    rows = [([0.0, 0.0], [3.0, 4.0]), ([1.0, 1.0, 1.0], [2.0]), ([], [1.0])]
    msd = one(spark, tf.mean_squared_difference("a", "b"), rows, schema)
    assert msd[0] == 12.5 and msd[1] == pytest.approx(1.0 / 3.0) and math.isnan(msd[2])
    sim = one(spark, tf.mean_squared_similarity("a", "b"), rows, schema)
    assert sim[0] == pytest.approx(1.0 / 13.5)


def test_jaccard(spark):
    schema = "a array<string>, b array<string>"
    rows = [(["x", "y"], ["y", "z"]), (["x", "x"], ["x"]), ([], ["x"]), (None, ["x"]), (["a"], ["b"])]
    got = one(spark, tf.jaccard_similarity("a", "b"), rows, schema)
    assert got == [pytest.approx(1 / 3), 1.0, 0.0, 0.0, 0.0]
    dist = one(spark, tf.jaccard_distance("a", "b"), rows, schema)
    assert dist[0] == pytest.approx(2 / 3)


def test_segment_label_and_nan(spark):
    rows = [(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (float("nan"), float("nan"))]
    got = one(spark, tf.segment_label("s", "t"), rows, "s double, t double")
    assert got == ["1", "2", "2", "2"]


def test_keep_old_segment(spark):
    got = one(spark, tf.keep_old_segment("o", "n"), [("null", "1"), ("2", None), (None, None)], "o string, n string")
    assert got == ["1", "2", None]


def test_merge_lists_order_and_nulls(spark):
    schema = T.StructType([T.StructField("a", T.ArrayType(T.StringType())),
                           T.StructField("b", T.ArrayType(T.StringType()))])
    rows = [(["a", "b"], ["c", "a", "d", "c"]), (None, ["x"]), (["y"], None), (["p"], [])]
    got = one(spark, tf.merge_lists("a", "b"), rows, schema)
    assert got == [["a", "b", "c", "d"], ["x"], ["y"], ["p"]]


def test_split_variants(spark):
    rows = [("a,b,,",), ("",), (",,",), ("a,,b",)]
    keep = one(spark, tf.split_list("s"), rows, "s string")
    assert keep == [["a", "b", "", ""], [""], ["", "", ""], ["a", "", "b"]]
    drop = one(spark, tf.split_list_dropping_trailing("s"), rows, "s string")
    assert drop == [["a", "b"], [""], [], ["a", "", "b"]]


def test_vector_distance(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([0.0, 0.0]), Vectors.sparse(2, [1], [2.0]))], ["u", "v"])
    assert df.select(tf.vector_euclidean_distance("u", "v")).first()[0] == 2.0


def test_split_with_regex_special_separator(spark):
    rows = [("a|b||",), ("a||b",), ("|",)]
    got = one(spark, tf.split_list_dropping_trailing("s", "|"), rows, "s string")
    assert got == [["a", "b"], ["a", "", "b"], []]


@pytest.mark.parametrize("sep", ["|", ".", "||", ",", "$", "\\", "\\E", "a"])
def test_separators_are_literal(spark, sep):
    texts = [sep.join(x) for x in (["p", "q", ""], ["", "p"], ["", ""], ["p"])] + ["", "p" + sep + "q\n", "p" + sep + "\n"]
    got = one(spark, tf.split_list("s", sep), [(t,) for t in texts], "s string")
    assert got == [t.split(sep) for t in texts]
    got = one(spark, tf.split_list_dropping_trailing("s", sep), [(t,) for t in texts], "s string")

    def dropped(t):
        parts = t.split(sep)
        while len(parts) > 1 and parts[-1] == "":
            parts.pop()
        return parts if parts != [""] or t == "" else []
    assert got == [dropped(t) for t in texts]


def test_vector_distance_needs_equal_sizes(spark):
    from pyspark.ml.linalg import Vectors

    from tillroll.functions.vectors import vector_euclidean_distance
    df = spark.createDataFrame([(Vectors.dense(1.0, 2.0), Vectors.sparse(2, [1], [6.0]))], ["a", "b"])
    assert df.select(vector_euclidean_distance("a", "b")).first()[0] == math.sqrt(17)
    bad = spark.createDataFrame([(Vectors.dense(1.0, 2.0, 9.0), Vectors.dense(1.0, 2.0))], ["a", "b"])
    with pytest.raises(Exception, match="different sizes: 3 and 2"):
        bad.select(vector_euclidean_distance("a", "b")).collect()
