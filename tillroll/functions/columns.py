"""Native Column expressions for the scalar rules of the retail jobs.

All of these are JVM-side Catalyst expressions (no Python in the data path).
Scalar ones join whole-stage code generation; the higher-order array
functions (``zip_with``, ``aggregate``, ``transform``) replace per-row
Scala/Python loops and are evaluated by the JVM inside the same stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------- predicates

def non_blank(c) -> Column:
    """Required field: not null and not the empty string."""
    c = _c(c)
    return c.isNotNull() & (c != F.lit(""))


def digits_only(c) -> Column:
    """True when the value is non-empty and made of ASCII digits 0-9 only.

    Null gives False (not null), so the predicate can be combined freely.
    ``\\A``/``\\z`` anchor the whole value; ``^...$`` would also accept a
    trailing newline.
    """
    return F.coalesce(_c(c).rlike(r"\A[0-9]+\z"), F.lit(False))


def has_digit(c) -> Column:
    """True when the value holds at least one Unicode decimal digit."""
    return F.coalesce(_c(c).rlike(r"\p{Nd}"), F.lit(False))


# ------------------------------------------------------------------ scaling

def min_max_scale(x, lo, hi, range_min: float = 1.0, range_max: float = 100.0,
                  degenerate: str = "nan") -> Column:
    """Linear rescale of ``x`` from [lo, hi] to [range_min, range_max].

    When ``hi == lo`` the plain formula is 0/0.  ``degenerate="nan"`` keeps
    the original outcome (NaN, so every later comparison is false);
    ``degenerate="min"`` returns ``range_min`` instead.  ANSI division by
    zero never runs: the CASE branch guards it.
    """
    x, lo, hi = _c(x), _c(lo), _c(hi)
    if degenerate == "nan":
        flat = F.lit(float("nan"))
    elif degenerate == "min":
        flat = F.lit(float(range_min))
    else:
        raise ValueError(f"degenerate must be 'nan' or 'min', not {degenerate!r}")
    scaled = ((x - lo) / (hi - lo)) * F.lit(float(range_max - range_min)) + F.lit(float(range_min))
    return F.when(x.isNull(), F.lit(None).cast("double")).when(hi == lo, flat).otherwise(scaled)


# ---------------------------------------------------------------- distances

def _zipped_squares(xs: Column, ys: Column) -> Column:
    """Squared differences over the common prefix of two numeric arrays."""
    n = F.least(F.size(xs), F.size(ys))
    a = F.slice(xs, 1, n)
    b = F.slice(ys, 1, n)
    return F.zip_with(a, b, lambda x, y: (y.cast("double") - x.cast("double"))
                      * (y.cast("double") - x.cast("double")))


def _sum_doubles(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def euclidean_distance(xs, ys) -> Column:
    """sqrt of the summed squared differences; the longer array is truncated."""
    return F.sqrt(_sum_doubles(_zipped_squares(_c(xs), _c(ys))))


def mean_squared_difference(xs, ys) -> Column:
    """Summed squared differences over the common prefix / length of ``xs``.

    An empty ``xs`` gives NaN (0/0), as the original floating division did.
    """
    xs, ys = _c(xs), _c(ys)
    total = _sum_doubles(_zipped_squares(xs, ys))
    return F.when(F.size(xs) == 0, F.lit(float("nan"))).otherwise(total / F.size(xs))


def mean_squared_similarity(xs, ys) -> Column:
    """1 / (mean squared difference + 1)."""
    return F.lit(1.0) / (mean_squared_difference(xs, ys) + F.lit(1.0))


# ------------------------------------------------------------- set measures

def jaccard_similarity(a, b) -> Column:
    """|A ∩ B| / |A ∪ B| over the distinct elements; 0.0 if either is empty.

    A null list counts as empty (the original failed on it).
    """
    empty = F.array().cast("array<string>")
    sa = F.array_distinct(F.coalesce(_c(a), empty))
    sb = F.array_distinct(F.coalesce(_c(b), empty))
    ratio = F.size(F.array_intersect(sa, sb)).cast("double") / F.size(F.array_union(sa, sb)).cast("double")
    return F.when((F.size(sa) == 0) | (F.size(sb) == 0), F.lit(0.0)).otherwise(ratio)


def jaccard_distance(a, b) -> Column:
    return F.lit(1.0) - jaccard_similarity(a, b)


# ------------------------------------------------------------ segment rules

def segment_label(similarity, threshold) -> Column:
    """"1" below the threshold, else "2" (NaN compares false, so gives "2")."""
    return F.when(_c(similarity) < _c(threshold), F.lit("1")).otherwise(F.lit("2"))


def keep_old_segment(old, new) -> Column:
    """The new segment when there is one, else the previous one."""
    return F.coalesce(_c(new), _c(old))


# ------------------------------------------------------------ list strings

def _quoted(sep: str) -> str:
    """``sep`` as a regular expression that matches just this text."""
    if not sep:
        raise ValueError("the separator must not be empty")
    return r"\Q" + sep.replace(r"\E", r"\E\\E\Q") + r"\E"


def split_list(c, sep: str = ",") -> Column:
    """Split a delimited string into an array, keeping trailing empty items.

    ``sep`` is taken literally, whatever its characters.
    """
    return F.split(_c(c), _quoted(sep), -1)


def split_list_dropping_trailing(c, sep: str = ",") -> Column:
    """Split like the JVM's ``String.split``: trailing empty items are dropped
    (an empty input still gives one empty item)."""
    c = _c(c)
    esc = _quoted(sep)
    trimmed = F.regexp_replace(c, rf"({esc})+\z", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(trimmed == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, esc, -1)))


def merge_lists(first, second) -> Column:
    """Ordered merge: ``first`` then the items of ``second`` not yet present.

    A null side yields the other side unchanged.  Duplicates inside
    ``second`` are dropped, the order of both lists is kept.
    """
    first, second = _c(first), _c(second)
    return (F.when(first.isNull(), second)
            .when(second.isNull(), first)
            .otherwise(F.concat(first, F.array_except(second, first))))


__all__ = [
    "non_blank", "digits_only", "has_digit", "min_max_scale",
    "euclidean_distance", "mean_squared_difference", "mean_squared_similarity",
    "jaccard_similarity", "jaccard_distance", "segment_label", "keep_old_segment",
    "split_list", "split_list_dropping_trailing", "merge_lists",
]
