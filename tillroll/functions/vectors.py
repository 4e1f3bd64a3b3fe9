"""Distance between two ML ``Vector`` columns (dense or sparse)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.columns import euclidean_distance


def vector_euclidean_distance(v1, v2) -> Column:
    """Euclidean distance of two ML vectors of the same size.

    ``vector_to_array`` is a JVM-side conversion; the distance itself is the
    array form.  Vectors of different sizes raise an error (the array form
    would compare their common prefix); a null vector gives null.
    """
    a = vector_to_array(F.col(v1) if isinstance(v1, str) else v1, "float64")
    b = vector_to_array(F.col(v2) if isinstance(v2, str) else v2, "float64")
    sizes = F.concat(F.lit("vectors of different sizes: "), F.size(a).cast("string"), F.lit(" and "),
                     F.size(b).cast("string"))
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(F.size(a) != F.size(b), F.raise_error(sizes).cast("double"))
            .otherwise(euclidean_distance(a, b)))
