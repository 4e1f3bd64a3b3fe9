"""Column-level functions: predicates, scaling, distances, list handling."""

from tillroll.functions.columns import (  # noqa: F401
    digits_only,
    euclidean_distance,
    has_digit,
    jaccard_distance,
    jaccard_similarity,
    keep_old_segment,
    mean_squared_difference,
    mean_squared_similarity,
    merge_lists,
    min_max_scale,
    non_blank,
    segment_label,
    split_list,
    split_list_dropping_trailing,
)
from tillroll.functions.vectors import vector_euclidean_distance  # noqa: F401
