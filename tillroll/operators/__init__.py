"""DataFrame operators of the retail jobs."""

from tillroll.operators.baskets import (  # noqa: F401
    RuleSet, association_rules, baskets, fit_rules, frequent_itemsets, mine_pair_rules, mine_rules, pair_rules,
)
from tillroll.operators.clean import clean_transactions, flagged_lines, load_customers, load_products  # noqa: F401
from tillroll.operators.compare import (  # noqa: F401
    centroid_distances, jaccard_compare, jaccard_summary, label_centroids, vector_centroid_distances,
)
from tillroll.operators.recommend import (  # noqa: F401
    frequently_bought, merge_recommendations, one_item_rules, recommend, rule_index,
)
from tillroll.operators.segments import (  # noqa: F401
    Segmentation, customer_aggregates, customer_features, customer_segments, customer_similarity, customers_of,
    purchase_features, purchase_table, purchases_of, raw_purchase_table, segment_customers, segment_stats, segmentation_job, similarity_summary, update_segments,
)
from tillroll.operators.segment_recs import (  # noqa: F401
    general_recommendations, recommendations_by_segment, segment_baskets,
    segment_recommendations, segment_transactions,
)
