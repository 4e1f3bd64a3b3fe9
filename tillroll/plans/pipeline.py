"""The chained recommendation pipeline (C7): clean -> segment -> general
recommendations -> per-segment recommendations filled with the general ones.

The raw lines are read once, by the purchase aggregation, whose conditional parts serve
cleaning and the initial load; what it gives
is written below ``spark.checkpoint.dir`` and feeds customers, segmentation and the
pair counts of all labels.  Segment labels are the fixed outcomes of the segment rule, so no
data is collected to decide what to run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.baskets import MIN_CONFIDENCE, MIN_SUPPORT
from tillroll.operators.clean import clean_transactions
from tillroll.operators.segment_recs import recommendations_by_segment
from tillroll.operators.segments import customers_of, purchases_of, raw_purchase_table
from tillroll.plans.strategies import cut_lineage
from tillroll.schema import RECS, SEGMENT, STOCK_CODE

# The labels the segment rule produces, and the label used here
# for the general (unsegmented) recommendations.
SEGMENT_LABELS = ("1", "2")
GENERAL_LABEL = "gen"


def run_pipeline(raw: DataFrame, customers: DataFrame | None = None,
                 min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> dict[str, DataFrame]:
    """Run the whole chain on raw purchase lines.

    ``customers`` is the previous (CustomerID, segment) table; by default the
    initial load of ``raw`` (every customer unsegmented).  Returns the
    intermediate and final DataFrames by name: clean (lazy), segments,
    customers, gen, and one entry per segment label.
    """
    clean = clean_transactions(raw)
    table = cut_lineage(raw.sparkSession, raw_purchase_table(raw), "purchases")
    if customers is None:
        customers = customers_of(table)
    out = recommendations_by_segment(clean, SEGMENT_LABELS, previous=customers, general=True,
                                     min_support=min_support, min_confidence=min_confidence,
                                     general_label=GENERAL_LABEL, purchases=purchases_of(table))
    out["clean"] = clean
    return out


def pipeline_recommendations(raw: DataFrame, **kwargs) -> DataFrame:
    """(segment, StockCode, recs) for the general and every segment run."""
    res = run_pipeline(raw, **kwargs)
    out = None
    for label in (GENERAL_LABEL,) + SEGMENT_LABELS:
        part = res[label].select(F.lit(label).alias(SEGMENT), STOCK_CODE, RECS)
        out = part if out is None else out.unionByName(part)
    return out
