"""A purchase holding a third of all lines is split across tasks and
pre-aggregated before the purchase-key shuffle (AQE forced skew join)."""

from pyspark.sql import functions as F

from tillroll import operators as ops
from tillroll.plans.strategies import cut_lineage
from tillroll.session import splitting_skew
from tillroll.sources import fixtures as fx

from conftest import SF_MID


def test_hot_purchase_is_split_and_result_whole(spark, monkeypatch):
    li = (fx.table(spark, SF_MID, "lineitem")
          .withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
          .repartition(8))
    real = fx.table
    monkeypatch.setattr(fx, "table", lambda s, d, n: li if n == "lineitem" else real(s, d, n))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "32",
            # Spark's default: the operator itself asks for the split.
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        lazy = ops.baskets(fx.transactions(spark, SF_MID))
        with splitting_skew(spark):
            plan = lazy._jdf.queryExecution().executedPlan()
            plan.executeCollect()
        text = plan.toString()
        assert "skew=true" in text and "AQEShuffleRead skewed" in text
        # What the jobs write goes this way, and the caller's setting is as before.
        b = cut_lineage(spark, lazy, "hot-baskets")
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
        # the hot purchase is whole: one row with every brand of the hot lines
        hot = li.filter(F.col("l_orderkey") == 0).select("l_partkey").distinct()
        brands = (hot.join(fx.table(spark, SF_MID, "part"), hot.l_partkey == F.col("p_partkey"))
                  .select("p_brand").distinct().count())
        hot_rows = b.filter(F.col("InvoiceNo") == "0").collect()
        assert len(hot_rows) == 1 and len(hot_rows[0]["items"]) == brands
        assert lazy.count() == b.count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
