"""A key holding a third of all rows: results stay whole, AQE splits the join."""

from pyspark.sql import functions as F

from regflat.operators.merge import VERSION_COL, bulk_merge, replace_by_key
from regflat.plans.publish import session_conf

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _old(spark, n=30000):
    # a third of the rows share key "hot"
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("p"))


def test_replace_with_hot_key_splits_and_stays_whole(spark):
    with session_conf(spark, SKEW_CONF):
        old = _old(spark)
        new = spark.range(0, 30000, 7).select(F.col("id").cast("string").alias("k"), F.lit(-1).alias("p"))
        out = replace_by_key(old, new, ["k"])
        n = len(out.collect())   # runs this plan, so the final adaptive plan is visible
        plan = out._jdf.queryExecution().executedPlan().toString()
    new_keys = {str(i) for i in range(0, 30000, 7)}
    expected = sum(1 for i in range(30000) if i % 3 == 0 or str(i) not in new_keys) + len(new_keys)
    assert n == expected
    assert "skew=true" in plan


def test_bulk_merge_hot_key_versions(spark):
    with session_conf(spark, SKEW_CONF):
        deltas = _old(spark).withColumn(VERSION_COL, (F.col("p") % 5).cast("int"))
        present = deltas.select(VERSION_COL).distinct()
        dels = deltas.filter(F.col("p") == 1).select("k", VERSION_COL)
        out = bulk_merge(None, deltas, dels, present, ["k"])
        got = out.groupBy(VERSION_COL).count().collect()
    # 20000 single-row keys all survive (key "1" is deleted in its own version: kept);
    # the hot key keeps every row of its last version 4 (ids % 3 == 0 and % 5 == 4)
    hot_last = sum(1 for i in range(30000) if i % 3 == 0 and i % 5 == 4)
    assert sum(r["count"] for r in got) == 20000 + hot_last
