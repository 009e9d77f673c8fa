"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouping and a join on node ids; what is gathered per node is
one minimum, so a node with very many edges is no group to hold.  Each round
is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node of the component.

    Self-loops and repeated edges change nothing; rows with a null end are
    ignored; an empty table gives no rows.
    """
    spark = edges.sparkSession
    base = work_dir(spark, "components")

    def stored(df: DataFrame, k: int) -> DataFrame:
        df.write.parquet(f"{base}/{k}")
        return spark.read.parquet(f"{base}/{k}")

    def down(a, b):
        return F.greatest(a, b).alias("a"), F.least(a, b).alias("b")

    now = stored(edges.where("a is not null and b is not null and a <> b")
                 .select(*down(F.col("a"), F.col("b"))).distinct(), 0)
    seen = None
    k = 0
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")) \
            .where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b") \
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        k += 1
        now = stored(small, k)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
