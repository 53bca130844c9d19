"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.sources.scratch import scratch_dir

ROUNDS = 50


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of an edge; the label is the least node reached.

    Alternating large and small stars: every round links nodes closer to the least
    node around them, and the rounds grow with the logarithm of the longest path.
    Each round is written to the shared folder, which cuts the lineage.  A node with
    very many edges gives one row per task to the minimum; the joins that follow are
    left to the skew handling of adaptive execution.  No edges give no rows.
    """
    spark = edges.sparkSession
    path = scratch_dir(spark, "components")
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    pairs.write.parquet(f"{path}/0")
    pairs = spark.read.parquet(f"{path}/0")
    before = None
    for round_ in range(1, ROUNDS + 1):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(lowest, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        small.write.parquet(f"{path}/{round_}")
        pairs = spark.read.parquet(f"{path}/{round_}")
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    found = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return found.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
