"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.scratch import checkpointed


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """pairs(u, v) with m, the least of u and all its v.

    The join is on u and a hash of u, so that both sides are dealt anew: the partitions of a node with
    very many links can then be split by adaptive execution.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lu"), F.least("u", "m").alias("m"))
    left, right = pairs.withColumn("h", F.xxhash64("u")), least.withColumn("lh", F.xxhash64("lu"))
    return left.join(right, (F.col("u") == F.col("lu")) & (F.col("h") == F.col("lh"))).select("u", "v", "m")


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with a link to another one; root is the least node that can be reached.

    Links to oneself or with a null end are left out. Every round is a Spark job whose result is
    checkpointed; only a count and a hash of the links reach the driver.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    links, before = checkpointed(links), None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        small = _to_smallest(large)
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x")).select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
        links = checkpointed(small.where("u > v").distinct())
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
