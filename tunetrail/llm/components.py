"""Connected components of a link table, by alternating large-star and small-star steps (joins and aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed, compact

#: Links of a partition, about.
ROWS = 200_000


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another; root is the least node of its component.

    The links never leave the executors; each step is checkpointed.  The number of steps grows with the logarithm of
    a component's longest path.  Links from a node to itself and links with a null end count for nothing.
    """
    edges = compact(checkpointed(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()), ROWS)
    seen = None
    while True:
        # large star: every greater neighbour of u points to the least of u and its neighbours
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).withColumn("m", F.least("w", "m"))
        large = both.join(least, F.col("u") == F.col("w")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # small star: u and its lesser neighbours point to the least of them
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("w")).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = compact(checkpointed(small.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()), ROWS)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
