"""Connected components of links, by stars that contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.store import saved


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``): the least node reachable.

    Each round points every node at the least of its neighbours, first from above, then from below;
    the number of rounds grows with the logarithm of the longest path. A node with many neighbours is
    split by the joins' skew handling, and the minima are combined before the shuffle.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        joined = large.join(down, F.col("u") == F.col("w"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").union(down.select("w", "m")).distinct()
        edges = saved(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
