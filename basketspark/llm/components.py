"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.common import Written


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (columns u and v, any order, repeats allowed); root: the smallest node.

    Each pass moves neighbours to the smallest neighbour of a node, first the larger ones, then the smaller ones; the
    number of passes grows with the logarithm of the longest path. Minima are pre-aggregated, and hubs meet only in
    joins that adaptive execution can split.
    """
    written = Written(links.sparkSession, "components")
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges, before, k = written.keep(edges, "0"), None, 0
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before, k = now, k + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written.keep(large, f"large{k}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written.keep(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), str(k))
        written.drop(f"large{k}", str(k - 1))
        edges = after
