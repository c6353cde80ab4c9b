"""Connected components of links between ids, as Spark joins over the links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.tables import discard, staged


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of ``links(a, b)``: the smallest id that can be reached.

    Alternates the large-star and small-star steps: every id hands the smallest of its neighbourhood to its larger
    neighbours, then to its smaller ones, until nothing changes; the number of rounds grows with the logarithm of a
    component's width. A star with millions of arms is grouped with partial aggregation, so no task holds it.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u <> v").distinct(), "links")
    state = _checksum(edges)
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # staged, so that the joins with a hub's many links are plain shuffles, which AQE can split
        low = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = both.filter("v < u").join(low, "u").filter("v = m").select("u", "v")
        starred = large.unionByName(kept).filter("u <> v").distinct()
        least = starred.groupBy("u").agg(F.min("v").alias("m"))
        small = starred.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        before, edges = edges, staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(before, low)
        now = _checksum(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id")).distinct()
    return (edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
            .unionByName(roots.join(edges.select(F.col("u").alias("id")), "id", "left_anti")
                         .select("id", F.col("id").alias("component"))))


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
