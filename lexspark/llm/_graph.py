"""Connected components of a link table, by joins and min-aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import Store


def connected_components(links: DataFrame, store: Store, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable from each id that has a link.

    Alternating large-star and small-star steps; each is a map-side combined minimum and one join,
    so a hub's links are folded in each task before they meet; the joins are by the hub's id, where adaptive
    execution splits what is skewed. Links are kept on the cluster; the driver sees two sums.
    """
    edges = store.save(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.toDF("u", "v"))
        after = store.save(small.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        store.drop(edges)
        edges = after
        sums = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == seen:
            break
        seen = sums
    star = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return star.union(star.select("component", "component").distinct())
