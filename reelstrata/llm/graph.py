"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstrata.llm.common import stored


def stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v); each is an aggregate and a join on the centre.

    Least neighbours are combined on the map side and the join may split a hot centre."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = large.where("u <> v").distinct()  # every edge points to the smaller end
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    small = down.join(least, "u")
    near = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """node and its component (the least node) for edges (u, v) between 64-bit nodes; nodes without an edge are absent."""
    u, v = F.greatest("u", "v"), F.least("u", "v")
    now = stored(edges.select(u.alias("u"), v.alias("v")).where("u <> v").distinct(), name)
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == mark:
            break
        mark = state
        if not state.n:
            break
        now = stored(stars(now), name)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
