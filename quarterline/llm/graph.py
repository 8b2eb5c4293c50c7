"""Connected components by joins: large stars and small stars, until nothing changes.

A vertex of any degree is met by a minimum and a join on its key, never by a list of its
neighbours. Each round is written to the shared folder and the one before it deleted.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.plans.lineage import discard, materialise, new_path


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, of every vertex that has an edge.
    Edges may be repeated, run either way or in circles."""
    spark = edges.sparkSession
    u, v = F.col(a), F.col(b)
    stars = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    path, before = None, None
    while True:
        new = new_path(spark, "stars")
        stored = materialise(stars, "stars", new)
        if path:
            discard(spark, path)
        path = new
        state = stored.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = stored.unionByName(stored.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u OR v < u").join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        stars = small.where("u <> v").distinct()
    found = stored.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(stored.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
