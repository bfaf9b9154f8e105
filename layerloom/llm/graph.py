"""Connected components by alternating star contractions; every step is a join or an aggregation over all edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerloom.llm.common import written

ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest among node and neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = near.join(least, "u").where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (a, b). Loops, repeats and both directions are allowed;
    edges with a null end are left out."""
    clean = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    stars = written(clean.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), "edges")
    seen = None
    for _ in range(ROUNDS):
        stars = written(_small_star(_large_star(stars)), "stars")
        # all edges end in their component's smallest node when nothing changes any more
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"no end after {ROUNDS} rounds")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
