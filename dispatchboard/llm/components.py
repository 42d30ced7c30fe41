"""Connected components of an edge table, entirely in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchboard.llm.shared import saved


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(a, b)``;
    root is the smallest node it can reach.

    Alternates large-star and small-star steps (Kiveris et al., 2014): each
    round links every neighbour to the smallest one, which halves distances,
    so a long chain takes logarithmically many rounds. A star's centre may
    hold any share of the edges: its minimum is pre-aggregated in the map
    tasks, and the join that follows can split it. Every round is saved in
    the shared folder; only a count and a checksum come to the driver. Self
    edges and repeated edges are allowed, null ends are ignored.
    """
    now = saved(edges.where(F.col("a") != F.col("b"))
                .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct(), "edges")
    before = _print(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        # Large star: every larger neighbour of u goes to the smallest of u's set.
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        # Small star: every smaller neighbour of u, and u, goes to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where(F.col("u") != F.col("v")).distinct())
        now = saved(small, "edges")
        after = _print(now)
        if after == before:
            break
        before = after
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
