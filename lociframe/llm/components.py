"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from .shared import dropped, written


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edge table, written, and its count and order-free digest, observed on the way: one row to the driver."""
    seen = Observation()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    table = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")), "edges")
    return table, (seen.get["n"], seen.get["digest"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, the component being its least node.

    Edges have no direction; loops and edges with a null end are ignored, and a node without another edge is not
    listed. Each round is a table in the shared folder, so that a lost executor does not undo earlier rounds; two
    numbers a round reach the driver. Rounds grow with the logarithm of the number of nodes.
    """
    u, v = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    table, mark = _marked(edges.where(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct())
    while mark[0]:
        after, after_mark = _marked(_small_star(_large_star(table)))
        dropped(table)
        table, mark, before = after, after_mark, mark
        if mark == before:
            break
    return table.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        table.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
