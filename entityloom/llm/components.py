"""Connected components of an edge table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import staged_rows


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are hung on the smallest of its neighbourhood."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Neighbours below a node, and the node, are hung on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .filter("u <> v")
        .distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v); the root is the smallest node reachable.

    Loops and repeated edges are harmless; without edges the result is empty.  Each round is a
    table in the shared folder; rounds end when one changes nothing.
    """
    now = staged_rows(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    seen = _signature(now)
    while True:
        now = staged_rows(_small_star(_large_star(now)), "edges")
        fresh = _signature(now)
        if fresh == seen:
            break
        seen = fresh
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)
