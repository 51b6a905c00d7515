"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import durable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Both tables are written, so both sides of the join are plain shuffles and Spark can split the edges of a node with very many."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = durable(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    joined = both.join(least, "a")
    if large:
        return durable(joined.where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
    out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return durable(out.where("a <> b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node of its component.

    Rounds go on until each component is a star around its least node; each is a few shuffles of the edge table, which never
    grows. No edges: no rows."""
    now = durable(edges.select("a", "b").where("a <> b").distinct())
    while True:
        now = _star(_star(now, True), False)
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(now.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        if ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR out > 0 AND into > 0").isEmpty():
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
