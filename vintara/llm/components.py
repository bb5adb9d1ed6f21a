"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Each step replaces edges by as many edges to smaller nodes at most, so the graph never grows, and the number of
rounds grows with the logarithm of the longest path. Minima are combined before the shuffle, so a node with very
many neighbours sends one row per task; the join back to its edges is one that adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vintara.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b").select("a", "b", "m")
    return joined.select(F.col("m").alias("a"), F.col("a").alias("b")).union(
        joined.select("m", "b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b) that is not the smallest of its component."""
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))


def numbered_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as ``_doc``, each with a number ``_node`` of its own, written."""
    return written(docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_node")), "numbered")


def smallest_stay(keyed: DataFrame, reached: DataFrame, identifier: str) -> DataFrame:
    """The rows of :func:`numbered_rows` without all but one of each component (node, component): the one with the smallest id
    stays, null ids come last."""
    members = reached.select("node", "component").union(reached.select("component", F.col("component").alias("_same")).distinct())
    members = members.join(keyed.select("_node", F.col(f"_doc.{identifier}").alias("_id")), F.col("node") == F.col("_node"))
    members = written(members.select("component", "node", F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"),
                                                                   F.col("node").alias("row")).alias("rank")), "members")
    best = members.groupBy("component").agg(F.min("rank").alias("best"))
    left_out = members.join(best, "component").where(F.col("node") != F.col("best.row")).select(F.col("node").alias("_out"))
    return keyed.join(left_out, F.col("_node") == F.col("_out"), "left_anti").select("_doc.*")
