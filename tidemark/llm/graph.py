"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scratch import written


def _stars(arcs: DataFrame) -> DataFrame:
    """Every arc (a, b) with the least node of a's neighbourhood, a included."""
    least = arcs.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return arcs.join(least, "a")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    made = _stars(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return made.where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    arcs = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return arcs.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest node reachable.

    Loops, repeated edges and rows with a null end count for nothing. Every round is written to the shared
    folder, so a lost executor repeats one step and plans stay short; the minimum per node is combined
    before its shuffle, so the centre of a huge star is one row. Rounds grow with the logarithm of the
    longest path.
    """
    edges = edges.select("a", "b").where("a <> b").distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small(_large(edges)), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return inner.union(roots)
