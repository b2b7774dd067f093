"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.skew import join_counted
from corpusmill.session import release, written


def _unfinished(arcs: DataFrame) -> DataFrame:
    """``other``: what arcs lead to that do not belong to a star apart from all others, of leaves with one
    arc each that lead to a node without one."""
    nodes = arcs.groupBy("node").agg(F.count("*").alias("n"))
    # Distinct first: all leaves of a hub would meet under its key.
    others = arcs.select(F.col("other").alias("node")).distinct()
    inner = others.join(nodes.select("node"), "node", "left_semi")
    bad = nodes.where("n > 1").select("node").unionByName(inner).distinct()
    return arcs.join(bad, "node", "left_semi").select("other").unionByName(inner.withColumnRenamed("node", "other")).distinct()


def _star(arcs: DataFrame, total: int) -> tuple[DataFrame, str]:
    """Join every arc with the smallest neighbour of its node, which a table of this path holds."""
    least, path = written(arcs.groupBy("node").agg(F.min("other").alias("least"), F.count("*").alias("n")), "least")
    return join_counted(arcs, least, "node", total), path


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component`` for every end of an edge; a component is named by its least node.

    Alternates the large-star and the small-star step (Kiveris and others, 2014) until
    only stars are left, which takes a number of rounds that grows with the logarithm of
    the graph's size. An arc leads from a larger ``node`` to a smaller ``other``; the steps
    never add arcs beyond the first number of them. Stars apart from all others take no part in
    later rounds. Tables of earlier rounds are removed.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    ends = ends.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    current, path = written(ends.distinct(), "edges")
    total = 2 * current.count()
    finished = []
    while True:
        open_, third = written(_unfinished(current), "open")
        if open_.isEmpty():
            break
        finished.append(written(current.join(open_, "other", "left_anti").select("node", "other"), "stars")[0])
        before = path
        current, path = written(current.join(open_, "other", "left_semi").select("node", "other"), "edges")
        release(edges.sparkSession, before, third)
        both = current.unionByName(current.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large, first = _star(both, total)
        large = large.where("other > node")
        large = large.select(F.col("other").alias("node"), F.least("least", "node").alias("other")).distinct()
        # Written, since the next step reads it four times.
        large, second = written(large, "large")
        small, third = _star(large, total)
        # Each smaller neighbour, and the node itself, hangs from the least of them.
        small = small.select(F.explode(F.array("node", "other")).alias("node"), F.col("least").alias("other"))
        before = path
        current, path = written(small.where("node <> other").distinct(), "edges")
        release(edges.sparkSession, before, first, second, third)
    for stars in finished:
        current = current.unionByName(stars)
    leaves = current.select("node", F.col("other").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
