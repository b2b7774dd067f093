"""A spanning forest of an edge table, by Borůvka's rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialize


def _roots(best: DataFrame) -> DataFrame:
    """``node, root``: where each node's chosen arcs lead to in the end.

    Two nodes that chose the same edge point at each other; the smaller one is the root.
    Pointers are doubled, so the rounds grow with the logarithm of the longest way.
    """
    hooks = best.select("node", F.col("best.other").alias("root"))
    back = hooks.select(F.col("node").alias("root"), F.col("root").alias("back"))
    mutual = (F.col("back") == F.col("node")) & (F.col("node") < F.col("root"))
    moved = hooks.join(back, "root").select("node", F.when(mutual, F.col("node")).otherwise(F.col("root")).alias("root"))
    while True:
        moved = materialize(moved, "hooks")
        on = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = moved.join(on, "root")
        if jumped.where("root <> next").isEmpty():
            return moved
        moved = jumped.select("node", F.col("next").alias("root"))


def spanning_forest(links: DataFrame, src: str = "src", dst: str = "dst", weight: str = "weight") -> DataFrame:
    """``src, dst, weight``: of all links those that connect what all of them connect, one fewer
    than nodes in each component; the heaviest such, ties by the ends' ids.

    Each round every component takes its best link to another one (a partial aggregation, whatever
    the size of a hub), and components that links join become one. Of links between the same
    two components only the best is kept. The number of components halves at least.
    """
    ends = links.where(f"{src} <> {dst}").select(
        F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst"), F.col(weight).alias("weight")
    )
    rank = F.struct((-F.col("weight")).alias("less"), "src", "dst").alias("rank")
    edges = materialize(ends.select(F.col("src").alias("a"), F.col("dst").alias("b"), rank).distinct(), "edges")
    kept: list[DataFrame] = []
    while not edges.isEmpty():
        ways = F.array(
            F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        arcs = edges.select(F.inline(ways), "rank")
        best = materialize(arcs.groupBy("node").agg(F.min(F.struct("rank", "other")).alias("best")), "best")
        kept.append(best.select("best.rank.*").distinct())
        roots = _roots(best)
        for end in ("a", "b"):
            edges = edges.join(roots.withColumnRenamed("node", end), end, "left")
            edges = edges.withColumn(end, F.coalesce("root", end)).drop("root")
        apart = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "rank")
        edges = materialize(apart.groupBy("a", "b").agg(F.min("rank").alias("rank")), "edges")
    if not kept:
        return ends.where(F.lit(False))
    return reduce(DataFrame.unionByName, kept).select("src", "dst", (-F.col("less")).alias("weight"))
