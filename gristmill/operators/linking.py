"""Connected components in logarithmically many rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators import lineage


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of the ends of ``edges`` (a, b): the component is its smallest id.

    Every end hooks on to its first neighbour, and edges are contracted to what is hooked on, until none are left. First
    is the smallest id in the first two rounds, then a pseudo-random order drawn anew each round, so that long chains halve
    too. Null ends and loops are ignored.
    """
    start = live = lineage.cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    rank = lambda turn, c: F.col(c) if turn < 2 else F.xxhash64(F.lit(turn), F.col(c))
    hooks: list[DataFrame] = []
    while not live.isEmpty():
        turn = len(hooks)
        both = live.union(live.select("b", "a"))
        first = both.groupBy("a").agg(F.min(F.struct(rank(turn, "b").alias("r"), F.col("b").alias("v"))).alias("m"))
        own: Column = F.when(F.col("m.r") < rank(turn, "a"), F.col("m.v")).otherwise(F.col("a"))
        hooks.append(lineage.cut(first.select(F.col("a").alias("label"), own.alias("to"))))
        at = lambda end, to: hooks[-1].select(F.col("label").alias(end), F.col("to").alias(to))
        moved = live.join(at("a", "x"), "a").join(at("b", "y"), "b").where("x <> y")
        contracted = lineage.cut(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if live is not start:
            lineage.drop(live)
        live = contracted
    ends = start.select(F.col("a").alias("id")).union(start.select("b")).distinct()
    label = ends.withColumn("label", F.col("id"))
    for hook in hooks:
        label = label.join(hook, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    label = lineage.cut(label)
    lineage.drop(start, *hooks)
    return label.join(label.groupBy("label").agg(F.min("id").alias("component")), "label").select("id", "component")
