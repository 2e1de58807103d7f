"""Transitive lineage: all that a node is made from, by rounds of joins, with cycles found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.sources.storage import discard, written


class CycleError(ValueError):
    """Nodes that are made from themselves."""


def closure(edges: DataFrame) -> DataFrame:
    """node, origin, steps: every node that each node of edges(node, needs) is made from, with the least number of steps.

    Each round follows the pairs found in the last one by one edge and keeps what is new, so there are as many rounds as
    the longest shortest path has steps. Rounds are written to the shared folder. Repeated edges count once, edges with a
    null end not at all. A cycle is an error that names nodes on it; no edges: no rows.
    """
    edges = written(edges.where("node is not null and needs is not null").select("node", "needs").distinct())
    step = edges.select(F.col("node").alias("origin"), F.col("needs").alias("further"))
    found = edges.select("node", F.col("needs").alias("origin"), F.lit(1).alias("steps"))
    last, rounds = found, [edges]
    n = 1
    while True:
        if looped := [r.node for r in last.where("node = origin").select("node").distinct().orderBy("node").limit(5).collect()]:
            discard(*rounds)
            raise CycleError(f"made from themselves: {looped}")
        n += 1
        ahead = last.join(step, "origin").select("node", F.col("further").alias("origin")).distinct()
        new = written(ahead.join(found, ["node", "origin"], "left_anti").withColumn("steps", F.lit(n)))
        rounds.append(new)
        if new.isEmpty():
            return found
        found, last = found.unionByName(new), new
