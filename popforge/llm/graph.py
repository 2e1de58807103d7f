"""Connected components of a graph of long node ids, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.llm.shared import discard, written


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of edges(a, b) other than the roots themselves.

    Alternating large and small stars (Kiveris et al., 2014): nodes are linked to the smallest neighbour, first from
    larger neighbours, then among smaller ones, until nothing changes; about log(n) rounds, each written to the shared
    folder. Self links and repeated links are ignored; no edges: no rows.
    """
    stars = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    mark = None
    while (now := stars.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != mark:
        mark = now
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(stars.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(below.select("a", F.col("m").alias("b")))
        before, stars = stars, written(small.distinct())
        discard(before)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
