"""Ordered work without a task for a whole group: rows dealt to ranges, sums and last values carried between ranges.

A window over a group sorts the group in one task, and a state, a leaf or a cell may hold a third of all rows. Here rows
are range partitioned by group and order, so a large group lies in many consecutive ranges. Windows run within a
range and group; what a range needs from those before it is one row a range and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popforge.sources.storage import written

RANGE = "_range"


def in_ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """df, written, with the number of the range that each row lies in; ranges follow the order given."""
    return written(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()))


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], amount: str, upto: str, total: str) -> DataFrame:
    """df with the sum of `amount` over its group up to and with each row, and over the whole group. Order columns must
    tell the rows of a group apart."""
    ranged = in_ranges(df, [*group, *order])
    sums = ranged.groupBy(*group, RANGE).agg(F.sum(amount).alias("_sum"))
    whole = Window.partitionBy(*group)
    carried = F.coalesce(F.sum("_sum").over(whole.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*[F.col(g).alias(f"_{g}") for g in group], F.col(RANGE).alias("_r"), carried.alias("_before"), F.sum("_sum").over(whole).alias(total))
    local = F.sum(amount).over(Window.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    found = ranged.withColumn(upto, local)
    same = F.col(RANGE) == F.col("_r")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    found = found.join(sums, same)
    return found.withColumn(upto, F.col(upto) + F.col("_before")).drop(RANGE, "_r", "_before", *[f"_{g}" for g in group])


def shares(df: DataFrame, group: Sequence[str], unit: str, size: str) -> DataFrame:
    """group, unit, low, high: each unit's share of its group's total size as a half-open interval of [0, 1), in unit
    order. The last interval ends above 1, so that rounding leaves no gap. Units of no size have no interval."""
    summed = running_sums(df.select(*group, unit, F.col(size).alias("_size")).where("_size > 0"), group, [unit], "_size", "_upto", "_total")
    high = F.when(F.col("_upto") >= F.col("_total"), F.lit(2.0)).otherwise(F.col("_upto") / F.col("_total"))
    return summed.select(*group, unit, ((F.col("_upto") - F.col("_size")) / F.col("_total")).alias("low"), high.alias("high"))


def draw(records: DataFrame, u: str, group: Sequence[str], intervals: DataFrame, unit: str) -> DataFrame:
    """records with the unit whose interval of their group holds u; null where the group has none.

    The line from 0 to 1 is cut into about as many buckets as a group has units, up to MOST_BUCKETS, and intervals go to
    the buckets they touch: an equi-join by group and bucket, whose condition is checked in the join, so neither a
    group's units nor its records meet in one place.
    """
    sizes = intervals.groupBy(*group).agg(F.least(F.count(F.lit(1)), F.lit(MOST_BUCKETS)).cast("int").alias("_n"))
    sizes = written(sizes)
    last = F.col("_n") - 1
    side = intervals.join(sizes, list(group))
    touched = F.sequence(F.least(F.floor(F.col("low") * F.col("_n")).cast("int"), last), F.least(F.floor(F.col("high") * F.col("_n")).cast("int"), last))
    side = side.select(*[F.col(g).alias(f"_{g}") for g in group], unit, "low", "high", F.explode(touched).alias("_b"))
    placed = records.join(sizes, list(group), "left").withColumn("_at", F.least(F.floor(F.col(u) * F.col("_n")).cast("int"), last))
    same = (F.col("_at") == F.col("_b")) & (F.col(u) >= F.col("low")) & (F.col(u) < F.col("high"))
    for g in group:
        same = same & (F.col(g) == F.col(f"_{g}"))
    return placed.join(side, same, "left").select(*records.columns, unit)


#: Buckets of a group in draw(); a group of more units has several in a bucket.
MOST_BUCKETS = 65_536
