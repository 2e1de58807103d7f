"""Entity tables, their links, counts over households, and allocation of group amounts to members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popforge.operators.ranges import running_sums


def entity_tables(persons: DataFrame, links: Mapping[str, str]) -> dict[str, DataFrame]:
    """Distinct keys of each linked entity (name -> link column on person)."""
    return {entity: persons.select(F.col(link).alias(f"{entity}_id")).where(F.col(link).isNotNull()).distinct() for entity, link in links.items()}


def orphans(child: DataFrame, link: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose link finds no parent; null links are orphans."""
    return child.join(parent.select(F.col(key).alias(link)), link, "left_anti")


def household_counts(persons: DataFrame, household: str, age: str | Column, limits: Mapping[str, int], size: str = "household_size") -> DataFrame:
    """Each person with its household's size and members under each age limit.

    Counts are aggregated before they are joined back, so a household of any size never sits in one task. Persons without
    a household (null) stay, and are counted as one household, as a window would.
    """
    age = F.col(age) if isinstance(age, str) else age
    counts = persons.groupBy(F.col(household).alias("_household")).agg(F.count(F.lit(1)).alias(size), *[F.count_if(age < limit).alias(name) for name, limit in limits.items()])
    return persons.join(counts, F.col(household).eqNullSafe(F.col("_household"))).drop("_household")


def allocate(members: DataFrame, group: str, amount: str, weight: str | Column, order: Sequence[str], name: str, method: str = "share") -> DataFrame:
    """A group's amount dealt to members by weight share (equally where all weights are 0), or whole to the first."""
    whole = Window.partitionBy(group)
    if method == "head":
        first = F.row_number().over(whole.orderBy(*order)) == 1
        return members.withColumn(name, F.when(first, F.col(amount)).otherwise(F.lit(0.0)))
    if method != "share":
        raise ValueError(f"unknown method {method!r}")
    weight = F.col(weight) if isinstance(weight, str) else weight
    total = F.sum(weight).over(whole)
    share = F.when(total > 0, weight / F.when(total > 0, total)).otherwise(F.lit(1.0) / F.count(F.lit(1)).over(whole))
    return members.withColumn(name, F.col(amount) * share)


def allocate_exact(members: DataFrame, group: str, amount: str, weight: str, key: str, name: str) -> DataFrame:
    """A group's whole amount (an integer, as of cents) dealt to its members in integers that add up to it exactly.

    Each gets its share by weight rounded down, and what is left over goes, one each, to those with the largest remainders,
    ties to smaller keys. Weights are integers; negative and null ones count 0, and where all are 0 all count alike. A
    negative amount is dealt like its size. Members of a group state the same amount; the largest counts if they don't.
    Members without a group or amount get null. key tells members apart.

    Sums are aggregated before they are joined back and ranks counted over ranges of remainders, so a group of any size
    never sits in one task.
    """
    wide = "decimal(38,0)"
    own = F.greatest(F.coalesce(F.col(weight), F.lit(0)), F.lit(0)).cast("long")
    sums = members.where(F.col(group).isNotNull() & F.col(amount).isNotNull()).groupBy(F.col(group).alias("_group"))
    sums = sums.agg(F.max(amount).cast("long").alias("_amount"), F.sum(own).cast(wide).alias("_weights"), F.count(F.lit(1)).cast(wide).alias("_members"))
    placed = members.where(F.col(amount).isNotNull()).join(sums, F.col(group) == F.col("_group"))
    equal = F.col("_weights") == 0
    placed = placed.withColumn("_whole", F.when(equal, F.col("_members")).otherwise(F.col("_weights")))
    placed = placed.withColumn("_part", F.abs("_amount").cast(wide) * F.when(equal, F.lit(1)).otherwise(own).cast("decimal(19,0)"))
    placed = placed.select("_group", F.col(key).alias("_key"), "_amount", F.expr("_part div _whole").alias("_down"), F.expr("cast(_part % _whole as decimal(38,0))").alias("_rest"), F.lit(1).cast("long").alias("_one"), F.lit(True).alias("_in"))
    left = placed.groupBy(F.col("_group").alias("_of")).agg((F.abs(F.max("_amount")) - F.sum("_down")).alias("_left"))
    ranked = running_sums(placed.withColumn("_most", -F.col("_rest")), ["_group"], ["_most", "_key"], "_one", "_rank", "_n")
    dealt = ranked.join(left, F.col("_group") == F.col("_of")).select("_group", "_key", (F.signum("_amount").cast("long") * (F.col("_down") + (F.col("_rank") <= F.col("_left")).cast("long"))).alias(name))
    return members.join(dealt, (F.col(group) == F.col("_group")) & (F.col(key) == F.col("_key")), "left").drop("_group", "_key")
