"""The flagship plan: from households to the relative error of every target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popforge.operators import calibrate, entities, spine
from popforge.plans.proxy import households, persons, table


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """target_id, estimate, value, residual: a cloned spine's weighted totals by region and income bracket against the
    totals of an evenly weighted one."""
    homes = spine.clone_spine(households(spark, sf_dir), ["household_id", "nation"], {"household_id": 10_000_000}, "weight")
    people = spine.clone_spine(persons(spark, sf_dir), ["age", "income"], {"person_id": 100_000_000, "household_id": 10_000_000})
    counted = entities.household_counts(people, "household_id", "age", {"count_under_18": 18})
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    units = counted.join(homes.select("household_id", "nation", "weight"), "household_id").join(nations, "nation")
    units = units.withColumn("bracket", F.floor(F.col("income") / 50_000).cast("int"))
    matrix = calibrate.loss_matrix(units, "person_id", {"region": (F.col("region"), F.lit(1.0)), "bracket": (F.col("bracket"), F.floor("income").cast("double")), "children": (F.col("region"), F.col("count_under_18").cast("double"))})
    weights = units.select(F.col("person_id").alias("unit"), F.col("weight").alias("w"))
    targets = calibrate.estimates(matrix, weights.withColumn("w", F.lit(2.0))).withColumnRenamed("estimate", "value")
    found = calibrate.estimates(matrix, weights).join(targets, "target_id")
    return found.withColumn("residual", calibrate.relative_error(F.col("estimate"), F.col("value")))
