"""The driver's tables read as survey frames: customers as households, orders as persons, suppliers as donors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 20260529
SOURCES = {"cps": ("orders", "spine"), "households": ("customer", "donor"), "wealth": ("supplier", "donor"), "lines": ("lineitem", "donor"), "panel": ("events", "donor")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    """household_id, weight, nation, segment, balance."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("household_id"),
        (F.lit(1) + F.col("c_custkey") % 7).cast("double").alias("weight"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """person_id, household_id, age, income."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("person_id"),
        F.col("o_custkey").alias("household_id"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("age"),
        F.col("o_totalprice").alias("income"),
        F.col("o_orderstatus").alias("status"),
    )


def donors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """donor_id, nation, donor_balance, donor_weight."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("donor_id"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("donor_balance"),
        (F.lit(1) + F.col("s_suppkey") % 5).cast("long").alias("donor_weight"),
    )
