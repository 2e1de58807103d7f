"""The fully declared specification on the driver's tables: from declarations to six calibrated, exported entities."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popforge.operators import calibrate, entities, impute, spine
from popforge.plans import execute
from popforge.plans import spec as specs
from popforge.plans.proxy import donors, households, persons, table
from popforge.sources.census import CensusSource

CONTENT = Path(__file__).resolve().parent.parent / "content"
#: Offsets of clones' ids.
CLONES = {"household_id": 10_000_000, "person_id": 1_000_000_000}
#: Entities linked from persons, as the number of units that a household is cut into at most.
UNITS = {"family": 2, "spm_unit": 1, "tax_unit": 3, "marital_unit": 4}
RATES = {"takes_up_coverage": 0.6, "takes_up_meals": 0.8, "files_voluntarily": 0.25}
#: County suffixes of the stand-in blocks; those of one state make up the city.
COUNTIES = (5, 47, 61, 81, 85, 1, 3, 7)


def load() -> specs.Spec:
    return specs.load((CONTENT / "declared.yaml").read_text())


def _state(nation: str):
    return (F.lit(30) + F.col(nation) % 10).cast("string")


def _county(state, at):
    return F.concat(state, F.lpad(F.element_at(F.array(*map(F.lit, COUNTIES)), (at + 1).cast("int")).cast("string"), 3, "0"))


def census(spark: SparkSession, sf_dir: str) -> CensusSource:
    """Suppliers as blocks of their nation's state."""
    at = F.col("s_suppkey")
    digits = lambda x, n: F.lpad(x.cast("string"), n, "0")
    block = F.concat(_county(_state("s_nationkey"), at % 8), digits(at % 1_000_000, 6), digits(F.floor(at / 1_000_000), 4))
    blocks = table(spark, sf_dir, "supplier").select(block.alias("block_geoid"), (F.lit(1) + at % 5).alias("population"), F.concat(_state("s_nationkey"), digits(at % 7, 2)).alias("district"))
    return CensusSource(blocks, district="district")


def halves(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Six entities in both halves. A third of households know their county, though not all of those exist, a third their
    state only."""
    key = F.col("household_id")
    homes = households(spark, sf_dir).select(
        "household_id",
        F.col("weight").alias("household_weight"),
        "nation",
        "balance",
        F.when(key % 30 == 0, F.lit("99999")).when(key % 3 == 0, _county(_state("nation"), key % 8)).alias("known_county"),
        F.when(key % 3 != 2, _state("nation")).alias("known_state"),
    )
    people = persons(spark, sf_dir).select("person_id", "household_id", "age", "income", (F.col("status") == "F").alias("insured_at_interview"))
    home = spine.clone_spine(homes, ["nation", "known_county", "known_state"], {"household_id": CLONES["household_id"]}, "household_weight")
    own = spine.clone_spine(people, ["age"], CLONES)
    links = {f"person_{unit}_id": F.col("household_id") * 10 + F.col("person_id") % n for unit, n in UNITS.items()}
    own = own.withColumns(links | {"person_household_id": F.col("household_id")})
    tables = entities.entity_tables(own, {unit: f"person_{unit}_id" for unit in UNITS})
    return {"household": home, "person": own} | tables


def inputs(spark: SparkSession, sf_dir: str) -> execute.Inputs:
    frames = halves(spark, sf_dir)
    nation = donors(spark, sf_dir)
    tax = nation.select("donor_id", "nation", (F.col("donor_id") % 60).alias("age"), F.col("donor_balance").alias("capital_gains"), (F.col("donor_balance") < 0).alias("owes_tax"), "donor_weight")
    wealth = nation.select("donor_id", "nation", F.col("donor_balance").alias("net_worth"), "donor_weight")
    return execute.Inputs(
        frames,
        {entity: f"{entity}_id" for entity in frames},
        census(spark, sf_dir),
        {"county": "known_county", "state": "known_state"},
        {"tax": impute.Donors(tax, "donor_id", "donor_weight"), "wealth": impute.Donors(wealth, "donor_id", "donor_weight")},
        {"demographics": ["age", "nation"], "wealth": ["nation"]},
        RATES,
        forest={"trees": 10, "depth": 5, "least": 2},
    )


def calibrated(homes: DataFrame, settings: calibrate.Settings) -> DataFrame:
    """Households with weights calibrated to twice the households of each state."""
    key, weight = "household_id", "household_weight"
    matrix = calibrate.loss_matrix(homes, key, {"state": (F.col("state_fips"), F.lit(1.0))})
    weights = homes.select(F.col(key).alias("unit"), F.col(weight).alias("w"))
    targets = calibrate.estimates(matrix, weights.withColumn("w", F.lit(2.0))).select("target_id", F.lit("state").alias("bucket"), F.col("estimate").alias("value"))
    found, _ = calibrate.calibrate(matrix, weights, targets, settings)
    return homes.drop(weight).join(found.select(F.col("unit").alias(key), F.col("w").alias(weight)), key)


def construct(spark: SparkSession, sf_dir: str, settings: calibrate.Settings | None = None) -> dict[str, DataFrame]:
    """entity -> exported frame: halves, geography, imputation, transforms and calibration in the order that they need."""
    made = execute.execute(load(), inputs(spark, sf_dir))
    return made | {"household": calibrated(made["household"], settings or calibrate.Settings())}
