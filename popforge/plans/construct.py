"""From a specification to a calibrated population: spine, imputation, geography, transforms, calibration, export."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popforge.operators import calibrate, entities, gates, geography, impute, spine
from popforge.plans import spec as specs
from popforge.plans.proxy import donors, households, persons, table
from popforge.sources.storage import written

CONTENT = Path(__file__).resolve().parent.parent / "content"
#: Offset of clones' household ids, take-up rate, nations that make up the city, relative change of the loss that ends calibration.
CLONE_IDS, TAKEUP, CITY, TOL = 10_000_000, {"takes_up_benefit": 0.7}, (3, 5, 11), 1e-3


def contract(spec: specs.Spec) -> gates.Contract:
    """Every declared variable is required; what stages add for themselves is forbidden."""
    return gates.Contract(frozenset(spec.variables), forbidden=frozenset({"block", "half", "is_clone", "household_size"}))


def prepared(spark: SparkSession, sf_dir: str, spec: specs.Spec) -> DataFrame:
    """Households in both halves, counted, imputed by forests from the tax donors, with a block of their nation."""
    counted = entities.household_counts(persons(spark, sf_dir), "household_id", "age", {}).select("household_id", "household_size").distinct()
    homes = households(spark, sf_dir).select("household_id", "nation", "weight", F.when(F.col("balance") > 0, F.col("balance")).alias("balance"))
    homes = homes.join(counted, "household_id", "left").withColumn("household_size", F.coalesce("household_size", F.lit(0)))
    names = [name for name, _ in spec.halves]
    halves = spine.clone_spine(homes, ["nation", "household_size"], {"household_id": CLONE_IDS}, "weight")
    halves = halves.replace({spine.KEEP: names[0], spine.SYNTHETIC: names[1]}, subset=["half"])
    given = donors(spark, sf_dir).select("donor_id", "nation", (F.col("donor_id") % 5).alias("household_size"), F.col("donor_balance").alias("balance"), (F.col("donor_balance") < 0).alias("is_in_debt"), "donor_weight")
    steps = [impute.Step(s.onto, s.variables, s.synthesize, s.condition_on, s.order) for s in spec.imputation]
    filled = impute.forest_steps(halves, steps, impute.Donors(given, "donor_id", "donor_weight"), "household_id", {"demographics": ["nation", "household_size"]}, trees=10, depth=5, least=2, seed=spec.seed)
    blocks = geography.intervals(donors(spark, sf_dir).select("nation", F.col("donor_id").alias("block"), "donor_weight"), "nation", "block", "donor_weight")
    return geography.assign(filled, "household_id", "nation", blocks, "block", spec.seed)


def transformed(rows: DataFrame, spec: specs.Spec) -> DataFrame:
    """The declared variables; imputed ones stand as they are."""
    handlers = {"in_city": lambda p, seed: geography.in_set(F.col(str(p["depends_on"][0])), CITY)}
    made = [F.col(v.name) if v.kind == "impute" else specs.column_of(v, spec, handlers, TAKEUP, "household_id") for v in spec.variables.values()]
    return rows.select(*made)


def calibrated(rows: DataFrame, regions: DataFrame, settings: calibrate.Settings) -> DataFrame:
    """rows with weights calibrated to twice the households of each region and, by balance bracket, twice the dollars."""
    cells = rows.join(regions, "nation").withColumn("bracket", F.floor(F.col("balance") / 2500).cast("int"))
    matrix = calibrate.loss_matrix(cells, "household_id", {"region": (F.col("region"), F.lit(1.0)), "bracket": (F.col("bracket"), F.floor("balance").cast("double"))})
    weights = rows.select(F.col("household_id").alias("unit"), F.col("weight").alias("w"))
    targets = calibrate.estimates(matrix, weights.withColumn("w", F.lit(2.0))).select("target_id", F.substring_index("target_id", "/", 1).alias("bucket"), F.col("estimate").alias("value"))
    found, _ = calibrate.calibrate(matrix, weights, targets, settings)
    return rows.drop("weight").join(found.select(F.col("unit").alias("household_id"), F.col("w").alias("weight")), "household_id")


def construct(spark: SparkSession, sf_dir: str, settings: calibrate.Settings | None = None) -> DataFrame:
    """The exported households: every stage in turn, gated by the contract."""
    spec = specs.load((CONTENT / "proxy.yaml").read_text())
    rows = written(transformed(prepared(spark, sf_dir, spec), spec))
    regions = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    return gates.export_projection(calibrated(rows, regions, settings or calibrate.Settings(tol=TOL)), contract(spec))
