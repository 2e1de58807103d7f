"""A candidate held against the frozen baseline: its losses, its targets and the columns that must not be empty."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.operators import calibrate
from popforge.sources.manifests import ManifestError, Scoring

#: What is measured, and whether less is better (else the two must be equal).
MEASURES: Mapping[str, bool] = {"initial_loss": True, "total_loss": True, "train_loss": True, "holdout_loss": True, "unweighted_msre": True, "n_national_targets": False, "n_state_targets": False, "n_targets_kept": False}


def baseline_figures(metrics: Mapping[str, float]) -> dict[str, float]:
    """The baseline's figure for each measure, whatever its manifest puts before the measure's name. A loss that is named
    for neither a split nor its state before the refit is the total."""
    out = {}
    for measure in MEASURES:
        found = [n for n in metrics if n.endswith(measure)]
        if measure == "initial_loss":
            found = [n for n in metrics if "initial" in n and n.endswith("loss")]
        elif measure == "total_loss":
            found = found or [n for n in metrics if n.endswith("loss") and not any(part in n for part in ("initial", "train", "holdout"))]
        if len(found) > 1:
            raise ManifestError(f"several figures for {measure}: {sorted(found)}")
        if found:
            out[measure] = float(metrics[found[0]])
    return out


def contributions(scored: DataFrame, delta: float = 1.0) -> DataFrame:
    """scored(bucket, residual, ...) with part: what each target adds to the total loss, the mean Huber loss of its bucket summed
    over buckets. Targets without a residual add nothing."""
    kept = scored.where("residual is not null")
    sizes = kept.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    return kept.join(sizes, "bucket").withColumn("part", calibrate.huber(F.col("residual"), delta) / F.col("_n")).drop("_n")


def measured(before: DataFrame, after: DataFrame, fraction: float, seed: int, delta: float = 1.0) -> DataFrame:
    """measure, candidate: figures of scored targets(target_id, bucket, geo_level, residual) before and after the refit. Train
    and hold-out losses add up to the total."""
    parts = contributions(after, delta).withColumn("held", calibrate.holdout("target_id", fraction, seed))
    part = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("part"))), F.lit(0.0))
    count = lambda condition: F.count_if(condition).cast("double")
    one = parts.agg(
        part(F.lit(True)).alias("total_loss"),
        part(~F.col("held")).alias("train_loss"),
        part(F.col("held")).alias("holdout_loss"),
        F.coalesce(F.avg(F.col("residual") * F.col("residual")), F.lit(0.0)).alias("unweighted_msre"),
        count(F.col("geo_level") == "national").alias("n_national_targets"),
        count(F.col("geo_level") == "state").alias("n_state_targets"),
        F.count(F.lit(1)).cast("double").alias("n_targets_kept"),
    )
    first = contributions(before, delta).agg(F.coalesce(F.sum("part"), F.lit(0.0)).alias("initial_loss"))
    both = one.crossJoin(F.broadcast(first))  # one row each
    return both.select(F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("candidate")) for m in MEASURES])).alias("r")).select("r.*")


def verdict(figures: DataFrame, profile: DataFrame, scoring: Scoring) -> DataFrame:
    """kind, name, baseline, candidate, delta, passed: of each measure that the baseline states, and of each column that must not
    be empty. A loss passes where it is at most the baseline's, a count where it is equal; a column where profile(column,
    abs_sum, finite, nonzero_count) shows it finite and not all zeros. What the candidate lacks fails."""
    spark = figures.sparkSession
    stated = [("measure", m, v, MEASURES[m]) for m, v in baseline_figures(scoring.metrics).items()]
    told = spark.createDataFrame(stated, "kind string, name string, baseline double, less boolean").join(figures.withColumnRenamed("measure", "name"), "name", "left")
    passed = F.when(F.col("less"), F.col("candidate") <= F.col("baseline")).otherwise(F.col("candidate") == F.col("baseline"))
    measures = told.select("kind", "name", "baseline", "candidate", (F.col("candidate") - F.col("baseline")).alias("delta"), F.coalesce(passed, F.lit(False)).alias("passed"))
    sums = [("column", c, float(x["abs_sum"])) for c, x in scoring.sanity.items()]
    asked = spark.createDataFrame(sums, "kind string, name string, baseline double").join(profile.withColumnRenamed("column", "name"), "name", "left")
    sound = F.coalesce(F.col("finite") & (F.col("nonzero_count") > 0), F.lit(False))
    columns = asked.select("kind", "name", "baseline", F.col("abs_sum").cast("double").alias("candidate"), (F.col("abs_sum") - F.col("baseline")).alias("delta"), sound.alias("passed"))
    return measures.unionByName(columns)
