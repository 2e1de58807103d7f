"""Export gates: the column contract, sanity profiles and digests."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    """Frozen column lists. formula_owned columns are computed downstream and should not be persisted."""

    required: frozenset[str]
    optional: frozenset[str] = frozenset()
    forbidden: frozenset[str] = frozenset()
    formula_owned: frozenset[str] = frozenset()

    def __post_init__(self):
        if both := self.required & self.forbidden:
            raise ValueError(f"required and forbidden: {sorted(both)}")


@dataclass(frozen=True)
class Verdict:
    missing: tuple[str, ...]
    forbidden: tuple[str, ...]
    formula_owned: tuple[str, ...]
    unknown: tuple[str, ...]

    @property
    def passed(self) -> bool:
        return not self.missing and not self.forbidden


def check(columns: Iterable[str], contract: Contract) -> Verdict:
    """Missing and forbidden columns fail; formula-owned and unknown ones are only reported."""
    have = set(columns) - contract.optional
    known = contract.required | contract.forbidden | contract.formula_owned
    return Verdict(tuple(sorted(contract.required - have)), tuple(sorted(contract.forbidden & have)), tuple(sorted(contract.formula_owned & have)), tuple(sorted(have - known)))


def export_projection(df: DataFrame, contract: Contract) -> DataFrame:
    """The required columns in order of name; intermediate and forbidden ones are left behind."""
    verdict = check(df.columns, contract)
    if verdict.missing:
        raise ValueError(f"missing columns: {verdict.missing}")
    return df.select(*sorted(contract.required))


def status(candidate: DataFrame, contract: DataFrame) -> DataFrame:
    """column, status for columns of either frame: candidate(column), contract(column, list)."""
    both = contract.join(candidate.select("column", F.lit(True).alias("present")), "column", "full")
    present = F.coalesce("present", F.lit(False))
    verdict = (
        F.when((F.col("list") == "required") & ~present, "missing")
        .when(F.col("list") == "required", "ok")
        .when((F.col("list") == "forbidden") & present, "forbidden")
        .when((F.col("list") == "formula_owned") & present, "warn")
        .when(F.col("list") == "optional", "ignored")
        .when(F.col("list").isNull(), "unknown")
        .otherwise("absent")
    )
    return both.select("column", verdict.alias("status"))


def failing(candidate: DataFrame, contract: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Required columns of contract(column, list) that candidate(column) lacks, and forbidden ones that it has."""
    listed = lambda name: contract.where(F.col("list") == name).select("column")
    return listed("required").join(candidate, "column", "left_anti"), listed("forbidden").join(candidate, "column", "left_semi")


def sanity_profile(df: DataFrame, columns: Sequence[str], scale: int = 100) -> DataFrame:
    """column, abs_sum, finite, nonzero_count, passed. Absolute sums are taken over integers (value * scale, rounded
    down), so that they don't depend on the order of rows."""
    aggregates = []
    for c in columns:
        finite = ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
        aggregates += [
            (F.sum(F.when(finite, F.floor(F.abs(F.col(c)) * scale)).otherwise(0)).cast("double") / scale).alias(f"{c}__sum"),
            F.coalesce(F.bool_and(F.coalesce(finite, F.lit(False))), F.lit(False)).alias(f"{c}__finite"),
            F.count_if(F.col(c) != 0).alias(f"{c}__nonzero"),
        ]
    one = df.agg(*aggregates)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__sum").alias("abs_sum"), F.col(f"{c}__finite").alias("finite"), F.col(f"{c}__nonzero").alias("nonzero_count")) for c in columns])
    return one.select(F.explode(rows).alias("p")).select("p.*").withColumn("passed", F.col("finite") & (F.col("nonzero_count") > 0))


def name_digest(df: DataFrame, column: str, name: str = "digest") -> DataFrame:
    """sha256 over the distinct values, sorted and joined by line ends. For lists of names, which are short."""
    return df.select(column).distinct().agg(F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(column))), 256).alias(name))
