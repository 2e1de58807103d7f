"""The two-half population: every record kept once, and once more as a synthetic half with demographics only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.functions.rng import uniform

KEEP, SYNTHETIC = "keep", "synthetic"


def strip(df: DataFrame, demographics: Sequence[str]) -> DataFrame:
    """Only the demographic columns."""
    return df.select(*demographics)


def clone_spine(df: DataFrame, demographics: Sequence[str], ids: Mapping[str, int], weight: str | None = None) -> DataFrame:
    """Both halves of a frame: `half` and `is_clone` added, clone ids shifted by their offsets, weights halved.

    ids: id column -> offset, which must exceed every id there is, so that keys and links stay unique and consistent.
    A union of two narrow projections; nothing is shuffled.
    """
    halve = {weight: F.col(weight) / 2} if weight else {}
    kept = df.withColumns(halve | {"half": F.lit(KEEP), "is_clone": F.lit(False)})
    columns = list(dict.fromkeys([*demographics, *ids, *([weight] if weight else [])]))
    clone = strip(df, columns).withColumns(halve | {c: F.col(c) + F.lit(offset) for c, offset in ids.items()} | {"half": F.lit(SYNTHETIC), "is_clone": F.lit(True)})
    return kept.unionByName(clone, allowMissingColumns=True)


def split_spine(df: DataFrame, key: str, seed: int, share: float = 0.5) -> DataFrame:
    """Each record in one half, by a seeded draw on its key."""
    return df.withColumn("half", F.when(uniform(seed, key) < share, F.lit(KEEP)).otherwise(F.lit(SYNTHETIC)))


def collisions(spine: DataFrame, guarded: Sequence[str]) -> DataFrame:
    """variable, n: values that the synthetic half must not have inherited."""
    counts = spine.where(F.col("half") == SYNTHETIC).agg(*[F.count(c).alias(c) for c in guarded])
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("n")) for c in guarded])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")
