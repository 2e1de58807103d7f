"""Seeded take-up of programs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popforge.functions.rng import uniform


def takeup(key: str | Column, program: str, rate: float | Column, seed: int) -> Column:
    """True for a share `rate` of keys; draws of different programs are independent. A null rate is no take-up."""
    rate = F.lit(rate) if isinstance(rate, int | float) else rate
    return F.coalesce(uniform(f"{seed}:{program}", key) < rate, F.lit(False))


def rerandomize(df: DataFrame, key: str, rates: Mapping[str, float], seed: int) -> DataFrame:
    """A boolean column for each program, whatever the frame reported before."""
    return df.withColumns({program: takeup(key, program, rate, seed) for program, rate in rates.items()})


def group_rate(group: str | Column, rates: Mapping[str, float], otherwise: float = 0.0) -> Column:
    out = None
    group = F.col(group) if isinstance(group, str) else group
    for value, rate in rates.items():
        out = F.when(group == value, F.lit(rate)) if out is None else out.when(group == value, F.lit(rate))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))
