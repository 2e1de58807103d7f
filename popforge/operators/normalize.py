"""Block-driven normalisation: a raw survey frame becomes canonical person columns by declaration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.functions import scalars as S


@dataclass(frozen=True)
class Block:
    """What to do with a raw frame, in three stages: columns made of raw ones; copies, the sex code and sums of these;
    annualised and integer columns of both."""

    direct: Mapping[str, str] = field(default_factory=dict)  # canonical -> raw
    boolean: Mapping[str, str] = field(default_factory=dict)
    mapped: Mapping[str, tuple[str, Mapping]] = field(default_factory=dict)  # canonical -> (raw, table)
    fallback: Mapping[str, Sequence[str]] = field(default_factory=dict)  # canonical -> raw columns, first existing
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)  # canonical -> parts
    name_sums: Mapping[str, str] = field(default_factory=dict)  # canonical -> part of raw names
    constant: Mapping[str, object] = field(default_factory=dict)
    copy: Mapping[str, str] = field(default_factory=dict)  # canonical -> canonical
    sex_code: tuple[str, str, int, int] | None = None  # canonical, boolean source, code if true, if false
    sums: Mapping[str, Sequence[str]] = field(default_factory=dict)
    indicators: Mapping[str, tuple[str, object]] = field(default_factory=dict)
    integers: Sequence[str] = ()
    annualized: Sequence[str] = ()
    period: tuple[str, int | None] | None = None
    periods_a_year: float = 12.0


def normalize(raw: DataFrame, block: Block) -> DataFrame:
    """Canonical columns of a block, one projection a stage, so plans stay flat however many columns there are."""
    if block.period and block.period[1] is not None:
        raw = raw.where(F.col(block.period[0]) == block.period[1])
    first = {name: F.col(c) for name, c in block.direct.items()}
    first |= {name: S.to_boolean(c) for name, c in block.boolean.items()}
    first |= {name: S.recode(c, table) for name, (c, table) in block.mapped.items()}
    first |= {name: S.first_existing(raw, names) for name, names in block.fallback.items()}
    first |= {name: S.composite_key(*parts) for name, parts in block.keys.items()}
    first |= {name: S.horizontal_sum(S.matching_columns(raw, part)) for name, part in block.name_sums.items()}
    first |= {name: F.lit(value) for name, value in block.constant.items()}
    first |= {name: S.indicator(c, value) for name, (c, value) in block.indicators.items()}
    df = raw.select(*[c.alias(name) for name, c in first.items()])
    second = {name: F.col(c) for name, c in block.copy.items()}
    if block.sex_code:
        name, source, if_true, if_false = block.sex_code
        second[name] = S.boolean_code(source, if_true, if_false)
    second |= {name: S.horizontal_sum(columns) for name, columns in block.sums.items()}
    df = df.withColumns(second) if second else df
    last = {name: F.col(name) * F.lit(block.periods_a_year) for name in block.annualized}
    last |= {name: S.truncated_int(last.get(name, name)) for name in block.integers}
    return df.withColumns(last) if last else df


def split_entities(df: DataFrame, household_key: str, household: Sequence[str], person: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Household and person frames. A household takes its columns from its first person in the given order."""
    first = F.min(F.struct(*order, *[c for c in household if c not in order]))
    households = df.groupBy(household_key).agg(first.alias("_first")).select(household_key, *[F.col(f"_first.{c}").alias(c) for c in household])
    return households, df.select(household_key, *[c for c in person if c != household_key])


def with_defaults(df: DataFrame, defaults: Mapping[str, object], mark: str = "is_default_") -> DataFrame:
    """Nulls filled from declared defaults, each with a column that says where it was."""
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    return df.select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns], *[F.col(name).isNull().alias(f"{mark}{name}") for name in defaults])


def coverage_flags(df: DataFrame, sources: Mapping[str, Sequence[str]], insured: str, uninsured: str, multiple: str | None = None) -> DataFrame:
    """df with a flag for each kind of coverage (new name -> columns of which any counts), whether there is any, none, and
    more than one. Nulls are no coverage."""
    held = {name: F.exists(F.array(*[F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in columns]), lambda x: x) for name, columns in sources.items()}
    found = df.withColumns(held)
    n = S.horizontal_sum([F.col(name).cast("int") for name in sources])
    extra = {insured: n > 0, uninsured: n == 0} | ({multiple: n > 1} if multiple else {})
    return found.withColumns(extra)
