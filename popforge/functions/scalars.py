"""Row-level expressions that loaders and transforms share. All stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncated_int(c: Column | str) -> Column:
    """Integer part towards minus infinity, the same in every engine."""
    return F.floor(_col(c)).cast("int")


def to_boolean(c: Column | str) -> Column:
    """Non-zero as true; null as false."""
    return F.coalesce(_col(c) != 0, F.lit(False))


def indicator(c: Column | str, value) -> Column:
    """Whether the column equals a value; null is false."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))


def boolean_code(c: Column | str, if_true: int, if_false: int) -> Column:
    return F.when(_col(c), F.lit(if_true)).otherwise(F.lit(if_false))


def recode(c: Column | str, table: Mapping, default=None) -> Column:
    """Dictionary recode; values outside the table become the default."""
    out = None
    for key, value in table.items():
        out = F.when(_col(c) == F.lit(key), F.lit(value)) if out is None else out.when(_col(c) == F.lit(key), F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def first_existing(df: DataFrame, names: Iterable[str]) -> Column:
    """The first of the named columns that the frame has."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"none of {list(names)} in {df.columns}")


def horizontal_sum(columns: Iterable[Column | str]) -> Column:
    """Sum over columns, nulls as 0; of no columns 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_col(c).cast("double"), F.lit(0.0)) for c in columns], F.lit(0.0))


def matching_columns(df: DataFrame, part: str) -> list[str]:
    """Columns whose name contains a text."""
    return [c for c in df.columns if part in c]


def composite_key(*columns: Column | str) -> Column:
    return F.concat_ws("-", *[_col(c).cast("string") for c in columns])


def clipped(c: Column | str, low: float, high: float) -> Column:
    return F.least(F.greatest(_col(c), F.lit(low)), F.lit(high))


def zero_where(c: Column | str, mask: Column) -> Column:
    """0 where the mask holds, else the column."""
    return F.when(mask, F.lit(0.0)).otherwise(_col(c))


def fixed_width(c: Column | str, width: int) -> Column:
    """Digits left-padded with zeros. Longer values are kept whole, for the width gate to find."""
    text = _col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
