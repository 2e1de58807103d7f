"""Census geography: seeded assignment of blocks within the known area, fixed-width codes, derived places."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popforge.functions.rng import uniform
from popforge.functions.scalars import fixed_width
from popforge.operators.ranges import draw, shares
from popforge.sources.storage import written

#: Lengths of the codes, and of the block prefixes that give tract, county and state.
WIDTHS = {"block": 15, "tract": 11, "county": 5, "state": 2, "congressional_district": 4}


def intervals(units: DataFrame, area: str, unit: str, size: str | Column) -> DataFrame:
    """area, unit, low, high: each unit's share of its area's total as a half-open interval of [0, 1), in unit order.

    The last interval of an area ends above 1, so that rounding leaves no gap. Units of no size have no interval.
    """
    size = F.col(size) if isinstance(size, str) else size
    return shares(units.select(area, unit, size.alias("_size")), [area], unit, "_size")


def assign(records: DataFrame, key: str, area: str, shares: DataFrame, unit: str, seed: int) -> DataFrame:
    """Records with a unit drawn within their area, by size and a seeded uniform of their key: a join on area and the part
    of it that the uniform falls in. Areas without units give null."""
    return draw(records.withColumn("_u", uniform(seed, key)), "_u", [area], shares, unit).drop("_u")


def with_district(records: DataFrame, block: str, crosswalk: DataFrame, code: str = "congressional_district_geoid") -> DataFrame:
    """Records with the district of their block, from crosswalk(block_geoid, district), as a fixed-width code; null where
    the crosswalk lacks the block. A block in several districts takes the smallest."""
    side = crosswalk.groupBy(fixed_width("block_geoid", WIDTHS["block"]).alias("_block")).agg(F.min("district").alias("_district"))
    district = fixed_width("_district", WIDTHS["congressional_district"])
    return records.join(side, fixed_width(block, WIDTHS["block"]) == F.col("_block"), "left").withColumn(code, district).drop("_block", "_district")


def encode(block: str | Column, district: str | Column | None = None) -> dict[str, Column]:
    """Fixed-width codes by name: block, its prefixes, and the district where it is given (it is no block prefix)."""
    code = fixed_width(block, WIDTHS["block"])
    out = {"block_geoid": code} | {f"{level}_fips" if level != "tract" else "tract_geoid": F.substring(code, 1, WIDTHS[level]) for level in ("tract", "county", "state")}
    if district is not None:
        out["congressional_district_geoid"] = fixed_width(district, WIDTHS["congressional_district"])
    return out


def in_set(code: str | Column, members: Collection[str]) -> Column:
    """Whether a code is in a set of places; null is false."""
    return F.coalesce((F.col(code) if isinstance(code, str) else code).isin(*members), F.lit(False))


def width_violations(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """column, n_bad: values of another length than declared (nulls too)."""
    bad = df.agg(*[F.count_if(F.coalesce(F.length(c) != w, F.lit(True))).alias(c) for c, w in widths.items()])
    return bad.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_bad")) for c in widths])).alias("p")).select("p.*")


#: The level that holds every unit; it stands for records of which no area is known.
WHOLE = "all"


def level_intervals(units: DataFrame, block: str, size: str | Column, levels: Sequence[str] = ("county", "state")) -> DataFrame:
    """level, area, unit, low, high: each block's share of its area at every level, and of the whole.

    One pass: each block stands once for each of its prefixes, and all areas of all levels are summed together.
    """
    code = fixed_width(block, WIDTHS["block"])
    size = F.col(size) if isinstance(size, str) else size
    areas = [F.struct(F.lit(level).alias("level"), F.substring(code, 1, WIDTHS[level]).alias("area")) for level in levels]
    every = F.array(*areas, F.struct(F.lit(WHOLE).alias("level"), F.lit("").alias("area")))
    long = units.select(code.alias("unit"), size.alias("_size"), F.explode(every).alias("_in")).select("_in.level", "_in.area", "unit", "_size")
    return shares(long, ["level", "area"], "unit", "_size")


def assign_lowest(records: DataFrame, key: str, known: Mapping[str, str], shares: DataFrame, unit: str, seed: int) -> DataFrame:
    """Records with a unit drawn in the lowest area that is known of them, and the level that it was known at.

    known: level -> column of the records with the area's code there, from the lowest level up. A level counts where its
    code is known and holds units; a record without such a level draws from the whole. shares: of level_intervals().
    Without any units the unit is null.
    """
    shares = written(shares)
    areas = shares.select("level", "area").distinct()
    found, choices = records, []
    for level, column in known.items():
        there = areas.where(F.col("level") == level).select(F.col("area").alias(f"_in_{level}"))
        found = found.join(there, fixed_width(column, WIDTHS[level]) == F.col(f"_in_{level}"), "left")
        choices.append(F.when(F.col(f"_in_{level}").isNotNull(), F.struct(F.lit(level).alias("level"), F.col(f"_in_{level}").alias("area"))))
    choices.append(F.struct(F.lit(WHOLE).alias("level"), F.lit("").alias("area")))
    placed = found.withColumn("_lowest", F.coalesce(*choices)).select(*records.columns, F.col("_lowest.level").alias("_level"), F.col("_lowest.area").alias("_area"), uniform(seed, key).alias("_u"))
    here = shares.withColumnsRenamed({"level": "_level", "area": "_area", "unit": unit})
    drawn = draw(placed, "_u", ["_level", "_area"], here, unit)
    return drawn.select(*records.columns, unit, F.col("_level").alias(f"{unit}_known_at"))
