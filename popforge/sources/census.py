"""The geography source: census blocks with their population and districts, checked before anything is drawn from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.functions.scalars import fixed_width
from popforge.operators import geography


class GeographyError(ValueError):
    """A crosswalk that can't be used."""


@dataclass(frozen=True)
class CensusSource:
    """Blocks with their size and, where it is known, their district. levels: those at which a record's area may be known,
    from the lowest up."""

    blocks: DataFrame
    block: str = "block_geoid"
    size: str = "population"
    district: str | None = None
    levels: tuple[str, ...] = ("county", "state")

    @property
    def codes(self) -> tuple[str, ...]:
        """Names of the codes that attach() gives."""
        return ("block_geoid", "tract_geoid", "county_fips", "state_fips", *(("congressional_district_geoid",) if self.district else ()))

    def violations(self) -> DataFrame:
        """column, n_bad: codes of the crosswalk that are missing or too long."""
        codes = self.blocks.select(fixed_width(self.block, geography.WIDTHS["block"]).alias("block"), *([fixed_width(self.district, geography.WIDTHS["congressional_district"]).alias("congressional_district")] if self.district else []))
        return geography.width_violations(codes, {c: geography.WIDTHS[c] for c in codes.columns})

    def checked(self) -> CensusSource:
        """Itself, or an error that names the codes of wrong width, blocks listed twice and negative sizes."""
        bad = [f"{r.n_bad} codes of {r.column}" for r in self.violations().where("n_bad > 0").collect()]
        twice = self.blocks.groupBy(self.block).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
        bad += [f"{twice} blocks listed twice"] * (twice > 0)
        negative = self.blocks.where(F.col(self.size) < 0).count()
        bad += [f"{negative} blocks of negative size"] * (negative > 0)
        if bad:
            raise GeographyError("; ".join(bad))
        return self

    def attach(self, records: DataFrame, key: str, known: Mapping[str, str], seed: int) -> DataFrame:
        """Records with a block drawn in the lowest area known of them, its codes, and `block_known_at`. Columns that known
        areas came in give way to the codes of the block; they agree with it wherever the block was drawn in them."""
        unknown = set(known) - set(self.levels)
        if unknown:
            raise GeographyError(f"no levels {sorted(unknown)}")
        shares = geography.level_intervals(self.blocks, self.block, self.size, self.levels)
        drawn = geography.assign_lowest(records, key, {level: known[level] for level in self.levels if level in known}, shares, "_unit", seed)
        codes = geography.encode("_unit")
        if self.district:
            crosswalk = self.blocks.select(F.col(self.block).alias("block_geoid"), F.col(self.district).alias("district"))
            drawn = geography.with_district(drawn, "_unit", crosswalk, "_district_geoid")
            codes["congressional_district_geoid"] = F.col("_district_geoid")
        kept = [c for c in records.columns if c not in codes]
        return drawn.select(*kept, *[c.alias(name) for name, c in codes.items()], F.col("_unit_known_at").alias("block_known_at"))
