"""Where frames come from: registered datasets, loaders for raw survey layouts, fingerprints and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popforge.sources.storage import written

ROLES = ("spine", "donor")


@dataclass(frozen=True)
class Source:
    alias: str
    dataset: str
    role: str

    def __post_init__(self):
        if self.role not in ROLES:
            raise ValueError(f"{self.alias}: role {self.role!r} is none of {ROLES}")


@dataclass
class Registry:
    """Lazy datasets by alias. One source is the spine."""

    root: str
    sources: dict[str, Source] = field(default_factory=dict)

    @classmethod
    def of(cls, root: str, entries: Mapping[str, tuple[str, str]]) -> Registry:
        found = cls(root, {alias: Source(alias, dataset, role) for alias, (dataset, role) in entries.items()})
        if sum(s.role == "spine" for s in found.sources.values()) != 1:
            raise ValueError("one source must be the spine")
        return found

    def read(self, spark: SparkSession, alias: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{self.sources[alias].dataset}.parquet")

    def counts(self, spark: SparkSession) -> DataFrame:
        """alias, role, n_rows; counted from file footers."""
        parts = [self.read(spark, s.alias).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(s.alias).alias("alias"), F.lit(s.role).alias("role"), "n_rows") for s in self.sources.values()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def read_delimited(spark: SparkSession, path: str, schema: str, delimiter: str | None = None, usecols: Sequence[str] = ()) -> DataFrame:
    """A delimited file with a header row; delimiter None is a comma, no usecols is all columns."""
    df = spark.read.csv(path, sep=delimiter or ",", header=True, schema=schema, enforceSchema=False)
    return df.select(*usecols) if usecols else df


def for_period(df: DataFrame, period: Column | str, wanted: int | None) -> DataFrame:
    """Rows of one period; None keeps all."""
    if wanted is None:
        return df
    return df.where((F.col(period) if isinstance(period, str) else period) == wanted)


def household_rows(persons: DataFrame, households: DataFrame, person_household: str, household_key: str, columns: Mapping[str, str]) -> DataFrame:
    """Persons with household columns (new name -> household column) attached. Persons without a household keep nulls."""
    side = households.select(F.col(household_key).alias(person_household), *[F.col(c).alias(n) for n, c in columns.items()])
    return persons.join(side, person_household, "left")


def numbered(df: DataFrame, order: Sequence[str], name: str = "row_id", base: int = 1) -> DataFrame:
    """Consecutive ids in the order of a stable key, made without one task sorting everything.

    Rows are ranged over partitions, written with their place there, counted a partition, and numbered from each
    partition's offset. The partition counts are what one task sees. Order columns must tell rows apart for ids to be
    reproducible.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # monotonically_increasing_id is the partition number times 2**33 plus the row number in the partition
    placed = written(ranged.withColumn("_mono", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_mono", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    local = F.col("_mono").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, local + F.col("_before") + base).drop("_part", "_mono", "_before")


def single_person_households(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Each row as one household of one person: generated household_id, and person_id equal to it."""
    return numbered(df, order, "household_id").withColumn("person_id", F.col("household_id"))


@dataclass(frozen=True)
class Observation:
    """How one record type is read: key, weight and (raw, canonical) columns; a raw column may feed several."""

    entity: str
    key_column: str
    weight_column: str
    columns: tuple[tuple[str, str], ...]

    def apply(self, df: DataFrame) -> DataFrame:
        names = [self.key_column, self.weight_column, *[c for _, c in self.columns]]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.entity}: canonical names repeat")
        return df.select(self.key_column, self.weight_column, *[F.col(raw).alias(name) for raw, name in self.columns])


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, size_bytes of each file under a path."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))


def row_fingerprint(*columns: str) -> Column:
    """sha256 over a row's columns as text, joined by |; null is empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def export_entities(frames: Mapping[str, DataFrame], path: str) -> None:
    """One Parquet dataset an entity."""
    for entity, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path}/{entity}")
