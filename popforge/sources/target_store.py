"""The target store: a SQLite database of calibration targets, fingerprinted, read by ranges of row ids.

Registered as the Spark data source "target_store" by register(). Options: path, table, sha256 (the file must have it),
rows (most of a partition). A store is one small file, MOST_BYTES at most; each partition opens it in memory, so it may lie
in any store that executors reach.
"""

from __future__ import annotations

import hashlib
import sqlite3
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from popforge.sources import files
from popforge.sources.storage import fits

#: Bytes of a store, rows that write_store() takes, and rows of a partition, at most.
MOST_BYTES, MOST_ROWS, PART_ROWS = 1 << 28, 1_000_000, 50_000
_KINDS: Mapping[type[DataType], str] = {StringType: "TEXT", LongType: "INTEGER", IntegerType: "INTEGER", BooleanType: "INTEGER", DoubleType: "REAL", FloatType: "REAL"}


class StoreError(ValueError):
    """A target store that can't be used."""


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def opened(path: str, sha256: str | None = None) -> sqlite3.Connection:
    """The database in memory, once its hash is the one expected."""
    if not files.exists(path):
        raise StoreError(f"no target store at {path}")
    data = files.read_bytes(path)
    if len(data) > MOST_BYTES:
        raise StoreError(f"{path} has {len(data)} bytes; a target store has {MOST_BYTES} at most")
    found = hashlib.sha256(data).hexdigest()
    if sha256 is not None and found != sha256:
        raise StoreError(f"{path} has fingerprint {found}, not {sha256}")
    con = sqlite3.connect(":memory:")
    try:
        con.deserialize(data)
        con.execute("SELECT count(*) FROM sqlite_master")
    except sqlite3.DatabaseError as e:
        raise StoreError(f"{path} is no database: {e}") from e
    return con


@dataclass
class RowRange(InputPartition):
    first: int
    last: int


class StoreReader(DataSourceReader):
    def __init__(self, schema: StructType, options: Mapping[str, str]) -> None:
        self.columns, self.options = schema.fieldNames(), options
        self.bools = [isinstance(f.dataType, BooleanType) for f in schema.fields]

    def partitions(self) -> Sequence[InputPartition]:
        con = opened(self.options["path"], self.options.get("sha256"))
        low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.options['table'])}").fetchone()
        rows = int(self.options.get("rows", PART_ROWS))
        return [RowRange(a, min(a + rows - 1, high)) for a in range(low, high + 1, rows)] if low is not None else [RowRange(1, 0)]

    def read(self, part: RowRange) -> Iterator[tuple]:
        con = opened(self.options["path"], self.options.get("sha256"))
        names = ", ".join(map(_quoted, self.columns))
        found = con.execute(f"SELECT {names} FROM {_quoted(self.options['table'])} WHERE rowid BETWEEN ? AND ? ORDER BY rowid", (part.first, part.last))
        for row in found:
            yield tuple(bool(v) if b and v is not None else v for v, b in zip(row, self.bools, strict=True))


class TargetStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "target_store"

    def schema(self) -> StructType:
        con, table = opened(self.options["path"], self.options.get("sha256")), self.options["table"]
        columns = con.execute(f"PRAGMA table_info({_quoted(table)})").fetchall()
        if not columns:
            raise StoreError(f"{self.options['path']} has no table {table!r}")
        kinds = {"INTEGER": LongType(), "REAL": DoubleType(), "BOOLEAN": BooleanType()}
        return StructType([StructField(name, kinds.get(kind.upper(), StringType())) for _, name, kind, *_ in columns])

    def reader(self, schema: StructType) -> DataSourceReader:
        return StoreReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TargetStore)


def read_store(spark: SparkSession, path: str, table: str = "targets", sha256: str | None = None, rows: int | None = None) -> DataFrame:
    """A table of a target store. sha256: its fingerprint; another file is refused before anything is read from it."""
    register(spark)
    options = {"path": path, "table": table, "sha256": sha256, "rows": str(rows) if rows else None}
    return spark.read.format("target_store").options(**{k: v for k, v in options.items() if v is not None}).load()


def write_store(df: DataFrame, path: str, table: str = "targets") -> str:
    """A target store of the rows of df, in order of all columns, and its fingerprint. Targets are few: more than MOST_ROWS
    are refused."""
    if not fits(df, MOST_ROWS):
        raise StoreError(f"more than {MOST_ROWS} targets")
    kinds = []
    for f in df.schema.fields:
        if type(f.dataType) not in _KINDS:
            raise StoreError(f"{f.name}: no column of type {f.dataType.simpleString()}")
        kinds.append("BOOLEAN" if isinstance(f.dataType, BooleanType) else _KINDS[type(f.dataType)])
    con = sqlite3.connect(":memory:")
    con.execute(f"CREATE TABLE {_quoted(table)} ({', '.join(f'{_quoted(c)} {k}' for c, k in zip(df.columns, kinds, strict=True))})")
    con.executemany(f"INSERT INTO {_quoted(table)} VALUES ({', '.join('?' * len(df.columns))})", [tuple(r) for r in df.orderBy(*df.columns).collect()])
    con.commit()
    data = con.serialize()
    files.put_bytes(path, data)
    return hashlib.sha256(data).hexdigest()
