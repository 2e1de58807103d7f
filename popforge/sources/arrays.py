"""Datasets of named arrays: an uncompressed zip of .npy members, where arrays of one length are the columns of one table.

A survey comes as one such file: arrays as long as there are persons, and others as long as there are households. Members
lie uncompressed, so a partition reads its slice of each array that is asked for and nothing else. An exported population
is many such files, each a part of one entity, listed in a manifest that is put in place last and at once: readers see
the whole export or the one before it, whatever tasks or executors were lost.

Registered as the Spark data source "named_arrays" by register(). Reading, options: path (a file, or the folder of an
export), table (any array of the table that is meant; for an export the entity), columns (comma-separated; all if unset),
period (arrays are named column/period), rows (most of a partition), verify ("true": a part must have its listed sha256).
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from popforge.sources import files

MANIFEST = "MANIFEST.json"
#: Rows of a part that is written, and of a partition that is read.
PART_ROWS = 1 << 18
#: Marks the array that tells which rows of a column are there.
_THERE = "?"
_ARROW = {"b": pa.bool_(), "i1": pa.int8(), "i2": pa.int16(), "i4": pa.int32(), "i8": pa.int64(), "f4": pa.float32(), "f8": pa.float64()}


class ArraysError(ValueError):
    """A dataset that can't be read or written."""


@dataclass(frozen=True)
class Member:
    """One array of a file: where its bytes begin, its type and its length."""

    name: str
    at: int
    dtype: str
    length: int

    @property
    def type(self) -> pa.DataType:
        kind = np.dtype(self.dtype)
        if kind.kind in "SU":
            return pa.string()
        found = _ARROW.get("b" if kind.kind == "b" else f"{kind.kind}{kind.itemsize}")
        if found is None or kind.byteorder == ">":
            raise ArraysError(f"{self.name}: no column of type {self.dtype}")
        return found


def members(path: str, period: str | None = None) -> dict[str, Member]:
    """The one-dimensional arrays of a file by name, those of one period without it."""
    at, name = files.store(path)
    out = {}
    with at.open_input_file(name) as f, zipfile.ZipFile(f) as z:
        for info in z.infolist():
            if not info.filename.endswith(".npy"):
                continue
            column = info.filename.removesuffix(".npy")
            if period is not None:
                if not column.endswith(f"/{period}"):
                    continue
                column = column.removesuffix(f"/{period}")
            if info.compress_type != zipfile.ZIP_STORED:
                raise ArraysError(f"{path}: {column} is compressed")
            # the member's own header gives the lengths of its name and extra field
            f.seek(info.header_offset + 26)
            sizes = f.read(4)
            start = info.header_offset + 30 + int.from_bytes(sizes[:2], "little") + int.from_bytes(sizes[2:], "little")
            f.seek(start)
            version = np.lib.format.read_magic(f)
            read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
            shape, _, dtype = read(f)
            if dtype.hasobject or len(shape) != 1:
                raise ArraysError(f"{path}: {column} is no one-dimensional array of plain values")
            out[column] = Member(column, f.tell(), dtype.str, shape[0])
    return out


def table_of(found: Mapping[str, Member], table: str | None, columns: Sequence[str] | None) -> list[Member]:
    """Arrays as long as the one named, in the file's order; all have to be of one length where none is named."""
    if table is not None and table not in found:
        raise ArraysError(f"no array {table!r}")
    lengths = {m.length for m in found.values()}
    if table is None and len(lengths) > 1:
        raise ArraysError(f"arrays of lengths {sorted(lengths)}: name one of the table that is meant")
    own = {n: m for n, m in found.items() if table is None or m.length == found[table].length}
    if columns is None:
        return [m for n, m in own.items() if not n.startswith(_THERE)]
    if missing := [c for c in columns if c not in own]:
        raise ArraysError(f"no arrays {missing} in that table")
    return [own[c] for c in columns]


@dataclass
class Slice(InputPartition):
    path: str
    start: int
    end: int
    sha256: str | None = None


def _column(member: Member, data: bytes, there: np.ndarray | None) -> pa.Array:
    values = np.frombuffer(data, np.dtype(member.dtype))
    mask = None if there is None else ~there
    if values.dtype.kind == "S":
        texts = [v.decode("utf-8") for v in values.tolist()]
        return pa.array(texts, pa.string(), mask=mask)
    if values.dtype.kind == "U":
        return pa.array(values.tolist(), pa.string(), mask=mask)
    return pa.array(values, member.type, mask=mask)


class ArraysReader(DataSourceReader):
    def __init__(self, schema: StructType, options: Mapping[str, str]) -> None:
        self.columns, self.options = schema.fieldNames(), options

    def partitions(self) -> Sequence[InputPartition]:
        rows = int(self.options.get("rows", PART_ROWS))
        out = []
        for path, length, sha in _parts(self.options):
            out += [Slice(path, a, min(a + rows, length), sha) for a in range(0, length, rows)]
        return out or [Slice("", 0, 0)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        if part.end == part.start:
            return
        if part.sha256 is not None and files.sha256(part.path) != part.sha256:
            raise ArraysError(f"{part.path} is not the file that was exported")
        found = members(part.path, self.options.get("period"))
        at, name = files.store(part.path)
        with at.open_input_file(name) as f:

            def piece(m: Member) -> bytes:
                size = np.dtype(m.dtype).itemsize
                f.seek(m.at + part.start * size)
                return f.read((part.end - part.start) * size)

            arrays = []
            for column in self.columns:
                there = found.get(_THERE + column)
                arrays.append(_column(found[column], piece(found[column]), None if there is None else np.frombuffer(piece(there), bool)))
            yield pa.RecordBatch.from_arrays(arrays, names=self.columns)


def _options_columns(options: Mapping[str, str]) -> list[str] | None:
    return [c.strip() for c in options["columns"].split(",")] if options.get("columns") else None


def _is_export(path: str) -> bool:
    return not path.endswith(".npz")


def manifest(path: str) -> dict:
    """The manifest of an export; an error where none was completed."""
    if not files.exists(f"{path}/{MANIFEST}"):
        raise ArraysError(f"{path} holds no completed export")
    return json.loads(files.read_bytes(f"{path}/{MANIFEST}"))


def _parts(options: Mapping[str, str]) -> list[tuple[str, int, str | None]]:
    """Files of the table that is meant, with rows and, where it is to be verified, hash."""
    path = options["path"]
    if not _is_export(path):
        found = table_of(members(path, options.get("period")), options.get("table"), _options_columns(options))
        return [(path, found[0].length if found else 0, None)]
    entity = _entity(path, options)
    verify = options.get("verify", "false").lower() == "true"
    return [(f"{path}/{p['file']}", p["rows"], p["sha256"] if verify else None) for p in entity["parts"]]


def _entity(path: str, options: Mapping[str, str]) -> dict:
    entities = manifest(path)["entities"]
    if options.get("table") not in entities:
        raise ArraysError(f"{options.get('table')!r} is none of {sorted(entities)}")
    return entities[options["table"]]


class NamedArrays(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_arrays"

    def schema(self) -> StructType:
        path = self.options["path"]
        if _is_export(path):
            full = StructType.fromJson(_entity(path, self.options)["schema"])
            names = _options_columns(self.options)
            return full if names is None else StructType([full[n] for n in names])
        own = table_of(members(path, self.options.get("period")), self.options.get("table"), _options_columns(self.options))
        return from_arrow_schema(pa.schema([(m.name, m.type) for m in own]))

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArraysReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArraysWriter(schema, dict(self.options))


@dataclass
class Written(WriterCommitMessage):
    parts: list[dict]


class ArraysWriter(DataSourceArrowWriter):
    """Each task writes its parts into the run's folder and reports them; the driver lists them when all tasks are done.
    Nothing is visible to readers before publish()."""

    def __init__(self, schema: StructType, options: Mapping[str, str]) -> None:
        self.schema, self.options = schema, options
        self.folder = f"{options['path']}/{options['run']}/{options['entity']}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        held: list[pa.RecordBatch] = []
        size, parts = 0, []
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PART_ROWS:
                parts.append(self._part(held))
                held, size = [], 0
        if size:
            parts.append(self._part(held))
        return Written(parts)

    def _part(self, batches: list[pa.RecordBatch]) -> dict:
        table = pa.Table.from_batches(batches)
        data = packed({name: table.column(name).combine_chunks() for name in table.column_names})
        name = f"part-{uuid.uuid4().hex}.npz"
        files.put_bytes(f"{self.folder}/{name}", data)
        return {"file": f"{self.options['run']}/{self.options['entity']}/{name}", "rows": table.num_rows, "size_bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}

    def commit(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        parts = sorted((p for m in messages if m is not None for p in m.parts), key=lambda p: p["file"])
        files.put_bytes(f"{self.folder}.json", json.dumps({"schema": json.loads(self.schema.json()), "parts": parts}).encode())

    def abort(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        files.remove(self.folder)


def packed(columns: Mapping[str, pa.Array]) -> bytes:
    """A file of named arrays; columns with nulls have an array of which rows are there beside them."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, column in columns.items():
            arrays = {name: _values(name, column)}
            if column.null_count:
                arrays[_THERE + name] = np.asarray(column.is_valid())
            for key, values in arrays.items():
                member = io.BytesIO()
                np.lib.format.write_array(member, values, allow_pickle=False)
                z.writestr(f"{key}.npy", member.getvalue())
    return out.getvalue()


def _values(name: str, column: pa.Array) -> np.ndarray:
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        texts = [(t or "").encode("utf-8") for t in column.to_pylist()]
        if any(t.endswith(b"\0") for t in texts):
            raise ArraysError(f"{name}: a text that ends with a zero byte")
        return np.array(texts, dtype=f"S{max(map(len, texts), default=1) or 1}")
    if pa.types.is_boolean(column.type):
        return np.asarray(column.fill_null(False).to_numpy(zero_copy_only=False), bool)
    if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
        filled = column.fill_null(0)
        return filled.to_numpy(zero_copy_only=False)
    raise ArraysError(f"{name}: no array of type {column.type}")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedArrays)


def read_arrays(spark: SparkSession, path: str, table: str | None = None, columns: Sequence[str] | None = None, period: str | None = None, rows: int | None = None, verify: bool = False) -> DataFrame:
    """One table of a dataset of named arrays, read in slices."""
    register(spark)
    options = {"path": path, "table": table, "columns": ",".join(columns) if columns else None, "period": period, "rows": str(rows) if rows else None, "verify": str(verify).lower()}
    return spark.read.format("named_arrays").options(**{k: v for k, v in options.items() if v is not None}).load()


def export_population(frames: Mapping[str, DataFrame], path: str) -> dict:
    """All entities written as named arrays and made visible at once; the manifest. If any fails, nothing changes: readers
    go on seeing the export that was there before, and what was written is deleted.

    Files of earlier exports stay until clean() is called, so that readers of those are not cut off.
    """
    run = f"run-{uuid.uuid4().hex}"
    try:
        for entity, df in frames.items():
            register(df.sparkSession)
            df.write.format("named_arrays").option("path", path).option("run", run).option("entity", entity).mode("append").save()
        listed = {entity: json.loads(files.read_bytes(f"{path}/{run}/{entity}.json")) for entity in frames}
        found = {"run": run, "entities": {e: {**x, "rows": sum(p["rows"] for p in x["parts"]), "size_bytes": sum(p["size_bytes"] for p in x["parts"])} for e, x in listed.items()}}
        files.put_bytes(f"{path}/{MANIFEST}", json.dumps(found).encode())
    except BaseException:
        files.remove(f"{path}/{run}")
        raise
    return found


def clean(path: str) -> None:
    """Deletes the files of all runs but the one that readers see."""
    kept = manifest(path)["run"]
    for folder in files.folders(path):
        if folder.startswith("run-") and folder != kept:
            files.remove(f"{path}/{folder}")
