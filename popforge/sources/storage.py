"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_OWN = "popforge.shared.dir"
#: Spark deletes the shuffle files of a job at its end with this, else whenever the driver happens to collect its garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local session, as in tests, gets a temporary folder; a cluster gets an
    error, since a machine's own folder hides one executor's files from the others."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN, None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="popforge-")
        spark.conf.set(_OWN, path)
    return path


@contextlib.contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """For a write: what it shuffles goes with its end, so that a query has the shuffle files of one table at a time."""
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)


def written(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder as Parquet and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/popforge-{uuid.uuid4().hex}"
    with _tidy(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def bucketed(df: DataFrame, column: str, buckets: int, deal: bool = False) -> DataFrame:
    """The frame written to the shared folder in buckets of a column, sorted within, and read back: joins and groupings by
    that column with other frames of as many buckets move no rows. deal: the frame isn't dealt by the column yet."""
    spark = df.sparkSession
    name = f"popforge_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    dealt = df.repartition(buckets, column) if deal else df
    with _tidy(spark):
        dealt.write.format("parquet").bucketBy(buckets, column).sortBy(column).option("path", path).saveAsTable(name)
    out = spark.table(name)
    out._written_to, out._table = path, name
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes the files of written() and bucketed() frames that nothing will read any more. Other frames are left alone."""
    for df in frames:
        if name := getattr(df, "_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        if path := getattr(df, "_written_to", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether a frame has at most max_rows rows; reads no more than that many and one."""
    return df.limit(max_rows + 1).count() <= max_rows
