"""Paths, tables and small frame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popforge.sources.storage import discard, fits, shared_dir, written

__all__ = ["NO_ID", "crc_mod", "discard", "fits", "hash_sample", "likely", "map_rows", "mapped", "shared_dir", "table", "thinned", "written"]

#: Stands for a null id inside pandas, where a null would turn a batch's ids into floats.
NO_ID = -(1 << 63)
#: Bytes of rows that a Python worker gets at a time; a larger row comes alone.
BATCH_BYTES = 4 << 20
_BATCH_OPTION = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bits of a filter for each row that it stands for, and most of its 64-bit words, beyond which it lets more rows pass.
FILTER_BITS, FILTER_WORDS = 32, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, mod: int):
    """crc32 of an integer id written as text, modulo `mod`."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(mod))


def mapped(df: DataFrame, run, fields: str) -> DataFrame:
    """mapInPandas whose batches are bounded by bytes too, unless the session sets that bound itself: a batch of long
    texts would else take a worker's memory."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_OPTION, None) is None:
        conf.set(_BATCH_OPTION, BATCH_BYTES)
    return df.mapInPandas(run, fields)


def map_rows(df: DataFrame, run, fields: str, key: str = "doc_id") -> DataFrame:
    """mapped() with a long id column that may be null: ids come back exact, nulls as nulls."""
    filled = df.withColumn(key, F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)))
    out = mapped(filled, run, fields)
    return out.withColumn(key, F.nullif(F.col(key), F.lit(NO_ID))) if key in out.columns else out


def thinned(df: DataFrame, size: int, *columns: str) -> DataFrame:
    """The rows of df with the smallest hashes of the columns: size of them and some more, or all where there are fewer. A
    filter, so no partition sends `size` rows anywhere. Rows that are equal in the columns stay or go together."""
    n = df.count()
    rate = (size + 8 * size**0.5 + 20) / max(n, 1)
    return df if rate >= 1 else df.where(F.xxhash64(*columns) < F.lit(int(rate * 2.0**64) - (1 << 63)))


def hash_sample(df: DataFrame, size: int, key: str) -> DataFrame:
    """About `size` rows of df, one for each of the keys with the smallest hashes; partial aggregation takes the repeats."""
    return thinned(df, size, key).dropDuplicates([key])


def likely(df: DataFrame, hashes: DataFrame, n: int, column: str = "h") -> DataFrame:
    """The rows of df whose hash is among the n rows of hashes, and a few of the others: one bit a hash, broadcast, so that a
    join after it moves few rows that it doesn't keep. Both frames have the hash, a long, in `column`."""
    words = max(1, min(FILTER_WORDS, n * FILTER_BITS // 64))
    word, bit = F.pmod(F.shiftrightunsigned(column, 6), F.lit(words)), F.pmod(F.col(column), F.lit(64)).cast("int")
    set_ = hashes.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(words, np.int64)
    bits[set_["word"].to_numpy()] = set_["bits"].to_numpy()
    one = df.sparkSession.createDataFrame(pa.table({"filter_bits": pa.array([bits], pa.list_(pa.int64()))}))
    return df.join(F.broadcast(one), F.getbit(F.get("filter_bits", word.cast("int")), bit) == 1).drop("filter_bits")
