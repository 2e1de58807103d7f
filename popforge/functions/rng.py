"""Seeded uniforms that depend on keys only, never on partitioning or row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int | str, *keys: Column | str) -> Column:
    """A uniform in [0, 1) from the md5 of "seed:key[:key...]"; a null key counts as empty text."""
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    text = F.concat_ws(":", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
