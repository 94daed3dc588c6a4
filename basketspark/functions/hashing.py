"""Engine-independent hash buckets for seeded, repeatable splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(column: str, buckets: int, seed: int = 42) -> Column:
    """0..buckets-1 from the first eight hex digits of md5('<value>:<seed>')."""
    digest = F.md5(F.concat_ws(":", F.col(column).cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")
