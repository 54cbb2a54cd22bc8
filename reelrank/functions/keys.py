"""Key helpers for laying tables out by user."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_of(key, num_buckets: int) -> Column:
    """Stable hash bucket in [0, num_buckets) (for partitioning by a key)."""
    c = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(c), F.lit(num_buckets)).cast("int")
