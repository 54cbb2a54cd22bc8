"""Date and time column functions (built-ins only, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 for TIMESTAMP or TIMESTAMP_NTZ columns.

    NTZ values are read as UTC wall-clock time; TIMESTAMP values are instants.
    Neither depends on the session's zone. ``typeof`` is a constant of the
    plan, so only the branch of the column's type remains.
    """
    c = _col(ts)
    ntz = c.cast("timestamp_ntz")
    days = F.datediff(ntz.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    wall = days * 86400 + (F.hour(ntz) * 3600 + F.minute(ntz) * 60 + F.second(ntz)).cast("bigint")
    instant = F.unix_seconds(c.cast("timestamp"))
    return F.when(F.typeof(c) == "timestamp", instant).otherwise(wall)


def year_month(ts) -> Column:
    """yyyyMM as an int, e.g. 199801 (replaces the reference's date UDF)."""
    c = _col(ts)
    return F.year(c) * 100 + F.month(c)
