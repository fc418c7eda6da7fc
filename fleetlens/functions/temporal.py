"""Date and time-bucket expressions (TIMESTAMP_NTZ / DATE only, zone-free)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of_prefix(col) -> Column:
    """CAST(SUBSTR(x, 1, 10) AS DATE): strict, like the source dialect."""
    return F.substring(_c(col), 1, 10).cast("date")


def to_ntz(col) -> Column:
    return _c(col).cast("timestamp_ntz")


def bucket_start(ts, minutes: int = 30) -> Column:
    """Start of the ``minutes``-wide bucket of the hour holding ``ts``.

    date_trunc('hour', ts) + minutes * floor(minute(ts) / minutes); integer
    division, so 10:47 lands in 10:30.  NULL stays NULL (its own bucket).
    """
    if 60 % minutes:
        raise ValueError("bucket width must divide an hour")
    t = _c(ts)
    m = F.floor(F.minute(t) / F.lit(minutes)).cast("int") * F.lit(minutes)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), m, F.lit(0))
