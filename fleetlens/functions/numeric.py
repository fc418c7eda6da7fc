"""Numeric parsing and rounding with the reports' semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(col, digits: int) -> Column:
    """ROUND(x, d) on DOUBLE as the reports' engine does it: half away from zero
    on the binary value, i.e. sign(x) * floor(|x| * 10^d + 0.5) / 10^d.

    Spark's round() goes through BigDecimal and rounds 1.005 up; this form
    rounds the IEEE value and is reproducible in plain SQL.
    """
    c = _c(col).cast("double")
    k = float(10 ** digits)
    rounded = F.signum(c) * F.floor(F.abs(c) * F.lit(k) + F.lit(0.5)).cast("double") / F.lit(k)
    # From 2^52 on a double has no fraction left to round (and floor() would leave BIGINT's range).
    return F.when(F.abs(c) * F.lit(k) >= F.lit(float(1 << 52)), c).otherwise(rounded)


def lenient_double(col) -> Column:
    """TRY_CAST(x AS DOUBLE): NULL for text that is not a number, 'NaN' included."""
    d = _c(col).try_cast("double")
    return F.when(~F.isnan(d), d)


def lenient_int(col) -> Column:
    """Text -> INTEGER, rounding numeric text half-up, NULL when not a number
    or out of INTEGER range."""
    return round_half_up(lenient_double(col), 0).try_cast("int")
