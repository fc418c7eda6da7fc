"""String rules used on unit ids, makers and the register's department field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters TRIM removes (the reports' dialect trims general
# whitespace, Spark's trim() only spaces).
TRIM_CHARS = " \t\r\n"

# Departments kept (upper-cased) when cleaning the register's
# user field; anything else becomes NULL except the exact text VACANT.
DEPARTMENTS = (
    "NURSERY", "WAREHOUSE", "WORKSHOP", "LOGISTIC",
    "AGRI", "CIVIL", "EHS", "FARMING", "HSE", "INFRA", "LC", "LD", "PLANTING", "R & D",
)
VACANT = "VACANT"

# Fixed value: marker in a register serial where the Caterpillar serial starts.
CAT_SERIAL_MARKER = "SYW"
CAT_PREFIX = "CAT"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_ws(col) -> Column:
    return F.btrim(_c(col), F.lit(TRIM_CHARS))


def norm(col) -> Column:
    """UPPER(TRIM(x)): the comparison form of ids and makers."""
    return F.upper(trim_ws(col))


def syw_tail(col) -> Column:
    """Suffix of ``col`` from the first ``SYW``; '' when absent, NULL for NULL."""
    c = _c(col)
    pos = F.instr(c, CAT_SERIAL_MARKER)
    return F.when(pos == 0, F.lit("")).otherwise(c.substr(pos, F.length(c)))


def cat_register_id(col) -> Column:
    """Register serial -> telemetry-style Caterpillar id (``CAT`` + SYW suffix)."""
    return F.concat(F.lit(CAT_PREFIX), syw_tail(col))


def clean_user(col) -> Column:
    """Dirty department text -> one of DEPARTMENTS, VACANT, or NULL."""
    c = _c(col)
    up = norm(c)
    return (F.when(up.isin(*DEPARTMENTS), up)
             .when(trim_ws(c) == F.lit(VACANT), F.lit(VACANT))
             .otherwise(F.lit(None).cast("string")))
