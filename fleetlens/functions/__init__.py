"""Column-expression helpers (all JVM built-ins, no UDFs)."""

from fleetlens.functions.numeric import lenient_double, lenient_int, round_half_up
from fleetlens.functions.temporal import bucket_start, day_of_prefix
from fleetlens.functions.text import cat_register_id, clean_user, norm, syw_tail, trim_ws

__all__ = [
    "bucket_start", "cat_register_id", "clean_user", "day_of_prefix", "lenient_double",
    "lenient_int", "norm", "round_half_up", "syw_tail", "trim_ws",
]
