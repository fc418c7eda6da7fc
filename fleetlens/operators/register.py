"""The company's own fleet register (spreadsheet snapshots).

Each report keys the register slightly differently; ``register_keys`` holds
the four variants side by side so the differences stay visible:

* ``list`` / ``utilization``: the CAT test is on the raw maker text; other ids
  and makers stay raw.
* ``hours``: ids are UPPER(TRIM()) except CAT ids, whose test is still on the
  raw maker, while the maker itself is tested and emitted normalized.
* ``fuel``: both tests on the normalized maker; non-CAT ids normalized, CAT ids
  keep the raw serial suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import cat_register_id, clean_user, norm
from fleetlens.operators.latest import latest_snapshot
from fleetlens.operators.memo import per_source
from fleetlens.operators.units import CATERPILLAR

# Makers kept from the register (compared after UPPER(TRIM())).
REGISTER_MAKERS = ("MITSUBISHI", "JOHN DEERE", "LIUGONG", "CAT")
REGISTER_CAT = "CAT"

VARIANTS = ("list", "utilization", "hours", "fuel")


@per_source
def register_latest(register: DataFrame) -> DataFrame:
    """Rows of the newest register snapshot for the four telemetry makers."""
    return latest_snapshot(register).where(norm("manufacture").isin(*REGISTER_MAKERS))


def register_keys(variant: str) -> tuple[Column, Column]:
    """(idNumber, manufacture) expressions of one report's register key."""
    serial, maker = F.col("equipment_serial_number"), F.col("manufacture")
    raw_cat = maker == F.lit(REGISTER_CAT)
    norm_cat = norm(maker) == F.lit(REGISTER_CAT)
    if variant in ("list", "utilization"):
        return (F.when(raw_cat, cat_register_id(serial)).otherwise(serial),
                F.when(raw_cat, F.lit(CATERPILLAR)).otherwise(maker))
    if variant == "hours":
        return (F.when(raw_cat, cat_register_id(serial)).otherwise(norm(serial)),
                F.when(norm_cat, F.lit(CATERPILLAR)).otherwise(norm(maker)))
    if variant == "fuel":
        return (F.when(norm_cat, cat_register_id(serial)).otherwise(norm(serial)),
                F.when(norm_cat, F.lit(CATERPILLAR)).otherwise(norm(maker)))
    raise ValueError(f"unknown register variant {variant!r}")


@per_source
def register_for(register: DataFrame, variant: str) -> DataFrame:
    """The register as one report reads it (latest snapshot, keyed, its columns)."""
    rid, rmaker = register_keys(variant)
    reg = register_latest(register)
    attrs = [F.col("equipment_location"), F.col("egi_equipment_description"), F.col("model"), F.col("class")]
    if variant == "list":
        return reg.select(F.col("class"), F.col("equipment_location"), F.col("egi_equipment_description"),
                          F.col("equipment_number").alias("vehicleName"), rid.alias("idNumber"),
                          rmaker.alias("manufacture"), F.col("model"), F.col("number"),
                          clean_user("user").alias("user"))
    if variant == "utilization":
        return reg.select(rid.alias("idNumber"), rmaker.alias("manufacture"), *attrs,
                          F.col("user").alias("user_company"))
    if variant == "hours":
        return reg.select(rid.alias("idNumber"), rmaker.alias("manufacture"), *attrs)
    return reg.select(rid.alias("idNumber"), rmaker.alias("manufacture"), *attrs,
                      clean_user("user").alias("user_company"))
