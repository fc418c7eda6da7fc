"""Latest unit list per maker and the unified fleet unit list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import CAT_PREFIX
from fleetlens.operators.latest import latest_per_key
from fleetlens.operators.memo import per_source

# Maker names as the reports emit them.
MITSUBISHI = "MITSUBISHI"
JOHN_DEERE = "JOHN DEERE"
LIUGONG = "LIUGONG"
CATERPILLAR = "CATERPILLAR"


@per_source
def fuso_latest_devices(devices: DataFrame) -> DataFrame:
    """Newest snapshot per imei."""
    cols = ["imei", "chassis_number", "vehicle_name", "vehicle_type", "activation_date"]
    return latest_per_key(devices.select("extract_date", *cols), ["imei"], tiebreak=cols[1:]).select(*cols)


@per_source
def jd_latest_machines(equipment: DataFrame) -> DataFrame:
    """Newest telematics-capable record per serial, kept only if it is a Machine.

    The capability filter runs before ranking, the type filter after it.
    """
    capable = equipment.where(F.col("telematicsCapable") == F.lit("true"))
    latest = latest_per_key(capable.select("extract_date", "serialNumber", "_name", "fleet_type", "_type"),
                            ["serialNumber"], tiebreak=["_name", "fleet_type", "_type"])
    return latest.where(F.col("_type") == F.lit("Machine")).select("serialNumber", "_name", "fleet_type")


@per_source
def liugong_latest_machines(machines: DataFrame) -> DataFrame:
    cols = ["serialNumber", "productName", "equipmentModel"]
    return latest_per_key(machines.select("extract_date", *cols), ["serialNumber"], tiebreak=cols[1:]).select(*cols)


@per_source
def cat_latest_assets(assets: DataFrame) -> DataFrame:
    cols = ["asset_serial_number", "model"]
    return latest_per_key(assets.select("extract_date", *cols), ["asset_serial_number"],
                          tiebreak=["model"]).select(*cols)


def unit_table(src, cat_assets: DataFrame | None = None) -> DataFrame:
    """(manufacture, unit_key, idNumber, vehicleName, vehicleType): the latest record of every unit of every maker.

    ``unit_key`` is what the maker's facts call the unit.  The makers' records
    are ranked together, by (maker, key): one shuffle, cut to one row per
    key and task before it.  Ties go by the same columns as in the makers' own
    lists.  ``cat_assets`` (asset_serial_number, model), e.g. a stored
    dimension, takes the place of ranking the Caterpillar facts.
    """
    null_str = F.lit(None).cast("string")

    def pick(df, maker, key, id_c, name_c, type_c, extra=null_str, date="extract_date"):
        return df.select(F.lit(maker).alias("manufacture"), F.col(key).alias("unit_key"), F.col(date).alias("__date") if date else null_str.alias("__date"),
                         F.col(id_c).alias("idNumber"), name_c.alias("vehicleName"), F.col(type_c).alias("vehicleType"), extra.alias("__extra"))

    jd = src.jd_equipment.where(F.col("telematicsCapable") == F.lit("true"))
    cat = src.cat_asset_utilization if cat_assets is None else cat_assets
    records = (pick(src.fuso_devices, MITSUBISHI, "imei", "chassis_number", F.col("vehicle_name"), "vehicle_type", F.col("activation_date"))
               .unionByName(pick(jd, JOHN_DEERE, "serialNumber", "serialNumber", F.col("_name"), "fleet_type", F.col("_type")))
               .unionByName(pick(src.liugong_machines, LIUGONG, "serialNumber", "serialNumber", F.col("productName"), "equipmentModel"))
               .unionByName(pick(cat, CATERPILLAR, "asset_serial_number", "asset_serial_number", null_str, "model",
                                 date="extract_date" if cat_assets is None else None)))
    latest = latest_per_key(records, ["manufacture", "unit_key"], order="__date", tiebreak=["idNumber", "vehicleName", "vehicleType", "__extra"])
    machine = (F.col("manufacture") != F.lit(JOHN_DEERE)) | (F.col("__extra") == F.lit("Machine"))
    return latest.where(machine).select("manufacture", "unit_key", "idNumber", "vehicleName", "vehicleType")


def units_of(units: DataFrame, maker: str) -> DataFrame:
    """One maker's rows of a unit table."""
    return units.where(F.col("manufacture") == F.lit(maker))


def fleet_units(src, units: DataFrame | None = None) -> DataFrame:
    """All makers' latest units in one schema; Caterpillar ids get the CAT prefix."""
    units = unit_table(src) if units is None else units
    cat_id = F.concat(F.lit(CAT_PREFIX), F.col("idNumber"))
    return units.select(F.when(F.col("manufacture") == F.lit(CATERPILLAR), cat_id).otherwise(F.col("idNumber")).alias("idNumber"),
                        "vehicleName", "vehicleType", "manufacture")
