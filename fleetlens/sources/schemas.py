"""Declared contracts of the nine fleet source tables.

The reports only ever read the columns listed here, so these are the schemas
we read with (no inference).  Raw numbers, dates and flags arrive as text
because the reports parse them leniently or strictly themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


FUSO_DEVICES = StructType(_strings(
    "extract_date", "imei", "chassis_number", "vehicle_name", "vehicle_type", "activation_date"))

FUSO_DAILY_SUMMARY = StructType(_strings("imei", "_date", "long_drive", "long_idle", "distance"))

FUSO_FUEL_REPORTS = StructType(
    [StructField("extract_date", DateType(), True)]
    + _strings("chassis_number", "_time", "fuelAverage", "odometer", "raw_current_voltage"))

JD_EQUIPMENT = StructType(_strings(
    "extract_date", "serialNumber", "_name", "fleet_type", "telematicsCapable", "_type"))

JD_MEASUREMENT = StructType(
    _strings("serial_number", "intervalEndDate", "_name")
    + [StructField(n, DoubleType(), True) for n in ("idle", "working", "transport")])

LIUGONG_MACHINES = StructType(_strings("extract_date", "serialNumber", "productName", "equipmentModel"))

LIUGONG_WORK_HOURS = StructType(_strings(
    "overall_unit_sn", "extract_date", "working_hours", "idle_hours",
    "avg_mileage_idle_oil_consume", "job_oil_consumes", "oil_consumes"))

CAT_ASSET_UTILIZATION = StructType(_strings(
    "asset_serial_number", "model", "extract_date", "working_time_hours", "idle_time_hours",
    "total_fuel_burned_liter"))

LARK_FLEET_MASTER = StructType(_strings(
    "extract_date", "class", "equipment_location", "egi_equipment_description", "equipment_number",
    "equipment_serial_number", "manufacture", "model", "number", "user"))

SCHEMAS: dict[str, StructType] = {
    "fuso_devices": FUSO_DEVICES,
    "fuso_daily_summary": FUSO_DAILY_SUMMARY,
    "fuso_fuel_reports": FUSO_FUEL_REPORTS,
    "jd_equipment": JD_EQUIPMENT,
    "jd_measurement": JD_MEASUREMENT,
    "liugong_machines": LIUGONG_MACHINES,
    "liugong_work_hours": LIUGONG_WORK_HOURS,
    "cat_asset_utilization": CAT_ASSET_UTILIZATION,
    "lark_fleet_master": LARK_FLEET_MASTER,
}


class SchemaError(ValueError):
    pass


def conform(df: DataFrame, schema: StructType, name: str = "") -> DataFrame:
    """Project ``df`` onto ``schema``: required columns, declared types, order.

    A missing column is an error, never a silent fallback (a missing ``user``
    column would otherwise resolve to the session user in SQL).
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise SchemaError(f"{name or 'table'} lacks columns {missing}")
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if df.schema[f.name].dataType != f.dataType:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)
