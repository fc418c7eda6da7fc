"""``queries()``: one callable per operator / report, (spark, sf_dir) -> DataFrame.

Every entry reads the driver tables of ``sf_dir`` through the adapters (the
nine fleet sources derived by Spark), so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.text import clean_user
from fleetlens.operators import fuel as fu
from fleetlens.operators import hours as hr
from fleetlens.operators.activity import active_days, daily_active_counts
from fleetlens.operators.latest import merge_latest
from fleetlens.operators.register import register_keys, register_latest
from fleetlens.operators.units import (
    CATERPILLAR, LIUGONG, cat_latest_assets, fleet_units, fuso_latest_devices, jd_latest_machines,
    liugong_latest_machines,
)
from fleetlens.plans import reports
from fleetlens.sources.adapters import AS_OF
from fleetlens.sources.catalog import FleetSources, derive_from_driver_tables

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[[FleetSources], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(derive_from_driver_tables(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _empty_to_null_date(src: FleetSources) -> DataFrame:
    d = fuso_latest_devices(src.fuso_devices)
    return d.select("imei", F.nullif(F.col("activation_date"), F.lit("")).cast("date").alias("activation_date"))


def _register_normalize(src: FleetSources) -> DataFrame:
    reg = register_latest(src.lark_fleet_master)
    cols = [F.col("equipment_serial_number"), F.col("manufacture")]
    for v in ("list", "utilization", "hours", "fuel"):
        rid, rmaker = register_keys(v)
        cols += [rid.alias(f"id_{v}"), rmaker.alias(f"maker_{v}")]
    return reg.select(*cols)


def _clean_user(src: FleetSources) -> DataFrame:
    reg = register_latest(src.lark_fleet_master)
    return reg.select("equipment_number", F.col("user"), clean_user("user").alias("department"))


def _fuso_daily_hours(src: FleetSources) -> DataFrame:
    return hr.fuso_daily_summary(src.fuso_daily_summary).withColumnRenamed("ds_imei", "imei")


def _jd_daily_hours(src: FleetSources) -> DataFrame:
    return hr.jd_machine_utilization(src.jd_measurement).select(
        F.col("mu_serial").alias("serialNumber"), F.col("mu_date").alias("_date"),
        F.col("mu_idle").alias("machine_utilization_idle"), F.col("mu_working").alias("machine_utilization_working"))


def _liugong_cat_daily_hours(src: FleetSources) -> DataFrame:
    lg = hr.liugong_daily(src.liugong_work_hours).select(
        F.lit(LIUGONG).alias("manufacture"), F.col("ld_serial").alias("serialNumber"), F.col("ld_date").alias("_date"),
        F.col("ld_work").alias("work_hour"), F.col("ld_idle").alias("idle_hour"))
    cat = hr.cat_daily(src.cat_asset_utilization).select(
        F.lit(CATERPILLAR).alias("manufacture"), F.col("cd_serial").alias("serialNumber"),
        F.col("cd_date").alias("_date"), F.col("cd_work").alias("work_hour"), F.col("cd_idle").alias("idle_hour"))
    return lg.unionByName(cat)


def _active_flag_rules(src: FleetSources) -> DataFrame:
    """Activity flags of every maker under the hours and the fuel rules."""
    hours_rows = hr.daily_hours(src).select(F.lit("hours").alias("rule"), "manufacture", "idNumber", "_date",
                                            "is_active_day")
    fa = fu.fuso_active(src.fuso_daily_summary).select(
        F.lit("fuel").alias("rule"), F.lit("MITSUBISHI").alias("manufacture"), F.col("imei").alias("idNumber"),
        "_date", "is_active_day")
    la = fu.liugong_active(src.liugong_work_hours).select(
        F.lit("fuel").alias("rule"), F.lit(LIUGONG).alias("manufacture"), F.col("serialNumber").alias("idNumber"),
        "_date", "is_active_day")
    jd = fu.jd_fuel_daily(src).select(F.lit("fuel").alias("rule"), "manufacture", "idNumber", "_date",
                                      "is_active_day")
    cat = fu.cat_fuel_allocation(src).select(F.lit("fuel").alias("rule"), "manufacture", "idNumber", "_date",
                                             "is_active_day")
    return hours_rows.unionByName(fa).unionByName(la).unionByName(jd).unionByName(cat)


def _work_idle_ratio(src: FleetSources) -> DataFrame:
    d = hr.daily_hours(src)
    wr, ir = hr.work_idle_ratio(F.col("work_hour"), F.col("idle_hour"))
    return d.select("idNumber", "manufacture", "_date", "work_hour", "idle_hour", "is_active_day",
                    wr.alias("work_ratio"), ir.alias("idle_ratio"))


def _impute_vehicle_master(src: FleetSources) -> DataFrame:
    return reports.hours_master(src)


def _latest_cat_merged(src: FleetSources) -> DataFrame:
    """The latest Caterpillar assets, loaded in three portions of the history, newest first."""
    rows = src.cat_asset_utilization
    day = F.substring("extract_date", 9, 2)
    stored = None
    for portion in (day >= "20", (day >= "10") & (day < "20"), (day < "10") | day.isNull()):
        stored = merge_latest(stored, rows.where(portion), ["asset_serial_number"], tiebreak=["model"])
    return stored.select("asset_serial_number", "model")


def _last_reading(src: FleetSources) -> DataFrame:
    return fu.last_reading_per_bucket(fu.fuel_readings_clean(src.fuso_fuel_reports))


def source_queries() -> dict[str, Callable[[FleetSources], DataFrame]]:
    """The registry over already-built fleet sources (tests, real tables)."""
    return {
        "latest_fuso_devices": lambda s: fuso_latest_devices(s.fuso_devices),
        "latest_jd_equipment": lambda s: jd_latest_machines(s.jd_equipment),
        "latest_liugong": lambda s: liugong_latest_machines(s.liugong_machines),
        "latest_cat": lambda s: cat_latest_assets(s.cat_asset_utilization),
        "empty_to_null_date": _empty_to_null_date,
        "register_latest_snapshot": lambda s: register_latest(s.lark_fleet_master),
        "register_normalize": _register_normalize,
        "clean_user_department": _clean_user,
        "fleet_units": fleet_units,
        "fleet_list": reports.fleet_list,
        "fuso_daily_hours": _fuso_daily_hours,
        "jd_daily_hours": _jd_daily_hours,
        "liugong_cat_daily_hours": _liugong_cat_daily_hours,
        "active_flag_rules": _active_flag_rules,
        "work_idle_ratio": _work_idle_ratio,
        "hours": reports.hours,
        "active_days_30d": lambda s: active_days(s, AS_OF),
        "active_days_by_day": lambda s: active_days(s, AS_OF, counts=daily_active_counts(s)),
        "latest_cat_merged": _latest_cat_merged,
        "impute_vehicle_master": _impute_vehicle_master,
        "impute_utilization_master": lambda s: reports.utilization_master(s),
        "impute_fuel_master": reports.fuel_master,
        "utilization": lambda s: reports.utilization(s, AS_OF),
        "fuel_readings_clean": lambda s: fu.fuel_readings_clean(s.fuso_fuel_reports),
        "half_hour_bucket": lambda s: fu.half_hour_buckets(s.fuso_fuel_reports),
        "last_reading_per_bucket": _last_reading,
        "fuel_delta": fu.fuso_fuel_steps,
        "fuso_fuel_daily": fu.fuso_fuel_daily,
        "jd_fuel_daily": fu.jd_fuel_daily,
        "liugong_fuel_daily": fu.liugong_fuel_daily,
        "cat_fuel_allocation": fu.cat_fuel_allocation,
        "fuel": reports.fuel,
    }


def queries() -> dict[str, Query]:
    """The registry over the driver tables of an ``sf_dir`` (via the adapters)."""
    return {k: _q(fn) for k, fn in source_queries().items()}
