"""The four reports, each returned as one DataFrame.

* ``fleet_list``  – register vs telemetry reconciliation
* ``utilization`` – units by active days in a trailing window
* ``hours``       – daily working / idle hours with efficiency ratios
* ``fuel``        – daily fuel split into idle and working

What several branches of a report read is written once under the checkpoint
directory while the report is built: the unit table (shared by all reports of
one ``FleetSources`` value), the enriched units of ``hours``, the enriched
unit-day rows of ``fuel``, and the rows of a daily report before their global
sort, which samples its input first.  So every source is scanned for one
purpose once, written tables give the planner exact sizes, and no unit list or register subquery is
planned twice.  A ``FleetSources`` value is a snapshot: read the tables
again for newer data.  ``materialize=False`` plans everything lazily instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.text import norm
from fleetlens.operators.activity import active_days, unit_catalog
from fleetlens.operators.enrich import attach_register, impute_from_master, vehicle_master
from fleetlens.operators.memo import per_source
from fleetlens.operators.fuel import fuel_daily
from fleetlens.operators.hours import daily_hours, work_idle_ratio
from fleetlens.operators.joins import grid_full_join
from fleetlens.operators.register import register_for
from fleetlens.operators.units import fleet_units, unit_table
from fleetlens.plans.materialize import write_and_read

# Reconciliation labels.
DATALAKE_ONLY = "Datalake Only"
LARK_ONLY = "Lark Only"
MATCHED = "Matched"


def _asc(*cols: str) -> list:
    return [F.col(c).asc_nulls_last() for c in cols]


@per_source
def shared_units(src) -> DataFrame:
    """The unit table of ``src``, written once for all its reports."""
    return write_and_read(unit_table(src), "units")


def _units(src, units: DataFrame | None, materialize: bool) -> DataFrame:
    return units if units is not None else shared_units(src) if materialize else unit_table(src)


def _register(src, variant: str, materialize: bool) -> DataFrame:
    reg = register_for(src.lark_fleet_master, variant)
    return write_and_read(reg, f"register-{variant}") if materialize else reg


def _in_order(rows: DataFrame, ordered: bool, materialize: bool, *order: Column) -> DataFrame:
    """``rows`` in a global order.

    Range partitioning samples its input in a job of its own; from written
    rows that reads a file instead of running the report twice.
    """
    if not ordered:
        return rows
    return (write_and_read(rows, "report-rows") if materialize else rows).orderBy(*order)


def fleet_list(src, ordered: bool = True, units: DataFrame | None = None, materialize: bool = True) -> DataFrame:
    """Register FULL OUTER JOIN telemetry units on normalized (id, maker).

    Many rows of both lists may share one id (blank ids, for one); those are
    joined over a grid (``grid_full_join``).
    """
    reg = register_for(src.lark_fleet_master, "list")
    units = fleet_units(src, _units(src, units, materialize))
    lf = reg.select(*[F.col(c).alias(f"lf_{c}") for c in reg.columns],
                    norm("idNumber").alias("lf_kid"), norm("manufacture").alias("lf_kmaker"))
    fu = units.select(*[F.col(c).alias(f"fu_{c}") for c in units.columns],
                      norm("idNumber").alias("fu_kid"), norm("manufacture").alias("fu_kmaker"))
    if materialize:
        lf = write_and_read(lf, "register-list")
    j = grid_full_join(lf, fu, ["lf_kid", "lf_kmaker"], ["fu_kid", "fu_kmaker"])
    out = j.select(
        F.col("lf_equipment_location").alias("equipment_location"),
        F.col("lf_model").alias("model"),
        F.col("lf_class").alias("class"),
        F.coalesce("lf_egi_equipment_description", "fu_vehicleType").alias("egi_equipment_description"),
        F.col("lf_user").alias("user"),
        F.coalesce("lf_idNumber", "fu_idNumber").alias("idNumber"),
        F.coalesce("fu_vehicleName", "lf_vehicleName").alias("vehicleName"),
        F.coalesce("fu_vehicleType", "lf_class").alias("vehicleType"),
        F.coalesce("fu_manufacture", "lf_manufacture").alias("manufacture"),
        F.when(F.col("lf_idNumber").isNull(), F.lit(DATALAKE_ONLY))
         .when(F.col("fu_idNumber").isNull(), F.lit(LARK_ONLY))
         .otherwise(F.lit(MATCHED)).alias("data_source"))
    return _in_order(out, ordered, materialize, *_asc("data_source", "manufacture", "idNumber"))


def _utilization_attrs(rows: DataFrame, register: DataFrame) -> DataFrame:
    joined = attach_register(rows, register)
    keep = [c for c in ("total_active_days",) if c in rows.columns]
    return joined.select(norm("manufacture").alias("manufacture"), norm("vehicleType").alias("vehicleType"),
                         "equipment_location", "egi_equipment_description", "model", "class", "user_company", *keep)


def utilization_rows(src, as_of: str | None = None, window_days: int = 30) -> DataFrame:
    """Units with active-day counts, register attributes, normalized maker/type."""
    return _utilization_attrs(active_days(src, as_of, window_days), register_for(src.lark_fleet_master, "utilization"))


def utilization_master(src, units: DataFrame | None = None, register: DataFrame | None = None) -> DataFrame:
    """Attribute master of the utilization report.

    MAX ignores multiplicity, so it only needs the set of (unit, maker,
    type) keys, which is the unit list itself: computed without the facts.
    """
    reg = register_for(src.lark_fleet_master, "utilization") if register is None else register
    return vehicle_master(_utilization_attrs(unit_catalog(src, units), reg))


def utilization(src, as_of: str | None = None, window_days: int = 30, threshold: int = 10,
                ordered: bool = True, units: DataFrame | None = None, counts: DataFrame | None = None,
                materialize: bool = True) -> DataFrame:
    """``counts``: stored ``daily_active_counts``, read instead of the facts."""
    units, reg = _units(src, units, materialize), _register(src, "utilization", materialize)
    joined = _utilization_attrs(active_days(src, as_of, window_days, units, counts), reg)
    full = impute_from_master(joined, utilization_master(src, units, reg))
    under = F.sum(F.when(F.col("total_active_days") < F.lit(threshold), F.lit(1)).otherwise(F.lit(0)))
    out = (full.groupBy(F.col("manufacture"), F.col("vehicleType"), F.col("equipment_location"),
                        F.coalesce("egi_equipment_description", "vm_egi_equipment_description")
                         .alias("equipment_description"),
                        F.coalesce("model", "vm_model").alias("model"),
                        F.coalesce("class", "vm_class").alias("class"),
                        F.col("user_company"))
               .agg(F.count(F.lit(1)).alias("total_unit"), under.cast("bigint").alias("total_underutilized_unit"))
               .withColumn("total_utilized_unit", F.col("total_unit") - F.col("total_underutilized_unit")))
    if ordered:
        out = out.orderBy(F.col("manufacture").asc_nulls_last(), F.col("total_underutilized_unit").desc_nulls_last())
    return out


def hours_units(src, units: DataFrame | None = None) -> DataFrame:
    """The units of the hours report with their register attributes."""
    return attach_register(unit_table(src) if units is None else units, register_for(src.lark_fleet_master, "hours"))


def hours_master(src, units: DataFrame | None = None) -> DataFrame:
    """Attribute master of the hours report: every unit has at least one row
    there, and MAX ignores multiplicity, so the unit list suffices."""
    return vehicle_master(hours_units(src) if units is None else units)


def hours(src, ordered: bool = True, units: DataFrame | None = None, materialize: bool = True) -> DataFrame:
    known = hours_units(src, _units(src, units, materialize))
    if materialize:
        known = write_and_read(known, "hours-register")
    known = impute_from_master(known, hours_master(src, known))
    if materialize:
        known = write_and_read(known, "hours-units")
    full = daily_hours(src, known)
    wr, ir = work_idle_ratio(F.col("work_hour"), F.col("idle_hour"))
    out = full.select(
        "idNumber", "vehicleName", "vehicleType", "manufacture", "_date", "work_hour", "idle_hour",
        "is_active_day", "equipment_location",
        F.coalesce("egi_equipment_description", "vm_egi_equipment_description").alias("equipment_description"),
        F.coalesce("model", "vm_model").alias("model"),
        F.coalesce("class", "vm_class").alias("class"),
        wr.alias("work_ratio"), ir.alias("idle_ratio"))
    return _in_order(out, ordered, materialize, *_asc("manufacture", "idNumber", "_date"))


def fuel_master(src) -> DataFrame:
    """Attribute master of the fuel report: raw maker and type of its enriched rows."""
    return vehicle_master(attach_register(fuel_daily(src), register_for(src.lark_fleet_master, "fuel")))


def fuel(src, fuel_max: float = 300.0, drop_cap: int = 50, bucket_minutes: int = 30,
         ordered: bool = True, units: DataFrame | None = None, materialize: bool = True) -> DataFrame:
    merged = fuel_daily(src, fuel_max, drop_cap, bucket_minutes, _units(src, units, materialize))
    joined = attach_register(merged, register_for(src.lark_fleet_master, "fuel"))
    # The unit set of this report comes from the fuel facts themselves, so the
    # master needs the enriched rows; they are written once (unit-day grain)
    # instead of recomputing the reading pipeline for the second reader.
    if materialize:
        joined = write_and_read(joined, "fuel_joined")
    full = impute_from_master(joined, vehicle_master(joined), normalized=True)
    out = full.select(
        "idNumber", "vehicleName", "vehicleType", "manufacture", "_date",
        "fuel_consumed_idle", "fuel_consumed_working", "fuel_consumed_transport", "fuel_consumed_total",
        "is_active_day", "equipment_location",
        F.coalesce("model", "vm_model").alias("model"),
        F.coalesce("class", "vm_class").alias("class"),
        F.coalesce("egi_equipment_description", "vm_egi_equipment_description").alias("equipment_description"),
        "user_company")
    return out.orderBy(*_asc("manufacture", "idNumber", "_date")) if ordered else out
