"""Daily working / idle hours per maker and the activity flag rules.

Two flag rules exist: *strict* (a NULL part makes the day inactive; the sum is
rounded before the test) and *lenient* (each part defaults to 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.numeric import lenient_double, round_half_up
from fleetlens.functions.temporal import day_of_prefix
from fleetlens.operators.joins import keep_left_join
from fleetlens.operators.units import CATERPILLAR, JOHN_DEERE, LIUGONG, MITSUBISHI, unit_table

SECONDS_PER_HOUR = 3600.0


def strict_active(a, b, digits: int | None) -> Column:
    """1 when ROUND(a + b, digits) > 0 (no rounding if digits is None); NULL -> 0."""
    s = a + b
    if digits is not None:
        s = round_half_up(s, digits)
    return F.when(s > 0, F.lit(1)).otherwise(F.lit(0))


def lenient_active(a, b) -> Column:
    """1 when COALESCE(a, 0) + COALESCE(b, 0) > 0."""
    return F.when(F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)) > 0, F.lit(1)).otherwise(F.lit(0))


def fuso_daily_summary(summary: DataFrame) -> DataFrame:
    """Per summary row: date, drive / idle hours (seconds / 3600, ROUND 2), distance."""
    return summary.select(
        day_of_prefix("_date").alias("date_record"),
        round_half_up(lenient_double("long_drive") / F.lit(SECONDS_PER_HOUR), 2).alias("long_drive"),
        round_half_up(lenient_double("long_idle") / F.lit(SECONDS_PER_HOUR), 2).alias("long_idle"),
        round_half_up(lenient_double("distance"), 2).alias("distance"),
        F.col("imei").alias("ds_imei"))


def jd_machine_utilization(measurement: DataFrame) -> DataFrame:
    """'Machine Utilization' rows summed per (serial, day), seconds -> hours.

    SUM(x) / 3600 equals the reports' SUM(x / 3600) and, with integral
    seconds, is exact whatever the summation order.
    """
    return (measurement.where(F.col("_name") == F.lit("Machine Utilization"))
            .groupBy(F.col("serial_number").alias("mu_serial"), F.col("intervalEndDate").cast("date").alias("mu_date"))
            .agg((F.sum("idle") / F.lit(SECONDS_PER_HOUR)).alias("mu_idle"),
                 (F.sum("working") / F.lit(SECONDS_PER_HOUR)).alias("mu_working")))


def liugong_daily(work_hours: DataFrame) -> DataFrame:
    return work_hours.select(F.col("overall_unit_sn").alias("ld_serial"),
                             F.col("extract_date").cast("date").alias("ld_date"),
                             lenient_double("working_hours").alias("ld_work"),
                             lenient_double("idle_hours").alias("ld_idle"))


def cat_daily(assets: DataFrame) -> DataFrame:
    return assets.select(F.col("asset_serial_number").alias("cd_serial"),
                         F.col("extract_date").cast("date").alias("cd_date"),
                         lenient_double("working_time_hours").alias("cd_work"),
                         lenient_double("idle_time_hours").alias("cd_idle"))


def hour_facts(src) -> DataFrame:
    """(fact_maker, fact_key, _date, work_hour, idle_hour, is_active_day): the daily rows of all makers, each under its flag rule."""
    def pick(df, maker, key, date, work, idle, active):
        w, i = F.col(work), F.col(idle)
        return df.select(F.lit(maker).alias("fact_maker"), F.col(key).alias("fact_key"), F.col(date).alias("_date"),
                         w.cast("double").alias("work_hour"), i.cast("double").alias("idle_hour"), active(w, i).alias("is_active_day"))
    return (pick(fuso_daily_summary(src.fuso_daily_summary), MITSUBISHI, "ds_imei", "date_record", "long_drive", "long_idle",
                 lambda w, i: strict_active(w, i, 2))
            .unionByName(pick(jd_machine_utilization(src.jd_measurement), JOHN_DEERE, "mu_serial", "mu_date", "mu_working", "mu_idle",
                              lambda w, i: strict_active(w, i, 4)))
            .unionByName(pick(liugong_daily(src.liugong_work_hours), LIUGONG, "ld_serial", "ld_date", "ld_work", "ld_idle", lenient_active))
            .unionByName(pick(cat_daily(src.cat_asset_utilization), CATERPILLAR, "cd_serial", "cd_date", "cd_work", "cd_idle", lenient_active)))


def hour_fact_keys(src) -> DataFrame:
    """(fact_maker, fact_key) of the daily rows, unaggregated; without Caterpillar, whose unit list comes from its facts."""
    def keys(df, maker, key):
        return df.select(F.lit(maker).alias("fact_maker"), F.col(key).alias("fact_key"))
    return (keys(src.fuso_daily_summary, MITSUBISHI, "imei")
            .unionByName(keys(src.jd_measurement.where(F.col("_name") == F.lit("Machine Utilization")), JOHN_DEERE, "serial_number"))
            .unionByName(keys(src.liugong_work_hours, LIUGONG, "overall_unit_sn")))


def daily_hours(src, units: DataFrame | None = None) -> DataFrame:
    """All makers' unit-day rows; units without any day appear once with NULL date.

    ``units`` may be a ``unit_table`` with more columns (register attributes),
    which the rows then carry: attributes join the unit list once, not every
    fact row.  All makers' rows meet the units in one join by (maker, key).
    """
    units = unit_table(src) if units is None else units
    carried = [c for c in units.columns if c != "unit_key"]
    derived = F.col("manufacture") == F.lit(CATERPILLAR)
    rows = keep_left_join(units, hour_facts(src), ["manufacture", "unit_key"], ["fact_maker", "fact_key"],
                          derived=derived, keys_from=hour_fact_keys(src))
    return rows.select(*carried, "_date", "work_hour", "idle_hour", F.coalesce("is_active_day", F.lit(0)).alias("is_active_day"))


def work_idle_ratio(work, idle) -> tuple[Column, Column]:
    """Work / idle share in percent (ROUND 2), only on active days with
    ROUND(work + idle, 4) > 0."""
    total = work + idle
    ok = (round_half_up(total, 4) > 0) & (F.col("is_active_day") == 1)
    wr = F.when(ok, round_half_up(F.try_divide(work, total) * F.lit(100.0), 2))
    ir = F.when(ok, round_half_up(F.try_divide(idle, total) * F.lit(100.0), 2))
    return wr, ir
