"""Active days per unit over a trailing window (utilization input).

A day counts when its work_hour (drive/working + idle) is > 0; the count is
over *rows*, not distinct days.  Fact rows are reduced to one count per
(maker, unit key) with a partial (map-side) aggregate before they meet the
unit list, so a unit that owns a large share of the facts never reaches the
join as more than one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.numeric import lenient_double, round_half_up
from fleetlens.functions.temporal import day_of_prefix
from fleetlens.functions.text import trim_ws
from fleetlens.operators.units import CATERPILLAR, JOHN_DEERE, LIUGONG, MITSUBISHI, unit_table

SECONDS_PER_HOUR = 3600.0


def window_start(as_of: str | None, window_days: int) -> Column:
    base = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.date_sub(base, window_days)


def _present(c: Column) -> Column:
    return c.isNotNull() & (trim_ws(c) != F.lit(""))


def activity_facts(src) -> DataFrame:
    """(fact_maker, fact_key, day_text, _date, is_active): one row per daily row of every maker; active means work_hour > 0."""
    hour = F.lit(SECONDS_PER_HOUR)

    def pick(df, maker, key, text, day, work):
        return df.select(F.lit(maker).alias("fact_maker"), F.col(key).alias("fact_key"), F.col(text).alias("day_text"),
                         day.alias("_date"), (work > 0).alias("is_active"))
    fuso_work = (round_half_up(lenient_double("long_drive") / hour, 2) + round_half_up(lenient_double("long_idle") / hour, 2))
    jd = src.jd_measurement.where(F.col("_name") == F.lit("Machine Utilization"))
    jd_work = F.col("idle") / hour + F.col("working") / hour
    lg_work = lenient_double("working_hours") + lenient_double("idle_hours")
    cat_work = lenient_double("working_time_hours") + lenient_double("idle_time_hours")
    return (pick(src.fuso_daily_summary, MITSUBISHI, "imei", "_date", day_of_prefix("_date"), fuso_work)
            .unionByName(pick(jd, JOHN_DEERE, "serial_number", "intervalEndDate", F.col("intervalEndDate").cast("date"), jd_work))
            .unionByName(pick(src.liugong_work_hours, LIUGONG, "overall_unit_sn", "extract_date", F.col("extract_date").cast("date"), lg_work))
            .unionByName(pick(src.cat_asset_utilization, CATERPILLAR, "asset_serial_number", "extract_date",
                              F.col("extract_date").cast("date"), cat_work)))


def _in_window(since: Column) -> Column:
    """Rows since a day.  Day columns are text that starts with an ISO date (source contract), so the
    window's first day also bounds the text itself; that bound reaches the scans
    and skips row groups (or partitions) of older days.
    """
    return (F.col("day_text") >= F.date_format(since, "yyyy-MM-dd")) & (F.col("_date") >= since)


def daily_active_counts(src) -> DataFrame:
    """(fact_maker, fact_key, _date, active_rows): active rows of every unit and day.

    Days are closed once loaded, so this table can be stored by ``_date`` and
    extended by each new day; ``active_days`` then sums days instead of reading facts.
    """
    return activity_facts(src).where(F.col("_date").isNotNull()).groupBy("fact_maker", "fact_key", "_date") \
        .agg(F.count_if("is_active").alias("active_rows"))


def activity_units(src, units: DataFrame | None = None) -> DataFrame:
    """The unit table without blank ids, as the utilization report counts units."""
    return (unit_table(src) if units is None else units).where(_present(F.col("idNumber")))


def unit_catalog(src, units: DataFrame | None = None) -> DataFrame:
    """(idNumber, vehicleType, manufacture) of every unit the utilization
    report counts; no daily rows are read."""
    return activity_units(src, units).select("idNumber", "vehicleType", "manufacture")


def active_days(src, as_of: str | None = None, window_days: int = 30, units: DataFrame | None = None,
                counts: DataFrame | None = None) -> DataFrame:
    """(idNumber, vehicleName, vehicleType, manufacture, total_active_days) for all makers.

    The facts of all makers are counted in one aggregate by (maker, key), or,
    given stored ``counts`` (``daily_active_counts``), the days of the window are summed.
    """
    since = window_start(as_of, window_days)
    if counts is None:
        active = activity_facts(src).where(_in_window(since)).groupBy("fact_maker", "fact_key").agg(F.count_if("is_active").alias("active"))
    else:
        active = counts.where(F.col("_date") >= since).groupBy("fact_maker", "fact_key").agg(F.sum("active_rows").alias("active"))
    units = activity_units(src, units)
    joined = units.join(active, (units["manufacture"] == active["fact_maker"]) & (units["unit_key"] == active["fact_key"]), "left")
    return joined.groupBy("idNumber", "vehicleName", "vehicleType", "manufacture") \
        .agg(F.sum(F.coalesce("active", F.lit(0))).cast("bigint").alias("total_active_days"))
