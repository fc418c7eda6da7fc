"""Daily fuel use per unit, split into idle and working.

MITSUBISHI has only raw fuel-level readings, so its fuel comes from a time
series:

1. clean   – keep 0 <= level <= fuel_max and voltage > 0, parse, bucket
2. reduce  – last reading per (chassis, half hour); a chassis therefore has
             at most 48 rows per day whatever its raw reading rate, which
             bounds every later window partition by calendar time
3. delta   – LAG over the chassis' buckets; a drop below ``drop_cap`` litres
             is fuel used, rises (refuel) and bigger jumps count 0
4. split   – used fuel with no odometer movement is idle fuel
5. daily   – per chassis-day sums, reduced *before* they meet the device list
             and the activity table, with row multiplicities carried as counts

The other makers report fuel directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.numeric import lenient_double, lenient_int, round_half_up
from fleetlens.functions.temporal import bucket_start, day_of_prefix, to_ntz
from fleetlens.functions.text import CAT_PREFIX, norm
from fleetlens.operators.hours import SECONDS_PER_HOUR, lenient_active
from fleetlens.operators.joins import self_dim_left_join, split_inner_join
from fleetlens.operators.latest import latest_per_key
from fleetlens.operators.units import CATERPILLAR, JOHN_DEERE, LIUGONG, MITSUBISHI, unit_table, units_of


def fuel_readings_clean(reports: DataFrame, fuel_max: float = 300.0, bucket_minutes: int = 30) -> DataFrame:
    fuel = lenient_double("fuelAverage")
    volt = lenient_double("raw_current_voltage")
    valid = (fuel >= 0) & (fuel <= F.lit(fuel_max)) & (volt > 0) & ~F.isnan(volt)
    return reports.where(valid).select(
        "extract_date", "chassis_number", "_time",
        lenient_int("fuelAverage").alias("fuelLevel"),
        lenient_int("odometer").alias("odometer"),
        bucket_start(to_ntz("_time"), bucket_minutes).alias("window_start"))


def half_hour_buckets(reports: DataFrame, bucket_minutes: int = 30) -> DataFrame:
    return reports.select("chassis_number", "_time",
                          bucket_start(to_ntz("_time"), bucket_minutes).alias("window_start"))


def last_reading_per_bucket(clean: DataFrame) -> DataFrame:
    """Newest reading per (chassis, bucket) (top-1, partial limit before the shuffle)."""
    cols = clean.columns
    keyed = clean.withColumn("__ts", to_ntz("_time"))
    return latest_per_key(keyed, ["chassis_number", "window_start"], order="__ts",
                          tiebreak=["fuelLevel", "odometer", "extract_date", "_time"]).select(*cols)


def fuel_delta(bucketed: DataFrame, drop_cap: int = 50) -> DataFrame:
    w = Window.partitionBy("chassis_number").orderBy(F.col("window_start").asc_nulls_last())
    lagged = bucketed.select(
        "extract_date", "chassis_number", "window_start", "_time",
        "fuelLevel", F.lag("fuelLevel").over(w).alias("prev_fuel_level"),
        "odometer", F.lag("odometer").over(w).alias("prev_odometer"))
    prev, cur = F.col("prev_fuel_level"), F.col("fuelLevel")
    prev_odo, odo = F.col("prev_odometer"), F.col("odometer")
    used = F.when(prev.isNotNull() & (cur < prev) & ((prev - cur) < F.lit(drop_cap)), prev - cur).otherwise(F.lit(0))
    trip = F.when(prev_odo.isNotNull() & (odo > prev_odo), odo - prev_odo).otherwise(F.lit(0))
    step = lagged.select(
        F.col("extract_date").alias("_date"), F.col("chassis_number").alias("idNumber"), "window_start", "_time",
        "prev_fuel_level", "fuelLevel", used.alias("fuel_used_liters"), "prev_odometer", "odometer",
        trip.alias("trip_meter"))
    idle = F.when((F.col("fuel_used_liters") > 0) & (F.col("trip_meter") == 0),
                  F.col("fuel_used_liters")).otherwise(F.lit(0))
    return step.withColumn("idle_fuel_consumption", idle)


def fuso_fuel_steps(src, fuel_max: float = 300.0, drop_cap: int = 50, bucket_minutes: int = 30) -> DataFrame:
    clean = fuel_readings_clean(src.fuso_fuel_reports, fuel_max, bucket_minutes)
    return fuel_delta(last_reading_per_bucket(clean), drop_cap)


def fuso_active(summary: DataFrame) -> DataFrame:
    hour = F.lit(SECONDS_PER_HOUR)
    s = (round_half_up(lenient_double("long_drive") / hour, 2)
         + round_half_up(lenient_double("long_idle") / hour, 2))
    return summary.select("imei", day_of_prefix("_date").alias("_date"),
                          F.when(s > 0, F.lit(1)).otherwise(F.lit(0)).alias("is_active_day"))


def _fuel_row(id_c, name_c, type_c, maker: str, date_c, idle_c, work_c, transport_c, total_c,
              active_c) -> list[Column]:
    return [id_c.alias("idNumber"), name_c.alias("vehicleName"), type_c.alias("vehicleType"),
            F.lit(maker).alias("manufacture"), date_c.alias("_date"),
            idle_c.cast("double").alias("fuel_consumed_idle"), work_c.cast("double").alias("fuel_consumed_working"),
            transport_c.cast("double").alias("fuel_consumed_transport"),
            total_c.cast("double").alias("fuel_consumed_total"), active_c.cast("int").alias("is_active_day")]


def _units(src, units: DataFrame | None, maker: str) -> DataFrame:
    return units_of(unit_table(src) if units is None else units, maker)


def fuso_fuel_daily(src, fuel_max: float = 300.0, drop_cap: int = 50, bucket_minutes: int = 30,
                    units: DataFrame | None = None) -> DataFrame:
    """Per (chassis, device name, device type, day): idle, working, total litres.

    Every reading row is joined to each device whose chassis matches after
    UPPER(TRIM()) and to each of that device's activity rows of the day, and
    the litres are summed over those joined rows.  We get the same sums
    without materializing the product: readings are summed per chassis-day
    first, activity rows are counted per (imei, day), and each chassis-day
    sum is weighted by its device's activity-row count.
    """
    steps = fuso_fuel_steps(src, fuel_max, drop_cap, bucket_minutes)
    per_day = (steps.groupBy(F.col("idNumber").alias("f_id"), F.col("_date").alias("f_date"))
                    .agg(F.sum("fuel_used_liters").alias("f_used"), F.sum("idle_fuel_consumption").alias("f_idle"))
                    .withColumn("f_key", norm("f_id")))
    dev = _units(src, units, MITSUBISHI).select(
        F.col("unit_key").alias("d_imei"), norm("idNumber").alias("d_key"), F.col("vehicleName").alias("vehicle_name"),
        F.col("vehicleType").alias("vehicle_type"))
    act = (fuso_active(src.fuso_daily_summary)
           .groupBy(F.col("imei").alias("a_imei"), F.col("_date").alias("a_date"))
           .agg(F.count(F.lit(1)).alias("a_rows"), F.max("is_active_day").alias("a_active")))
    with_dev = per_day.join(dev, per_day["f_key"] == dev["d_key"], "left")
    with_act = with_dev.join(act, (with_dev["d_imei"] == act["a_imei"]) & (with_dev["f_date"] == act["a_date"]),
                             "left")
    weight = F.coalesce(F.col("a_rows"), F.lit(1))
    daily = (with_act.groupBy("f_id", "vehicle_name", "vehicle_type", "f_date")
                     .agg(F.sum(F.col("f_used") * weight).alias("used"),
                          F.sum(F.col("f_idle") * weight).alias("idle"),
                          F.coalesce(F.max("a_active"), F.lit(0)).alias("active")))
    idle = round_half_up(F.col("idle"), 2)
    total = round_half_up(F.col("used"), 2)
    return daily.select(*_fuel_row(F.col("f_id"), F.col("vehicle_name"), F.col("vehicle_type"), MITSUBISHI,
                                   F.col("f_date"), idle, total - idle, F.lit(None), total, F.col("active")))


def jd_fuel_daily(src, units: DataFrame | None = None) -> DataFrame:
    """Latest machines with their 'Fuel Consumed' days (kept without fuel, NULL day).

    Fuel and activity come from the same long table; one pass groups it by
    (serial, day) with metric-conditional sums, instead of one scan and one
    shuffle per metric.  A day exists on the fuel side only if it has a
    'Fuel Consumed' row; its flag is 1 when its 'Machine Utilization'
    seconds sum to > 0 (0 when it has none, or when the day is NULL).
    """
    m = src.jd_measurement
    hour = F.lit(SECONDS_PER_HOUR)
    is_fuel = F.col("_name") == F.lit("Fuel Consumed")
    is_util = F.col("_name") == F.lit("Machine Utilization")
    per_day = (m.where(is_fuel | is_util)
                .groupBy(F.col("serial_number").alias("fc_serial"),
                         F.col("intervalEndDate").cast("date").alias("fc_date"))
                .agg(F.count_if(is_fuel).alias("fc_rows"),
                     (F.sum(F.when(is_fuel, F.col("idle"))) / hour).alias("fc_idle"),
                     (F.sum(F.when(is_fuel, F.col("working"))) / hour).alias("fc_working"),
                     (F.sum(F.when(is_fuel, F.col("transport"))) / hour).alias("fc_transport"),
                     F.sum(F.when(is_util, F.col("idle") + F.col("working"))).alias("mu_seconds")))
    fuel = (per_day.where(F.col("fc_rows") > 0)
                   .withColumn("fc_total", F.col("fc_idle") + F.col("fc_working"))
                   # a NULL day never equals the activity side's day: flag 0
                   .withColumn("fc_active", F.when(F.col("fc_date").isNotNull() & (F.col("mu_seconds") / hour > 0),
                                                   F.lit(1)).otherwise(F.lit(0))))
    eq = _units(src, units, JOHN_DEERE)
    # one row per (serial, day) on the right: a unit adds at most a row per day
    rows = eq.join(fuel, eq["unit_key"] == fuel["fc_serial"], "left")
    return rows.select(*_fuel_row(F.col("unit_key"), F.col("vehicleName"), F.col("vehicleType"), JOHN_DEERE,
                                  F.col("fc_date"), F.col("fc_idle"), F.col("fc_working"), F.col("fc_transport"),
                                  F.col("fc_total"), F.coalesce(F.col("fc_active"), F.lit(0))))


def liugong_active(work_hours: DataFrame) -> DataFrame:
    s = lenient_double("working_hours") + lenient_double("idle_hours")
    return work_hours.select(F.col("overall_unit_sn").alias("serialNumber"),
                             F.col("extract_date").cast("date").alias("_date"),
                             F.when(s > 0, F.lit(1)).otherwise(F.lit(0)).alias("is_active_day"))


def liugong_fuel_daily(src, units: DataFrame | None = None) -> DataFrame:
    """Every work-hours row with the machine list's name and model, and its unit-day's activity flag.

    The flag of a unit-day is the MAX over its rows, so each fuel row comes out
    once.  (The reports' own query pairs every row of a unit-day with every
    other one; that multiplies litres and grows with the square of a day's
    rows, so it is not reproduced, see SURVEY Q6.)  The flags are one row per
    unit-day, and the same aggregate counts its rows: a unit-day with very many
    is split over salts.
    """
    wh = src.liugong_work_hours
    rows = wh.select(F.col("overall_unit_sn").alias("serialNumber"),
                     F.col("extract_date").cast("date").alias("_date"),
                     lenient_double("avg_mileage_idle_oil_consume").alias("fuel_idle"),
                     lenient_double("job_oil_consumes").alias("fuel_working"),
                     F.col("oil_consumes").cast("double").alias("fuel_total"))
    flags = (liugong_active(wh).where(F.col("serialNumber").isNotNull() & F.col("_date").isNotNull())
             .groupBy(F.col("serialNumber").alias("la_serial"), F.col("_date").alias("la_date"))
             .agg(F.max("is_active_day").alias("la_flag"), F.count("*").alias("la_rows")))
    # Every row with both keys has a flag (its own row gave one); the others have none.
    keyed = F.col("serialNumber").isNotNull() & F.col("_date").isNotNull()
    counted = flags.select(F.col("la_serial").alias("__key0"), F.col("la_date").alias("__key1"), F.col("la_rows").alias("__n"))
    flagged = split_inner_join(flags, rows.where(keyed), ["la_serial", "la_date"], ["serialNumber", "_date"], counted)
    rows = flagged.unionByName(rows.where(~keyed), allowMissingColumns=True)
    lg = _units(src, units, LIUGONG).select(
        norm("unit_key").alias("lg_key"), F.col("vehicleName").alias("productName"), F.col("vehicleType").alias("equipmentModel"))
    keyed_rows = rows.withColumn("r_key", norm("serialNumber"))
    rows = keyed_rows.join(lg, keyed_rows["r_key"] == lg["lg_key"], "left")
    return rows.select(*_fuel_row(F.col("serialNumber"), F.col("productName"), F.col("equipmentModel"), LIUGONG,
                                  F.col("_date"), F.col("fuel_idle"), F.col("fuel_working"), F.lit(None),
                                  F.col("fuel_total"), F.coalesce(F.col("la_flag"), F.lit(0))))


def cat_fuel_allocation(src, units: DataFrame | None = None) -> DataFrame:
    """Latest assets with their days; total fuel split by the idle / working hour shares."""
    ca = src.cat_asset_utilization
    assets = _units(src, units, CATERPILLAR).select(F.col("unit_key").alias("asset_serial_number"), F.col("vehicleType").alias("model"))
    facts = ca.select(F.col("asset_serial_number").alias("cf_serial"),
                      F.col("extract_date").cast("date").alias("cf_date"),
                      lenient_double("working_time_hours").alias("cf_work"),
                      lenient_double("idle_time_hours").alias("cf_idle"),
                      lenient_double("total_fuel_burned_liter").alias("cf_total"))
    rows = self_dim_left_join(assets, facts, "asset_serial_number", "cf_serial")
    work, idle, total = F.col("cf_work"), F.col("cf_idle"), F.col("cf_total")
    hours = F.nullif(work + idle, F.lit(0.0))
    idle_fuel = round_half_up(F.try_divide(total * idle, hours), 2)
    work_fuel = round_half_up(F.try_divide(total * work, hours), 2)
    return rows.select(*_fuel_row(F.concat(F.lit(CAT_PREFIX), F.col("asset_serial_number")),
                                  F.lit(None).cast("string"), F.col("model"), CATERPILLAR, F.col("cf_date"),
                                  idle_fuel, work_fuel, F.lit(None), total, lenient_active(work, idle)))


def fuel_daily(src, fuel_max: float = 300.0, drop_cap: int = 50, bucket_minutes: int = 30,
               units: DataFrame | None = None) -> DataFrame:
    """All makers' fuel days; ``units`` is a ``unit_table``, by default that of ``src``."""
    return (fuso_fuel_daily(src, fuel_max, drop_cap, bucket_minutes, units)
            .unionByName(jd_fuel_daily(src, units))
            .unionByName(liugong_fuel_daily(src, units))
            .unionByName(cat_fuel_allocation(src, units)))
