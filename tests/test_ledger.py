"""Report rules on the hand-made fixture, with values worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import fuel as fu
from fleetlens.operators.activity import active_days
from fleetlens.operators.latest import latest_per_key
from fleetlens.operators.register import register_for, register_latest
from fleetlens.operators.units import fuso_latest_devices, jd_latest_machines
from fleetlens.plans import reports
from fleetlens.sources.adapters import AS_OF
from tests.fixture_rows import TABLES
from tests.helpers import make_sources

D = dt.date


@pytest.fixture(scope="module")
def src(spark):
    return make_sources(spark, **TABLES)


def test_latest_device_ties_and_nulls(src):
    rows = {r["imei"]: r for r in fuso_latest_devices(src.fuso_devices).collect()}
    assert rows["1"]["vehicle_name"] == "Truck A"          # newest snapshot
    assert rows["2"]["vehicle_name"] == "Truck B2"         # tie: greatest emitted values
    assert rows["8"]["vehicle_name"] == "Truck H new"      # NULL date sorts last
    assert rows[None]["chassis_number"] == "MHF009"        # NULL key is one group


def test_jd_capability_before_rank_type_after(src):
    got = {r["serialNumber"]: r["_name"] for r in jd_latest_machines(src.jd_equipment).collect()}
    assert got == {"JD1": "Tractor 1", "JD2": "Tractor 2 old", "JD4": "Tractor 4"}


def test_latest_per_key_is_deterministic_under_repartition(spark, src):
    base = latest_per_key(src.fuso_devices, ["imei"], tiebreak=["chassis_number", "vehicle_name"]).collect()
    shuffled = latest_per_key(src.fuso_devices.repartition(7), ["imei"],
                              tiebreak=["chassis_number", "vehicle_name"]).collect()
    assert sorted(map(tuple, base), key=repr) == sorted(map(tuple, shuffled), key=repr)


def test_register_variants(src):
    reg = register_latest(src.lark_fleet_master)
    assert reg.where(F.col("manufacture") == "KOMATSU").count() == 0
    assert reg.where(F.col("class") == "STALE").count() == 0
    by = {}
    for v in ("list", "hours", "fuel"):
        by[v] = {r["vehicleName"] if v == "list" else r["idNumber"]: r
                 for r in register_for(src.lark_fleet_master, v).collect()}
    cat2 = by["list"]["DZ-2"]                                    # ' cat ' maker
    assert (cat2["idNumber"], cat2["manufacture"]) == ("X9-SYW2", " cat ")
    assert "X9-SYW2" in by["hours"] and by["hours"]["X9-SYW2"]["manufacture"] == "CATERPILLAR"
    assert "CATSYW2" in by["fuel"]
    assert by["list"]["DZ-3"]["idNumber"] == "CAT"               # no SYW in serial
    assert by["list"]["DZ-4"]["idNumber"] is None                # NULL serial
    assert by["list"]["DT-1"]["user"] == "NURSERY"


def test_fleet_list_labels(src):
    rows = reports.fleet_list(src).collect()
    n = len(rows)
    labels = [r["data_source"] for r in rows]
    assert labels.count("Matched") + labels.count("Lark Only") + labels.count("Datalake Only") == n
    by_id = {(r["idNumber"], r["vehicleName"]): r["data_source"] for r in rows}
    assert by_id[("MHF001", "Truck A")] == "Matched"
    assert by_id[("mhf003", "Truck C")] == "Matched"            # both sides normalized in the join
    assert by_id[("mhf003", "Truck C2")] == "Matched"           # register row fans out to two devices
    assert by_id[(None, "DZ-4")] == "Datalake Only"             # NULL register id: first arm
    assert by_id[("MHF050", "DT-50")] == "Lark Only"
    assert by_id[("CATSYW1", "DZ-1")] == "Matched"
    # sorted by data_source, manufacture, idNumber with NULLs last
    keys = [(r["data_source"], r["manufacture"] or "￿", r["idNumber"] or "￿") for r in rows]
    assert keys == sorted(keys)


def test_fuel_delta_rules(src):
    steps = fu.fuso_fuel_steps(src).where(F.col("idNumber") == "MHF001").collect()
    by_bucket = {r["window_start"]: r for r in steps}
    t = lambda h, m, d=5: dt.datetime(2024, 1, d, h, m)
    assert by_bucket[t(10, 0)]["fuelLevel"] == 90                 # last reading of the bucket
    assert by_bucket[t(10, 30)]["fuel_used_liters"] == 15 and by_bucket[t(10, 30)]["trip_meter"] == 2
    assert by_bucket[t(11, 0)]["fuel_used_liters"] == 0           # drop of exactly 50
    assert by_bucket[t(11, 30)]["fuel_used_liters"] == 0          # refuel
    assert by_bucket[t(12, 0)]["idle_fuel_consumption"] == 49     # drop of 49 standing still
    assert by_bucket[t(12, 30)]["idle_fuel_consumption"] == 21    # NULL odometer -> idle
    assert by_bucket[t(13, 0)]["fuelLevel"] == 230                # 229.5 rounds half up
    assert by_bucket[t(0, 0, 6)]["fuel_used_liters"] == 2 and by_bucket[t(0, 0, 6)]["_date"] == D(2024, 1, 6)
    assert by_bucket[None]["fuel_used_liters"] == 0               # NULL time sorts last
    assert len(steps) == 9
    for r in fu.fuso_fuel_steps(src).collect():
        assert 0 <= r["fuel_used_liters"] < 50


def test_fuso_fuel_daily_multiplicity(src):
    rows = {(r["idNumber"], r["vehicleName"], r["_date"]): r for r in fu.fuso_fuel_daily(src).collect()}
    a = rows[("MHF001", "Truck A", D(2024, 1, 5))]
    assert (a["fuel_consumed_total"], a["fuel_consumed_idle"], a["fuel_consumed_working"], a["is_active_day"]) == \
        (85.0, 70.0, 15.0, 1)
    c1 = rows[(" mhf003 ", "Truck C", D(2024, 1, 6))]
    c2 = rows[(" mhf003 ", "Truck C2", D(2024, 1, 6))]
    assert (c1["fuel_consumed_total"], c1["is_active_day"]) == (10.0, 0)
    assert (c2["fuel_consumed_total"], c2["is_active_day"]) == (20.0, 1)   # two activity rows
    assert rows[("MHF010", "Truck J", D(2024, 1, 5))]["fuel_consumed_idle"] == 5.0   # 5 -> 0 litres
    orphan = rows[("MHF404", None, D(2024, 1, 5))]
    assert orphan["fuel_consumed_total"] == 5.0
    for r in rows.values():
        assert r["fuel_consumed_idle"] + r["fuel_consumed_working"] == r["fuel_consumed_total"]


def test_liugong_fuel_keeps_each_row_once(src):
    """A unit-day with n rows gives n rows, all with the day's MAX activity flag."""
    rows = fu.liugong_fuel_daily(src).collect()
    lg1 = [r for r in rows if r["idNumber"] == "LG1" and r["_date"] == D(2024, 1, 10)]
    assert len(rows) == len(src.liugong_work_hours.collect()) and len(lg1) == 2
    assert [r["is_active_day"] for r in lg1] == [1, 1]
    assert [r["is_active_day"] for r in rows if r["idNumber"] is None] == [0]
    lg2 = [r for r in rows if r["idNumber"] == "LG2"][0]
    assert (lg2["vehicleName"], lg2["is_active_day"]) == ("Loader 2", 0)


def test_cat_fuel_split(src):
    rows = {(r["idNumber"], r["_date"]): r for r in fu.cat_fuel_allocation(src).collect()}
    r = rows[("CATSYW1", D(2024, 1, 10))]
    assert (r["fuel_consumed_idle"], r["fuel_consumed_working"], r["is_active_day"]) == (10.0, 30.0, 1)
    z = rows[("CATSYW1", D(2024, 1, 11))]
    assert (z["fuel_consumed_idle"], z["fuel_consumed_working"], z["is_active_day"]) == (None, None, 0)
    assert rows[(None, None)]["vehicleType"] == "D8"            # NULL serial: kept once, no facts


def test_active_days_window(src):
    got = {(r["manufacture"], r["idNumber"]): r["total_active_days"] for r in active_days(src, AS_OF).collect()}
    assert got[("MITSUBISHI", "MHF001")] == 11          # 10 in window + future day; as_of-31 out
    assert got[("MITSUBISHI", "MHF002")] == 9
    assert got[("MITSUBISHI", "MHF010")] == 10
    assert ("MITSUBISHI", None) not in got and ("MITSUBISHI", " ") not in got
    # zero-hour day, old day and the day with unparseable idle hours (3 + NULL) do not count
    assert got[("CATERPILLAR", "SYW1")] == 1


def test_utilization_raw_register_key(src):
    """Utilization compares normalized unit keys to the *raw* register key, so
    a padded register maker never enriches its units."""
    from fleetlens.plans.reports import utilization_rows
    rows = utilization_rows(src, AS_OF).where(F.col("manufacture") == "MITSUBISHI").collect()
    assert {r["model"] for r in rows} == {"FN-1", None}     # FN-3 (padded maker) never attached


def test_utilization_totals(src):
    rows = reports.utilization(src, AS_OF).collect()
    for r in rows:
        assert r["total_unit"] == r["total_underutilized_unit"] + r["total_utilized_unit"]
    assert sum(r["total_utilized_unit"] for r in rows if r["manufacture"] == "MITSUBISHI") == 2   # 11 and 10 days
    keys = [(r["manufacture"] or "￿", -r["total_underutilized_unit"]) for r in rows]
    assert keys == sorted(keys)


def test_hours_ratios(src):
    rows = reports.hours(src).collect()
    for r in rows:
        if r["work_ratio"] is not None and "Infinity" not in str(r["work_hour"]) and r["work_hour"] != float("inf"):
            assert abs(r["work_ratio"] + r["idle_ratio"] - 100.0) <= 0.011
            assert r["is_active_day"] == 1
    keys = [(r["manufacture"], r["idNumber"] or "￿", r["_date"] or D(9999, 1, 1)) for r in rows]
    assert keys == sorted(keys)


def test_write_report_partitioned(spark, src, tmp_path):
    from fleetlens.plans.sink import write_report
    out = str(tmp_path / "hours")
    write_report(reports.hours(src, ordered=False), out, partition_by="_date")
    back = spark.read.parquet(out)
    assert back.count() == reports.hours(src).count()
    assert back.where(F.col("_date") == D(2024, 1, 5)).count() > 0


def test_preserved_sides_of_fuel_joins(src):
    """JD and CAT keep units without fuel (NULL day); MITSUBISHI and LIUGONG
    rows come from the fuel facts, so units without fuel are absent."""
    jd = {(r["idNumber"], r["_date"]) for r in fu.jd_fuel_daily(src).collect()}
    assert ("JD4", None) in jd
    fuso_ids = {r["idNumber"] for r in fu.fuso_fuel_daily(src).collect()}
    assert "MHF002" not in fuso_ids
    lg_ids = {r["idNumber"] for r in fu.liugong_fuel_daily(src).collect()}
    assert "LG3" not in lg_ids and "LG9" in lg_ids


def test_blank_ids_only_filtered_in_utilization(src):
    hours_ids = {r["idNumber"] for r in reports.hours(src).where(F.col("manufacture") == "MITSUBISHI").collect()}
    assert " " in hours_ids and None in hours_ids
    util_ids = {r["idNumber"] for r in active_days(src, AS_OF).where(F.col("manufacture") == "MITSUBISHI").collect()}
    assert " " not in util_ids and None not in util_ids


def test_fuel_imputation_fans_out_on_normalized_types(src):
    """The fuel master is grouped on raw types ('FN1', 'fn1 ') but joined on
    UPPER(TRIM()), so each FN1 row matches two master rows."""
    rows = reports.fuel(src).where((F.col("idNumber") == "MHF001") & (F.col("_date") == D(2024, 1, 5))).collect()
    assert len(rows) == 2 and len({r["model"] for r in rows}) == 1   # own model wins in COALESCE


def test_jd_fuel_null_day_is_inactive(src):
    rows = [r for r in fu.jd_fuel_daily(src).collect() if r["idNumber"] == "JD1" and r["_date"] is None]
    assert len(rows) == 1 and rows[0]["is_active_day"] == 0 and rows[0]["fuel_consumed_total"] == 6.0 / 3600.0
