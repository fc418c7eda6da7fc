"""State kept between loads equals a computation over all rows; a day's replacement leaves other days alone."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetlens.operators.activity import active_days, activity_facts, daily_active_counts
from fleetlens.operators.hours import daily_hours
from fleetlens.operators.latest import latest_per_key, merge_latest
from fleetlens.operators.units import cat_latest_assets, unit_table
from fleetlens.plans import reports
from fleetlens.plans.incremental import load_activity, load_assets, stored_activity, stored_units
from fleetlens.plans.materialize import write_and_read
from fleetlens.plans.sink import replace_days, write_report
from fleetlens.plans.snapshots import read_snapshot, versions, write_snapshot
from fleetlens.sources.catalog import read_fleet_tables
from tests.fixture_rows import TABLES
from tests.helpers import make_sources, spark_multiset


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("fleet"))
    mem = make_sources(spark, **TABLES)
    for name in mem.__dataclass_fields__:
        getattr(mem, name).write.parquet(f"{root}/{name}")
    return read_fleet_tables(spark, root)


def test_merged_latest_equals_full_ranking_after_each_load(spark):
    rows = [(f"2024-01-{d:02d}", k, m) for d in range(1, 13) for k in ("a", "b", "c", None) if (d + len(k or "")) % 3 for m in ("x", "y", None)]
    rows += [(None, "a", "z"), (None, "d", "w"), (None, "e", None), ("2024-01-05", "e", "late")]
    schema = "extract_date string, asset string, model string"
    loads = [rows[20:40], rows[:20] + rows[30:35], rows[40:], rows[:5]]     # out of order, some rows twice
    stored, seen = None, []
    for load in loads:
        stored = merge_latest(stored, spark.createDataFrame(load, schema), ["asset"], tiebreak=["model"])
        seen += load
        want = latest_per_key(spark.createDataFrame(seen, schema), ["asset"], tiebreak=["model"]).select("asset", "extract_date", "model")
        assert spark_multiset(stored) == spark_multiset(want)


def test_stored_assets_over_three_loads_feed_the_reports(spark, src, tmp_path):
    root = str(tmp_path / "assets")
    facts = src.cat_asset_utilization
    days = sorted({r[0] or "" for r in facts.select("extract_date").distinct().collect()})
    thirds = [days[i::3] for i in range(3)]
    loaded = []
    for part in thirds:
        loaded += part
        load_assets(facts.where(F.coalesce("extract_date", F.lit("")).isin(*part)), root)
        want = cat_latest_assets(facts.where(F.coalesce("extract_date", F.lit("")).isin(*loaded)))
        assert spark_multiset(read_snapshot(spark, root).select("asset_serial_number", "model")) == spark_multiset(want)
    units = stored_units(src, root)
    assert spark_multiset(units) == spark_multiset(unit_table(src))
    # The unit table reads no facts, and the hours read the Caterpillar table once.
    assert "cat_asset_utilization]" not in units._jdf.queryExecution().executedPlan().toString()
    plan = daily_hours(src, write_and_read(units, "units"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("cat_asset_utilization]") == 1
    assert spark_multiset(reports.hours(src, units=units)) == spark_multiset(reports.hours(src))


def test_window_of_stored_days_equals_the_full_count_on_40_dates(spark, src, tmp_path):
    root = str(tmp_path / "activity")
    every = sorted({r[0].isoformat() for r in daily_active_counts(src).select("_date").distinct().collect()})
    load_activity(src, root, every[:4])
    for day in every[3:]:                                                   # day by day, one of them twice
        load_activity(src, root, [day])
    counts = stored_activity(spark, root)
    assert spark_multiset(counts.select("fact_maker", "fact_key", "_date", "active_rows")) == spark_multiset(daily_active_counts(src))
    facts = [(r.fact_maker, r.fact_key, r.day_text, r._date, r.is_active) for r in activity_facts(src).collect()]
    held = [(r.manufacture, r.unit_key, r.idNumber, r.vehicleName, r.vehicleType) for r in unit_table(src).collect() if (r.idNumber or "").strip(" \t\r\n")]
    units, kept = unit_table(src).cache(), counts.cache()
    first = dt.date.fromisoformat(every[0]) + dt.timedelta(days=12)
    for k in range(40):
        as_of = first + dt.timedelta(days=k)
        since = as_of - dt.timedelta(days=30)
        want = {}
        for maker, key, *unit in held:
            n = sum(1 for m, f, _, day, active in facts if m == maker and f is not None and f == key and day is not None and day >= since and active)
            want[maker, *unit] = want.get((maker, *unit), 0) + n
        got = {(r.manufacture, r.idNumber, r.vehicleName, r.vehicleType): r.total_active_days
               for r in active_days(src, as_of.isoformat(), units=units, counts=kept).collect()}
        assert got == want, as_of
    units.unpersist()
    kept.unpersist()


def test_replaced_day_leaves_other_files_alone(spark, tmp_path):
    path = str(tmp_path / "hours")
    day = lambda n: dt.date(2024, 1, n) if n else None
    rows = [(f"u{i}", day(n), float(i)) for i in range(20) for n in (0, 1, 2, 3)]
    schema = "idNumber string, _date date, work_hour double"
    write_report(spark.createDataFrame(rows, schema), path, partition_by="_date")

    def files():
        return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    before = files()
    new = [("u1", day(2), 99.0), ("u7", day(2), 98.0), ("u1", day(3), -1.0), ("u1", None, -1.0)]
    for _ in range(2):                                                      # a second run changes nothing
        replace_days(spark.createDataFrame(new, schema), path, ["2024-01-02"])
        after = files()
        assert {f: t for f, t in before.items() if "2024-01-02" not in f} == {f: t for f, t in after.items() if "2024-01-02" not in f}
        got = spark.read.schema(schema).parquet(path).select("idNumber", "_date", "work_hour")
        want = [r for r in rows if r[1] != day(2)] + new[:2]
        assert spark_multiset(got) == spark_multiset(spark.createDataFrame(want, schema))
    replace_days(spark.createDataFrame(new[3:], schema), path, [None, "2024-01-03"])      # a day without rows goes
    got = {(r["_date"], r["work_hour"]) for r in spark.read.schema(schema).parquet(path).where("_date is null or _date = '2024-01-03'").collect()}
    assert got == {(None, -1.0)}


def test_snapshot_versions_are_read_once_committed(spark, tmp_path):
    root = str(tmp_path / "table")
    assert read_snapshot(spark, root) is None and versions(spark, root) == []
    for n in range(1, 5):
        assert write_snapshot(spark.range(n), root).count() == n
    assert versions(spark, root) == [3, 4] and read_snapshot(spark, root).count() == 4
    (Path(root) / "v=5").mkdir()                                            # a writer died before its commit
    assert read_snapshot(spark, root).count() == 4
    write_snapshot(spark.range(7), root)
    assert read_snapshot(spark, root).count() == 7


def test_command_line_replaces_days_and_keeps_state(spark, tmp_path):
    from fleetlens.__main__ import main
    root, out, state = (str(tmp_path / x) for x in ("tables", "out", "state"))
    mem = make_sources(spark, **TABLES)
    for name in mem.__dataclass_fields__:
        getattr(mem, name).write.parquet(f"{root}/{name}")
    args = ["--tables", root, "--out", out, "--as-of", "2024-02-01", "--state", state]
    main(args)
    src = read_fleet_tables(spark, root)
    for name, df in {"hours": reports.hours(src), "utilization": reports.utilization(src, "2024-02-01")}.items():
        assert spark.read.parquet(f"{out}/{name}").count() == df.count()
    before = spark_multiset(spark.read.parquet(f"{out}/hours"))
    main([*args, "--days", "2024-01-05", "--reports", "hours,utilization"])
    assert spark_multiset(spark.read.parquet(f"{out}/hours")) == before
    assert spark.read.parquet(f"{out}/utilization").count() == reports.utilization(src, "2024-02-01").count()
