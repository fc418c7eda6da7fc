"""Physical-plan properties the reports rely on at scale."""

import pytest

from fleetlens.operators.latest import latest_per_key
from fleetlens.plans import reports
from fleetlens.plans.registry import source_queries
from tests.fixture_rows import TABLES
from tests.helpers import make_sources


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    # stored as parquet, so scans (and their pruning) appear in the plans
    from fleetlens.sources.catalog import read_fleet_tables
    root = str(tmp_path_factory.mktemp("fleet"))
    mem = make_sources(spark, **TABLES)
    for name in mem.__dataclass_fields__:
        getattr(mem, name).write.parquet(f"{root}/{name}")
    return read_fleet_tables(spark, root)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["fleet_list", "utilization", "hours", "fuel", "fuso_fuel_daily",
                                 "liugong_fuel_daily", "active_days_30d"])
def test_no_pairwise_joins_or_python(src, key):
    plan = _plan(source_queries()[key](src))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{key} plan has {bad}"


def test_latest_is_cut_before_the_shuffle(src):
    plan = _plan(latest_per_key(src.fuso_devices, ["imei"], tiebreak=["vehicle_name"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_read_only_used_columns(src):
    import re
    plan = _plan(reports.hours(src, materialize=False))
    # the hours report never reads the register's 'number' / 'user' / 'equipment_number'
    schemas = re.findall(r"lark_fleet_master\].*?ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for schema in schemas:
        fields = {f.split(":")[0] for f in schema.split(",")}
        assert not fields & {"number", "user", "equipment_number"}, fields


def test_register_snapshot_filter_reaches_scan(src):
    from fleetlens.operators.register import register_latest
    plan = _plan(register_latest(src.lark_fleet_master))
    assert "ScalarSubquery" in plan or "scalar-subquery" in plan.lower()
    assert "PushedFilters: [IsNotNull(extract_date), EqualTo(extract_date," in plan


def test_null_key_branch_is_pushed_to_the_scan(src):
    """The second read of the Caterpillar table (units with a NULL serial)
    reaches the scan as IsNull, so parquet null counts skip the row groups."""
    from fleetlens.operators.fuel import cat_fuel_allocation
    plan = _plan(cat_fuel_allocation(src))
    assert "PushedFilters: [IsNull(asset_serial_number)]" in plan


def test_register_snapshot_prunes_date_partitions(spark, tmp_path):
    """With the register laid out by extract_date, the latest-snapshot
    subquery is a partition filter: older snapshots are never listed."""
    from fleetlens.operators.register import register_latest
    from fleetlens.sources.schemas import LARK_FLEET_MASTER, conform
    from tests.fixture_rows import REGISTER
    path = str(tmp_path / "reg")
    spark.createDataFrame(REGISTER, LARK_FLEET_MASTER).write.partitionBy("extract_date").parquet(path)
    df = register_latest(conform(spark.read.parquet(path), LARK_FLEET_MASTER))
    assert df.count() == 12
    plan = _plan(df)
    assert any("PartitionFilters: [isnotnull(extract_date" in line and "Subquery" in line
               for line in plan.splitlines())


def test_literal_filters_reach_the_scans(src):
    from fleetlens.operators.fuel import jd_fuel_daily
    from fleetlens.operators.hours import jd_machine_utilization
    from fleetlens.operators.units import jd_latest_machines
    eq = _plan(jd_latest_machines(src.jd_equipment))
    assert "EqualTo(telematicsCapable,true)" in eq
    mu = _plan(jd_machine_utilization(src.jd_measurement))
    assert "EqualTo(_name,Machine Utilization)" in mu
    both = _plan(jd_fuel_daily(src))
    assert "Or(EqualTo(_name,Fuel Consumed),EqualTo(_name,Machine Utilization))" in both or \
        "In(_name, [Fuel Consumed,Machine Utilization])" in both


def test_both_lags_share_one_window(src):
    from fleetlens.operators.fuel import fuso_fuel_steps
    windows = [line for line in _plan(fuso_fuel_steps(src)).splitlines() if "Window [" in line and "lag(" in line]
    assert len(windows) == 1 and windows[0].count("lag(") == 2


def test_activity_window_reaches_all_fact_scans(src):
    """The 30-day window bounds the scan of each of the four fact tables."""
    from fleetlens.operators.activity import active_days
    src.jd_measurement.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(active_days(src, "2024-02-01"))
    for column in ("_date", "intervalEndDate", "extract_date"):
        assert f"GreaterThanOrEqual({column},2024-01-02)" in plan, column
    assert plan.count(",2024-01-02)") >= 4
    current = _plan(active_days(src))
    assert current.count("GreaterThanOrEqual(") >= 4


def test_fuel_before_its_write_has_no_pairs_and_no_sort_aggregate(src):
    """The part of the fuel report that is written once; MAX runs over distinct values."""
    from fleetlens.operators.enrich import attach_register, vehicle_master
    from fleetlens.operators.fuel import fuel_daily
    from fleetlens.operators.register import register_for
    rows = attach_register(fuel_daily(src), register_for(src.lark_fleet_master, "fuel"))
    plan = _plan(rows)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "array_repeat"):
        assert bad not in plan
    master = _plan(vehicle_master(rows))
    import re
    assert re.search(r"HashAggregate\(keys=\[[^\]]*manufacture[^\]]*\], functions=\[(partial_)?count", master), master


def test_reports_are_ordered(src):
    """Each report's rows come in its order, NULLs last."""
    def asc(v):
        return (v is None, v if v is not None else "")
    for key, cols in {"fleet_list": ("data_source", "manufacture", "idNumber"), "hours": ("manufacture", "idNumber", "_date"),
                      "fuel": ("manufacture", "idNumber", "_date")}.items():
        rows = [tuple(asc(str(r[c]) if r[c] is not None else None) for c in cols) for r in source_queries()[key](src).collect()]
        assert rows == sorted(rows), key
    rows = [(asc(r["manufacture"]), -r["total_underutilized_unit"]) for r in source_queries()["utilization"](src).collect()]
    assert rows == sorted(rows)


def test_checkpoint_folder_is_required_off_local_masters():
    import pytest as _pytest

    from fleetlens.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with _pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
