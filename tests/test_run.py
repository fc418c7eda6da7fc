"""Command-line run and SQL views over stored fleet tables."""

from fleetlens.sources.catalog import read_fleet_tables
from tests.fixture_rows import TABLES
from tests.helpers import make_sources


def _store(spark, root):
    mem = make_sources(spark, **TABLES)
    for name in mem.__dataclass_fields__:
        getattr(mem, name).write.parquet(f"{root}/{name}")


def test_cli_writes_all_reports(spark, tmp_path):
    from fleetlens.__main__ import main
    from fleetlens.plans import reports
    root, out = str(tmp_path / "tables"), str(tmp_path / "out")
    _store(spark, root)
    main(["--tables", root, "--out", out, "--as-of", "2024-02-01"])
    src = read_fleet_tables(spark, root)
    assert spark.read.parquet(f"{out}/fuel").count() == reports.fuel(src).count()
    assert spark.read.parquet(f"{out}/hours").count() == reports.hours(src).count()
    assert spark.read.parquet(f"{out}/fleet_list").count() == reports.fleet_list(src).count()
    assert spark.read.parquet(f"{out}/utilization").count() == reports.utilization(src, "2024-02-01").count()


def test_reports_as_sql_views(spark, tmp_path):
    from fleetlens.plans.views import register_views
    root = str(tmp_path / "tables")
    _store(spark, root)
    names = register_views(read_fleet_tables(spark, root), as_of="2024-02-01", prefix="t_")
    assert "t_fuel" in names and "t_lark_fleet_master" in names
    n = spark.sql("SELECT data_source, count(*) AS n FROM t_fleet_list GROUP BY data_source").collect()
    assert {r["data_source"] for r in n} == {"Matched", "Lark Only", "Datalake Only"}
    assert spark.sql("SELECT sum(total_unit) AS s FROM t_utilization").first()["s"] > 0
