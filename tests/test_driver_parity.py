"""Registry over the driver tables (adapters) equals the SQL twins in DuckDB."""

import pytest

from fleetlens.plans.oracle import oracle_sql
from fleetlens.plans.registry import queries
from tests.conftest import SF_SMALL
from tests.helpers import duck_multiset, spark_multiset

TABLES = ["region", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_contract():
    import __spark_entry__ as e
    assert set(queries()) == set(oracle_sql())          # every key of the library has its SQL twin
    assert len(queries()) == 32
    assert set(queries()) <= set(e.queries())           # corpus operators add theirs when they are present
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("key", ["fleet_list", "utilization", "hours", "fuel", "fuel_delta",
                                 "liugong_fuel_daily", "register_normalize"])
def test_driver_key_matches_sql(spark, duck, key):
    got = spark_multiset(queries()[key](spark, SF_SMALL))
    want = duck_multiset(duck, oracle_sql()[key])
    assert got == want


def test_fuel_report_independent_of_input_partitioning(spark):
    from fleetlens.plans import reports
    from fleetlens.sources.catalog import FleetSources, derive_from_driver_tables
    src = derive_from_driver_tables(spark, SF_SMALL)
    shuffled = FleetSources(*[getattr(src, f).repartition(11) for f in src.__dataclass_fields__])
    assert spark_multiset(reports.fuel(src)) == spark_multiset(reports.fuel(shuffled))
