"""Every registry key on the hand-made fixture equals its plain-SQL form."""

import pytest

from fleetlens.plans.oracle import source_sql
from fleetlens.plans.registry import source_queries
from tests.fixture_rows import TABLES
from tests.helpers import duck_multiset, duck_with, make_sources, spark_multiset

KEYS = sorted(source_queries())


@pytest.fixture(scope="module")
def src(spark):
    return make_sources(spark, **TABLES)


@pytest.fixture(scope="module")
def duck():
    return duck_with(TABLES)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_sql(key, src, duck):
    got = spark_multiset(source_queries()[key](src))
    want = duck_multiset(duck, source_sql()[key])
    assert got == want, (f"{key}: only spark {list((got - want).elements())[:4]}, "
                         f"only sql {list((want - got).elements())[:4]}")


@pytest.mark.parametrize("key", ["fleet_list", "utilization", "hours", "fuel"])
def test_reports_run_on_empty_sources(spark, key):
    empty = make_sources(spark)
    assert source_queries()[key](empty).collect() == []
