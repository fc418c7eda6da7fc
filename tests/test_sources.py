"""Source contracts: declared schemas, no silent fallbacks."""

import pytest

from fleetlens.sources.schemas import LARK_FLEET_MASTER, SchemaError, conform
from tests.fixture_rows import REGISTER


def test_missing_user_column_is_an_error(spark):
    df = spark.createDataFrame(REGISTER, LARK_FLEET_MASTER).drop("user")
    with pytest.raises(SchemaError, match="user"):
        conform(df, LARK_FLEET_MASTER, "lark_fleet_master")


def test_conform_orders_and_casts(spark):
    df = spark.createDataFrame([("2024-02-01", "x", 1)], "extract_date string, class string, number int")
    with pytest.raises(SchemaError):
        conform(df, LARK_FLEET_MASTER)
    full = spark.createDataFrame(REGISTER, LARK_FLEET_MASTER)
    shuffled = full.select(*reversed(full.columns))
    out = conform(shuffled, LARK_FLEET_MASTER)
    assert out.columns == [f.name for f in LARK_FLEET_MASTER.fields]
    assert out.count() == len(REGISTER)
