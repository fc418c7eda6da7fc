"""Column helpers against hand-computed values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import (
    bucket_start, cat_register_id, clean_user, lenient_int, norm, round_half_up, syw_tail,
)


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("x,d,want", [
    (1.005, 2, 1.0),      # 1.005 * 100 stays below 100.5 (Spark's round() gives 1.01)
    (2.675, 2, 2.68),     # 2.675 * 100 rounds to exactly 267.5
    (0.125, 2, 0.13),     # exact tie rounds away from zero
    (-0.125, 2, -0.13),
    (2.5, 0, 3.0),
    (-2.5, 0, -3.0),
    (1.23456, 4, 1.2346),
    (None, 2, None),
])
def test_round_half_up(spark, x, d, want):
    assert one(spark, lambda c: round_half_up(c, d), x, "double") == want


@pytest.mark.parametrize("x,want", [("45.5", 46), ("45.49", 45), ("abc", None), ("1e20", None), (" 7 ", 7)])
def test_lenient_int(spark, x, want):
    assert one(spark, lenient_int, x) == want


@pytest.mark.parametrize("x,want", [("\tjd1 \n", "JD1"), (" mitsubishi ", "MITSUBISHI"), (None, None)])
def test_norm(spark, x, want):
    assert one(spark, norm, x) == want


@pytest.mark.parametrize("x,tail,cat", [
    ("X9-SYW00019", "SYW00019", "CATSYW00019"),
    ("NO-SERIAL", "", "CAT"),        # marker absent: empty suffix, id is just CAT
    ("SYW1", "SYW1", "CATSYW1"),
    (None, None, None),              # NULL serial stays NULL
])
def test_cat_ids(spark, x, tail, cat):
    assert one(spark, syw_tail, x) == tail
    assert one(spark, cat_register_id, x) == cat


@pytest.mark.parametrize("x,want", [
    (" nursery", "NURSERY"), ("Warehouse", "WAREHOUSE"), ("r & d", "R & D"), ("civil ", "CIVIL"),
    ("VACANT", "VACANT"), (" VACANT\t", "VACANT"), ("vacant", None), ("0", None),
    ("Breakdown/Accident", None), ("unknown dept", None), (None, None),
])
def test_clean_user(spark, x, want):
    assert one(spark, clean_user, x) == want


@pytest.mark.parametrize("t,want", [
    ("2024-01-05 10:29:59", "2024-01-05 10:00:00"),
    ("2024-01-05 10:30:00", "2024-01-05 10:30:00"),
    ("2024-01-05 10:47:00", "2024-01-05 10:30:00"),   # integer division, not 10:47
    ("2024-01-05 10:59:59.999", "2024-01-05 10:30:00"),
    ("2024-01-05 11:00:00", "2024-01-05 11:00:00"),
    (None, None),
])
def test_half_hour_bucket(spark, t, want):
    got = one(spark, lambda c: bucket_start(c.cast("timestamp_ntz")), t)
    assert got == (None if want is None else dt.datetime.fromisoformat(want))


def test_bucket_width_must_divide_hour():
    with pytest.raises(ValueError):
        bucket_start(F.col("t"), 7)
