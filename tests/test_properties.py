"""Randomized checks of the column rules against plain-Python statements."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from fleetlens.functions import bucket_start, round_half_up


def test_round_half_up_matches_rule(spark):
    rnd = random.Random(11)
    xs = [rnd.choice([rnd.uniform(-1e4, 1e4), rnd.randint(-10**6, 10**6) / 1000, rnd.randint(-999, 999) / 200])
          for _ in range(2000)] + [0.0, 0.005, -0.005, 1.005, 2.675, 0.125, -0.125]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for d in (0, 2, 4):
        k = float(10 ** d)
        got = [r[0] for r in df.select(round_half_up(F.col("x"), d)).collect()]
        for x, g in zip(xs, got):
            want = math.copysign(math.floor(abs(x) * k + 0.5), x) / k if x != 0 else 0.0
            assert g == want or (g == 0 and want == 0), (x, d, g, want)


def test_bucket_start_matches_rule(spark):
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    ts = [base + dt.timedelta(seconds=rnd.randint(0, 86400 * 60), microseconds=rnd.randint(0, 999999))
          for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    for width in (15, 30, 60):
        got = [r[0] for r in df.select(bucket_start(F.col("t"), width)).collect()]
        for t, g in zip(ts, got):
            assert g == t.replace(minute=t.minute // width * width, second=0, microsecond=0), (t, width, g)
