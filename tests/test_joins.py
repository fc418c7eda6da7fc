"""Skew-safe join shapes return exactly the plain LEFT JOIN rows."""

import random

from pyspark.sql import functions as F

from fleetlens.operators.joins import keep_left_join, self_dim_left_join
from tests.helpers import spark_multiset


def _data(seed):
    rnd = random.Random(seed)
    dim = [(k, f"unit{k}") for k in range(20)] + [(None, "no key")]
    # key 3 holds a third of the facts; some fact keys have no unit, some NULL
    fact = [(3 if rnd.random() < 0.34 else rnd.choice([None, 25, 26] + list(range(15))), float(i))
            for i in range(300)]
    return dim, fact


def test_keep_left_join_equals_left_join(spark):
    for seed in range(3):
        dim_rows, fact_rows = _data(seed)
        dim = spark.createDataFrame(dim_rows, "k int, name string")
        fact = spark.createDataFrame(fact_rows, "fk int, v double").repartition(5)
        want = dim.join(fact, dim["k"] == fact["fk"], "left").select("k", "name", "fk", "v")
        got = keep_left_join(dim, fact, ["k"], ["fk"])
        assert spark_multiset(got) == spark_multiset(want)


def test_self_dim_left_join_equals_left_join(spark):
    _, fact_rows = _data(7)
    fact = spark.createDataFrame(fact_rows, "fk int, v double")
    dim = fact.groupBy("fk").count().withColumnRenamed("fk", "k")   # derived from the facts
    want = dim.join(fact, dim["k"] == fact["fk"], "left").select("k", "count", "fk", "v")
    got = self_dim_left_join(dim, fact, "k", "fk")
    assert spark_multiset(got) == spark_multiset(want)


def test_split_joins_equal_left_join_when_keys_are_hot(spark):
    """A tiny bound makes the hot keys salted; the rows stay those of the plain join."""
    for seed in range(3):
        dim_rows, fact_rows = _data(seed)
        dim = spark.createDataFrame(dim_rows, "k int, name string")
        fact = spark.createDataFrame(fact_rows, "fk int, v double").repartition(5)
        want = dim.join(fact, dim["k"] == fact["fk"], "left").select("k", "name", "fk", "v")
        assert spark_multiset(keep_left_join(dim, fact, ["k"], ["fk"], hot_rows=10)) == spark_multiset(want)


def test_hot_unit_is_spread_over_join_tasks(spark):
    """A unit with a third of the facts over a large unit list, no broadcast of the units, no AQE split."""
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        units = spark.range(0, 50000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
        facts = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 150).alias("fk"),
                                             F.lit(1.0).alias("v")).repartition(8)         # equal facts, too
        out = keep_left_join(units, facts, ["k"], ["fk"], hot_rows=500)
        tasks = {r[0] for r in out.where(F.col("fk") == 7).select(F.spark_partition_id()).collect()}
        assert len(tasks) >= 6
        assert out.where("fk is not null").count() == 30000
        assert out.where("fk is null").count() == 50000 - facts.select("fk").distinct().count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_building_a_lazy_report_runs_no_job(spark):
    """With materialize=False nothing runs before a report's frame is used."""
    from fleetlens.plans import reports
    from tests.fixture_rows import TABLES
    from tests.helpers import make_sources
    src = make_sources(spark, **TABLES)
    sc = spark.sparkContext
    sc.setJobGroup("report-build", "plan build")
    try:
        for build in (reports.fleet_list, lambda s, **k: reports.utilization(s, "2024-02-01", **k), reports.hours, reports.fuel):
            build(src, materialize=False)
        assert not sc.statusTracker().getJobIdsForGroup("report-build")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_left_join_ways_agree(spark, monkeypatch):
    """Small units (inner join and anti join) and large ones (salted left join) give the rows of a left join."""
    from fleetlens.operators import joins
    dim_rows, fact_rows = _data(4)
    dim = spark.createDataFrame(dim_rows, "k int, name string")
    fact = spark.createDataFrame(fact_rows, "fk int, v double").repartition(3)
    want = spark_multiset(dim.join(fact, dim["k"] == fact["fk"], "left").select("k", "name", "fk", "v"))
    for small in (True, False):
        monkeypatch.setattr(joins, "is_small", lambda df, small=small: small)
        assert spark_multiset(joins.keep_left_join(dim, fact, ["k"], ["fk"], hot_rows=10)) == want
        own = fact.groupBy("fk").count().withColumnRenamed("fk", "k")
        plain = own.join(fact, own["k"] == fact["fk"], "left").select("k", "count", "fk", "v")
        assert spark_multiset(joins.self_dim_left_join(own, fact, "k", "fk", hot_rows=10)) == spark_multiset(plain)
        # Units that stem from the facts need no look at the fact keys.
        derived = joins.keep_left_join(own, fact, ["k"], ["fk"], hot_rows=10, derived=F.lit(True), keys_from=fact.limit(0))
        assert spark_multiset(derived.select("k", "count", "fk", "v")) == spark_multiset(plain)


def test_size_estimate_of_written_units_decides(spark, tmp_path):
    from fleetlens.operators.joins import is_small
    spark.range(1000).write.parquet(f"{tmp_path}/small")
    assert is_small(spark.read.parquet(f"{tmp_path}/small"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert not is_small(spark.read.parquet(f"{tmp_path}/small"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_keys_are_exact_and_need_no_shuffle_by_key(spark):
    from fleetlens.operators.joins import hot_keys
    facts = spark.range(0, 60000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit("warm")).when(F.col("id") % 50 == 2, F.lit(None))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("a"), (F.col("id") % 2).alias("b"))
    want = {(r.a, r.b): r["count"] for r in facts.where("a is not null").groupBy("a", "b").count().where("count > 1000").collect()}
    assert len(want) == 3
    for tracked in (64, 4096):                          # the sketch errs, the counts don't
        hot = hot_keys(facts, ["a", "b"], 1000, candidates=20, tracked=tracked)
        assert {(r["__key0"], r["__key1"]): r["__n"] for r in hot.collect()} == want
    plan = hot_keys(facts, ["a", "b"], 1000)._jdf.queryExecution().executedPlan().toString()
    # The one exchange by key is that of the counted candidates, above their selection.
    assert plan.count("Exchange hashpartitioning(__key0") == 1
    assert plan.index("Exchange hashpartitioning(__key0") < plan.index("LeftSemi")
    assert hot_keys(facts.limit(0), ["a"], 1).collect() == []


def _lists(blank_left, blank_right):
    left = [(None if i % 9 == 0 else f"u{i % 70}", f"l{i}") for i in range(90)] + [("", f"lb{i}") for i in range(blank_left)]
    right = [(None if i % 8 == 0 else f"u{i}", i) for i in range(60, 130)] + [("u65", -1)] + [("", 1000 + i) for i in range(blank_right)]
    return left, right


def test_grid_full_join_equals_full_join(spark):
    from fleetlens.operators.joins import grid_full_join
    for m, n in ((0, 0), (45, 60), (200, 3), (2, 150), (120, 0), (0, 120), (1, 1)):
        left_rows, right_rows = _lists(m, n)
        left = spark.createDataFrame(left_rows, "a string, x string").repartition(3)
        right = spark.createDataFrame(right_rows, "b string, y int").repartition(4)
        want = spark_multiset(left.join(right, left["a"] == right["b"], "full"))
        assert spark_multiset(grid_full_join(left, right, ["a"], ["b"])) == want
        assert spark_multiset(grid_full_join(left, right, ["a"], ["b"], pairs=50, hot_rows=30)) == want


def test_grid_spreads_a_third_of_blank_ids(spark):
    """A third of all ids are blank on both sides: the cells of the product are spread evenly over tasks."""
    from fleetlens.operators.joins import grid_full_join
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        def rows(name):
            return spark.range(0, 3000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias(name),
                                                     F.col("id").alias(f"{name}_n"))
        out = grid_full_join(rows("a"), rows("b"), ["a"], ["b"], pairs=2500)
        counts = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(counts) == 1000 * 1000 + 2000
        busy = [c for c in counts if c > 2000]
        assert len(busy) >= 14 and busy[-1] < 2 * busy[len(busy) // 2]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
