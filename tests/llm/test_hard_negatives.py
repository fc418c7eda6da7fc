"""Hard negatives over zone-mapped blocks against a plain search of all rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"
ROWS = "id long, label long, vec array<bigint>"


def brute(rows, every, positives=5, negatives=5):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2]]
    out = []
    for i, (a, label, v) in enumerate(rows):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), b, k) for j, (b, k, w) in enumerate(rows) if j != i]
        scored.sort()
        for s, b, _ in [x for x in scored if x[2] == label][:positives]:
            found = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(a, b, r, n, -s, -t) for r, (t, n, _) in enumerate(found, 1)]
    return sorted(out)


def clustered(seed, n=700, dims=9, clusters=12):
    rnd = np.random.default_rng(seed)
    centers = rnd.integers(-90, 90, (clusters, dims))
    kind = rnd.integers(0, clusters, n)
    v = centers[kind] + rnd.integers(-12, 13, (n, dims))
    label = np.where(rnd.random(n) < 0.25, rnd.integers(0, 4, n), kind % 4)
    return [(int(i), int(k), [int(x) for x in row]) for i, k, row in zip(rnd.permutation(n), label, v)]


def got(spark, rows, every, **how):
    df = spark.createDataFrame(rows, ROWS).repartition(3).withColumn("score", F.lit("clash")).withColumn("Block", F.lit(1))
    return sorted(tuple(r) for r in hn.hard_negatives(df, every, **how).collect())


@pytest.mark.parametrize("block_rows", [16, 512])
def test_equals_a_plain_search(spark, block_rows):
    rows = clustered(1)
    want = brute(rows, 9)
    assert len(want) > 500
    assert got(spark, rows, 9, block_rows=block_rows) == want


def test_ties_hot_vectors_repeated_rows_and_nulls(spark):
    rnd = random.Random(2)
    hot = [100, -20, 3]
    rows = [(i, rnd.randrange(2), hot if rnd.random() < 0.5 else [rnd.randrange(-5, 6) * 10, rnd.randrange(-2, 3), 0]) for i in range(150)]
    rows += rows[:12] + [(10, 1, [1, 2, 3]), (10, 0, [99, -20, 3]), (None, 1, hot), (1000, None, hot), (1010, 0, None), (1020, 1, [1, None, 3]),
                         (2000, 0, []), (2010, 1, [7]), (-30, 1, [90, -20])]
    want = brute(rows, 10)
    assert got(spark, rows, 10, block_rows=8) == want
    assert len({w[0] for w in want}) > 10


def test_empty_tables_and_no_anchor(spark):
    assert got(spark, [], 10) == []
    assert got(spark, [(1, 1, [1]), (2, 0, [2])], 10) == []
    assert got(spark, [(10, 1, [1])], 10) == []
    assert got(spark, [(10, 1, [5]), (11, 1, [4]), (3, 2, [4]), (4, 2, [3])], 10) == [(10, 11, 1, 3, 20, 20)]


def test_large_components_are_exact(spark):
    rnd = random.Random(3)
    rows = [(i, i % 3, [rnd.randrange(-2**30, 2**30) for _ in range(3)]) for i in range(60)] + [(100 + i, i % 2, [2**31 + i, 1]) for i in range(6)]
    assert got(spark, rows, 5, block_rows=8) == brute(rows, 5)
    with pytest.raises(OverflowError):
        hn.products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def test_zone_maps_spare_blocks_of_other_clusters(spark):
    rows = clustered(4, n=2000, dims=6, clusters=10)
    df = spark.createDataFrame(rows, ROWS)
    laid, dims = hn.blocks(df, 32)
    anchors = hn._anchors(laid, dims, 20, 5)
    read = hn.needed_blocks(anchors, laid, dims, True).select("block", F.size("some").alias("n")).agg(F.sum("n")).first()[0]
    assert read < 0.5 * anchors.count() * laid.count()
    zones = [(r.n, np.frombuffer(r.lo, "<i8"), np.frombuffer(r.hi, "<i8"), np.frombuffer(r.vecs, "<i4").reshape(r.n, dims)) for r in laid.collect()]
    assert sum(z[0] for z in zones) == len(rows) and all((z[3].min(0) == z[1]).all() and (z[3].max(0) == z[2]).all() for z in zones)


def test_bounds_hold_every_product():
    rnd = np.random.default_rng(5)
    a, v = rnd.integers(-50, 50, (20, 7)), rnd.integers(-50, 50, (40, 7))
    least, most = hn.zone_bounds(a, v.min(0)[None], v.max(0)[None])
    s = hn.products(a, v)
    assert (s >= least).all() and (s <= most).all()
    assert (hn.zone_bounds(a, v, v)[0] == s).all() and (hn.zone_bounds(a, v, v)[1] == s).all()


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_neighbours_are_cells_side_by_side(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims).astype(np.uint8)
    keys = hn.hilbert_keys(grid, bits)
    order = np.array(sorted(range(len(grid)), key=lambda i: keys[i].tobytes()))
    steps = np.abs(np.diff(grid[order].astype(int), axis=0)).sum(1)
    assert len({k.tobytes() for k in keys}) == len(grid) and (steps == 1).all()


def test_query_over_awkward_embeddings_equals_its_sql(spark, tmp_path):
    import duckdb
    rnd = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rnd.normal(size=5).astype(np.float32)], int(rnd.integers(0, 3))) for i in range(400)]
    rows += [(500, None, 1), (600, [1.0, None, 0.0, 0.0, 0.0], 1), (700, [float("nan")] * 5, 1), (800, [float("inf")] * 5, 2), (900, [0.5] * 5, None)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    cur = con.execute(hn.SQL)
    names = [d[0] for d in cur.description]
    df = hn.op12_hard_negatives(spark, str(tmp_path))
    want = sorted(tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall())
    assert want and sorted(tuple(r) for r in df.collect()) == want
