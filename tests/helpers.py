"""Test helpers: build fleet sources from rows, run the SQL twin in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
from pyspark.sql.types import DateType, DoubleType, StringType

from fleetlens.sources.catalog import FleetSources
from fleetlens.sources.schemas import SCHEMAS

DUCK_TYPES = {StringType(): "VARCHAR", DateType(): "DATE", DoubleType(): "DOUBLE"}


def make_sources(spark, **tables) -> FleetSources:
    frames = {}
    for name, schema in SCHEMAS.items():
        rows = tables.get(name, [])
        frames[name] = spark.createDataFrame(rows, schema)
    return FleetSources.from_frames(frames)


def duck_with(tables: dict) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name, schema in SCHEMAS.items():
        cols = ", ".join(f'"{f.name}" {DUCK_TYPES[f.dataType]}' for f in schema.fields)
        con.execute(f"CREATE TABLE {name} ({cols})")
        rows = tables.get(name, [])
        if rows:
            marks = ", ".join("?" for _ in schema.fields)
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", [list(r) for r in rows])
    return con


def norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def multiset(columns, rows) -> Counter:
    order = sorted(columns)
    idx = [list(columns).index(c) for c in order]
    return Counter(tuple(norm_value(r[i]) for i in idx) for r in rows)


def spark_multiset(df) -> Counter:
    return multiset(df.columns, df.collect())


def duck_multiset(con, sql) -> Counter:
    cur = con.execute(sql)
    return multiset([d[0] for d in cur.description], cur.fetchall())
