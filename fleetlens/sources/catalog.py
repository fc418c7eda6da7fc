"""The nine fleet sources as one value passed to every report."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from fleetlens.sources.adapters import ADAPTERS
from fleetlens.sources.schemas import SCHEMAS, conform


@dataclass(frozen=True)
class FleetSources:
    fuso_devices: DataFrame
    fuso_daily_summary: DataFrame
    fuso_fuel_reports: DataFrame
    jd_equipment: DataFrame
    jd_measurement: DataFrame
    liugong_machines: DataFrame
    liugong_work_hours: DataFrame
    cat_asset_utilization: DataFrame
    lark_fleet_master: DataFrame

    @classmethod
    def from_frames(cls, frames: dict[str, DataFrame]) -> "FleetSources":
        return cls(**{f.name: conform(frames[f.name], SCHEMAS[f.name], f.name) for f in fields(cls)})


def read_fleet_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> FleetSources:
    """Read ``<root>/<table>`` for the nine sources with the declared schemas."""
    frames = {name: spark.read.format(fmt).schema(schema).load(f"{root.rstrip('/')}/{name}")
              for name, schema in SCHEMAS.items()}
    return FleetSources.from_frames(frames)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_from_driver_tables(spark: SparkSession, sf_dir: str) -> FleetSources:
    """Build the nine sources from the driver's TPC-H-like tables (adapters)."""
    cache: dict[str, DataFrame] = {}

    def table(t: str) -> DataFrame:
        if t not in cache:
            cache[t] = read_driver_table(spark, sf_dir, t)
        return cache[t]

    frames = {}
    for name, (tables, body) in ADAPTERS.items():
        frames[name] = spark.sql(body, **{t: table(t) for t in tables})
    return FleetSources.from_frames(frames)
