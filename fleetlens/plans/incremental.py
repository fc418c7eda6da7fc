"""State kept between loads, so that a daily run reads the new day and not the whole history.

* the latest record of every Caterpillar asset (``load_assets``), whose only
  source is the fact table: the reports otherwise rank all facts for it;
* active rows per unit and day (``load_activity``), whose sums over a window are the
  utilization report's active days.

Both take any portion of the facts, a day or a history, and loading a portion again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.activity import daily_active_counts
from fleetlens.operators.latest import merge_latest
from fleetlens.operators.units import unit_table
from fleetlens.plans.sink import replace_days
from fleetlens.plans.snapshots import read_snapshot, write_snapshot

_ASSET = ("asset_serial_number",)
_COUNTS = "fact_maker string, fact_key string, active_rows bigint, _date date"


def load_assets(new_rows: DataFrame, root: str) -> DataFrame:
    """Merge rows of ``cat_asset_utilization`` into the stored latest record per asset; returns the new dimension."""
    stored = read_snapshot(new_rows.sparkSession, root)
    return write_snapshot(merge_latest(stored, new_rows, _ASSET, "extract_date", ["model"]), root)


def stored_units(src, assets_root: str) -> DataFrame:
    """``unit_table`` with the Caterpillar assets from their stored dimension (a report's ``units``): no fact is read for it."""
    assets = read_snapshot(src.cat_asset_utilization.sparkSession, assets_root)
    return unit_table(src, None if assets is None else assets.select("asset_serial_number", "model"))


def _day_of(src, days: Sequence[str]):
    """``src`` with the daily tables cut to some days.

    The day columns are text that starts with an ISO date, so the bounds reach the scans.
    """
    first, after = min(days), F.date_format(F.date_add(F.lit(max(days)).cast("date"), 1), "yyyy-MM-dd")

    def cut(df: DataFrame, column: str) -> DataFrame:
        return df.where((F.col(column) >= F.lit(first)) & (F.col(column) < after))
    return replace(src, fuso_daily_summary=cut(src.fuso_daily_summary, "_date"), jd_measurement=cut(src.jd_measurement, "intervalEndDate"),
                   liugong_work_hours=cut(src.liugong_work_hours, "extract_date"), cat_asset_utilization=cut(src.cat_asset_utilization, "extract_date"))


def load_activity(src, root: str, days: Sequence[str]) -> None:
    """Count the active rows of some days (ISO dates) and replace those days in the stored table."""
    replace_days(daily_active_counts(_day_of(src, days)), root, days)


def stored_activity(spark: SparkSession, root: str) -> DataFrame:
    """The stored counts (``utilization``'s and ``active_days``'s ``counts``); a window reads the folders of its days."""
    return spark.read.schema(_COUNTS).parquet(root)
