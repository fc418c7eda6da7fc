"""Run the reports over the nine fleet tables and write them as parquet.

    python -m fleetlens --tables <root> --out <dir> [--as-of YYYY-MM-DD]
                        [--reports fleet_list,utilization,hours,fuel]
                        [--days YYYY-MM-DD,...] [--state <dir>]

``<root>/<table>`` holds each source table (parquet by default).  Daily
reports (hours, fuel) are written partitioned by ``_date``; with ``--days`` only
those days are replaced.  ``--state`` keeps the latest Caterpillar assets
and the active rows per day between runs (``plans/incremental.py``): with
``--days`` their rows are merged, otherwise all rows, and the reports read the state.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from fleetlens.operators.activity import daily_active_counts
from fleetlens.plans import reports
from fleetlens.plans.incremental import load_activity, load_assets, stored_activity, stored_units
from fleetlens.plans.materialize import write_and_read
from fleetlens.plans.sink import replace_days, write_report
from fleetlens.session import build_session
from fleetlens.sources.catalog import read_fleet_tables

DAILY = {"hours", "fuel"}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="fleetlens")
    ap.add_argument("--tables", required=True, help="folder holding the nine source tables")
    ap.add_argument("--out", required=True, help="output folder, one sub-folder per report")
    ap.add_argument("--as-of", default=None, help="utilization window end (default: today)")
    ap.add_argument("--reports", default="fleet_list,utilization,hours,fuel")
    ap.add_argument("--days", default="", help="days of the daily reports to replace (default: the whole tables)")
    ap.add_argument("--state", default=None, help="folder of the state kept between runs")
    ap.add_argument("--format", default="parquet", help="format of the source tables")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="initial shuffle partitions; AQE only merges them, so size for the largest "
                         "shuffle (about its bytes / 128 MB)")
    args = ap.parse_args(argv)

    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    src = read_fleet_tables(spark, args.tables, args.format)
    days = [d.strip() for d in args.days.split(",") if d.strip()]
    units = counts = None
    if args.state:
        units, counts = _load_state(src, args.state.rstrip("/"), days)
    build = {
        "fleet_list": lambda: reports.fleet_list(src, units=units),
        "utilization": lambda: reports.utilization(src, args.as_of, units=units, counts=counts),
        "hours": lambda: reports.hours(src, ordered=False, units=units),
        "fuel": lambda: reports.fuel(src, ordered=False, units=units),
    }
    for name in [r.strip() for r in args.reports.split(",") if r.strip()]:
        out = f"{args.out.rstrip('/')}/{name}"
        if days and name in DAILY:
            replace_days(build[name](), out, days)
        else:
            write_report(build[name](), out, partition_by="_date" if name in DAILY else None)


def _load_state(src, root: str, days: list[str]):
    """Merge the days (or everything) into the state; the unit table and the activity counts that the reports read."""
    facts = src.cat_asset_utilization
    load_assets(facts.where(F.substring("extract_date", 1, 10).isin(*days)) if days else facts, f"{root}/cat_assets")
    every = days or [str(r[0]) for r in daily_active_counts(src).select("_date").distinct().orderBy("_date").collect()]
    if every:
        load_activity(src, f"{root}/activity", every)
    units = write_and_read(stored_units(src, f"{root}/cat_assets"), "units")
    return units, stored_activity(facts.sparkSession, f"{root}/activity") if every else None


if __name__ == "__main__":
    main()
