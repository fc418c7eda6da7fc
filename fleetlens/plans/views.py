"""Expose the reports (and the nine sources) to Spark SQL as temp views."""

from __future__ import annotations

from dataclasses import fields

from fleetlens.plans import reports
from fleetlens.sources.catalog import FleetSources


def register_views(src: FleetSources, as_of: str | None = None, prefix: str = "") -> list[str]:
    """Create temp views ``<prefix>fleet_list``, ``utilization``, ``hours``,
    ``fuel`` and one per source table; returns the view names."""
    names = []
    for f in fields(src):
        getattr(src, f.name).createOrReplaceTempView(prefix + f.name)
        names.append(prefix + f.name)
    built = {
        "fleet_list": reports.fleet_list(src, ordered=False, materialize=False),
        "utilization": reports.utilization(src, as_of, ordered=False, materialize=False),
        "hours": reports.hours(src, ordered=False, materialize=False),
        "fuel": reports.fuel(src, ordered=False, materialize=False),
    }
    for name, df in built.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
