"""Sources: declared schemas, parquet readers and the test-data adapters."""

from fleetlens.sources.catalog import FleetSources, derive_from_driver_tables, read_fleet_tables

__all__ = ["FleetSources", "derive_from_driver_tables", "read_fleet_tables"]
