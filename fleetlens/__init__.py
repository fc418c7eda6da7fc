"""fleetlens: fleet telemetry reports as Spark DataFrame jobs.

Every operator is a function from DataFrames to a DataFrame built from
``pyspark.sql.functions`` built-ins, so Catalyst plans the whole report and
the work scales with the cluster.  Entry points live in ``fleetlens.plans``.
"""

from fleetlens.session import build_session

__all__ = ["build_session"]
