"""Writing a report table (the reports' sink: a table a BI tool imports)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.plans.snapshots import _folder

#: Folder of the rows without a date.
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def write_report(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """Write a report as parquet; daily reports can be laid out by ``_date``
    so a dashboard reading a date range prunes partitions."""
    if partition_by:
        # Rows of a date gather in few tasks; AQE splits a date that is too large (or the NULL one).
        df = df.hint("rebalance", partition_by)
    w = df.write.mode(mode)
    if partition_by:
        # The whole table is replaced, whatever the session's setting for partitions.
        w = w.option("partitionOverwriteMode", "static").partitionBy(partition_by)
    w.parquet(path)


def replace_days(df: DataFrame, path: str, days: Sequence[str | None], partition_by: str = "_date") -> None:
    """Replace the given days of a daily table by their rows in ``df``; files of all other days stay as they are.

    ``None`` stands for rows without a day.  Rows of other days in ``df`` are not
    written.  Spark stages the new files and moves a day's folder into place when the job
    commits, so a run that fails or is killed before that changes nothing, and running a day again gives the
    same table.  A day that has no rows any more loses its folder.
    """
    days = list(dict.fromkeys(None if d is None else str(d) for d in days))
    named = [d for d in days if d is not None]
    day = F.col(partition_by)
    wanted = day.isin(*[F.lit(d).cast("date") for d in named]) if named else F.lit(False)
    if None in days:
        wanted = F.coalesce(wanted, F.lit(False)) | day.isNull()
    rows = df.where(wanted)
    rows.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition_by).parquet(path)
    spark = df.sparkSession
    written = {r[0] for r in rows.select(day.cast("string")).distinct().collect()}
    for d in days:
        if d not in written:
            fs, folder = _folder(spark, f"{path.rstrip('/')}/{partition_by}={_NO_DATE if d is None else d}")
            fs.delete(folder, True)
