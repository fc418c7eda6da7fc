"""Tables replaced as a whole, in versions: ``<root>/v=<number>``.

A new version is written beside the current one and counts once Spark has
committed it (its ``_SUCCESS`` file), so a reader sees the old table or the new one,
and a writer that dies leaves the old one.  One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, folder = _folder(spark, root)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    found = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
    return [n for n in found if fs.exists(_folder(spark, f"{root}/v={n}/_SUCCESS")[1])]


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest version, or None if there is none."""
    known = versions(spark, root)
    return spark.read.parquet(f"{root}/v={known[-1]}") if known else None


def write_snapshot(df: DataFrame, root: str, keep: int = 2) -> DataFrame:
    """``df`` as a new version, read back; versions older than the newest ``keep`` go."""
    spark = df.sparkSession
    known = versions(spark, root)
    number = known[-1] + 1 if known else 1
    # Left by a writer that died: never committed, so nobody reads it.
    df.write.mode("overwrite").parquet(f"{root}/v={number}")
    for old in [*known, number][:-keep]:
        fs, folder = _folder(spark, f"{root}/v={old}")
        fs.delete(folder, True)
    return spark.read.schema(df.schema).parquet(f"{root}/v={number}")
