"""Write an intermediate once and read it back (cuts lineage).

The table goes under the session's checkpoint directory, the shared folder
a cluster names in ``spark.checkpoint.dir``; a lost executor then costs no
recomputation of the upstream plan.  It is deleted when the driver ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from fleetlens.session import delete_at_exit, ensure_checkpoint_dir


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/fleetlens/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
