"""Session helpers.

The library never needs session-specific state to compute a report: it uses
TIMESTAMP_NTZ and DATE only, so results do not depend on the session time
zone.  ``build_session`` is the configuration we run tests and the bench with.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library is designed for.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Unit lists and masters are broadcast by the planner's size estimates or by
    # AQE's measurements, within these bounds; only hot-key lists are hinted.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.exchange.reuse": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fleetlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset on a local master (tests) do we create one of our
    own; elsewhere an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if current:
        return current
    master = spark.conf.get("spark.master", None) or (sc.master if sc is not None else "")
    if not str(master).startswith("local") or str(master).startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share; "
                           "a local one would leave each executor with its own files")
    local = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have ``path`` deleted when the driver ends (frames that read it live until then)."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # Spark Connect: the server owns the files
        return
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
