"""Session settings the library relies on.

* UTC session time zone: dates, years and ``date_sk`` derive from UTC instants.
* ANSI on: bad casts and division by zero raise instead of producing garbage.
* AQE with partition coalescing and skew-join splitting, so a hot key (a user or
  title holding a large share of rows) is split at runtime instead of landing in
  one task.
"""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession

# What results depend on: set on any session handed to the library.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# What speed depends on: only for sessions built here, a cluster's own settings stay.
SESSION_DEFAULTS = SEMANTICS | {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the SQL semantics the operators assume (UTC, ANSI)."""
    for key, value in SEMANTICS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "reelhouse", checkpoint_dir: str | None = None,
                  event_log_dir: str | None = None, extra_conf: dict | None = None) -> SparkSession:
    """Session for tests and local runs; on a cluster use the cluster's session
    and call :func:`apply_defaults`."""
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("REELHOUSE_DRIVER_MEMORY", "8g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    for key, value in {**SESSION_DEFAULTS, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it.  Only when it is
    unset in a local-mode session (tests, local runs) is a private folder
    created and registered; on a cluster an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder the cluster can reach") from e
        return configured.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder every executor can "
                               "reach; a machine-local folder does not survive executor loss")
        configured = tempfile.mkdtemp(prefix="reelhouse-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           floor: int = 8) -> int:
    """Shuffle partition count for an input size: ~``target_bytes`` per task.

    At 100 TB this gives ~400k partitions before AQE coalescing, i.e. tasks that
    fit executor memory without spilling heavily.
    """
    return max(floor, int(math.ceil(input_bytes / target_bytes)))


def size_shuffles_for(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Start AQE from enough shuffle partitions for ``input_bytes`` of input
    (~``target_bytes`` each, so tasks fit executor memory without heavy
    spilling); AQE then coalesces small ones towards the advisory size.
    Returns the partition count it set."""
    n = shuffle_partitions_for(input_bytes, target_bytes)
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n = max(n, current)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n
