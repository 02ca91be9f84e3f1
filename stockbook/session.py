"""Session defaults that matter for correctness and for scale.

Only settings that are unset are filled in, so a cluster's own
configuration (shuffle partitions, checkpoint directory, ...) wins.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on; applied only where the session leaves them unset.
_DEFAULTS = {
    # Dates and zone-less timestamps must not move with the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn a sort-merge join into a broadcast join when a side proves small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the aggregation after it then
    # needs its own shuffle: the sales sums reuse the order_id partitioning of
    # their join, and a hot order would otherwise stay in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Plan-time broadcasts stay at the session's own size limit; a join side that
    # proves small at run time may be broadcast up to this many measured bytes.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def get_session(master: str | None = None, app_name: str = "stockbook",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, creating a local one for tests if needed."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # Static: the Python call-site capture behind DataFrame error contexts
    # costs several JVM round trips per Column built on the driver.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    # Remove a reliable checkpoint's files once its DataFrame is garbage collected.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    conf = spark.conf
    for key, value in _DEFAULTS.items():
        if conf.get(key, None) in (None, ""):
            conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``; a scratch folder only on one machine.

    On a cluster this must be a shared, fault-tolerant folder (HDFS, object
    store), so a session on a cluster that names none is refused. Under Spark
    Connect the server owns the setting and nothing is changed here.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context
        return None
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="stockbook-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
