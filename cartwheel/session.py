"""Session factory and the few settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the models depend on for correct results (not tuning):
#   UTC session time zone — dates are UTC dates of instants;
#   ANSI mode — arithmetic errors raise instead of silently nulling.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Scale settings. AQE re-plans at runtime: coalesces small shuffle partitions,
# splits skewed join partitions, and turns a sort-merge join into a broadcast
# join only when the *measured* side is below the threshold.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cartwheel", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the required and scale settings.

    On a cluster, ``master`` is left to spark-submit and shuffle partitions
    should be sized to ~128-256 MB of shuffle data per partition.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **SCALE_CONF, "spark.ui.enabled": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a private folder; on a cluster a
    missing setting is an error, since executors would not share such a folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="cartwheel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local
