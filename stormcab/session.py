"""Spark session settings the models rely on.

The models themselves are written to be independent of the session zone
(NTZ timestamps, field arithmetic), but a session built here also pins UTC so
that any ad-hoc SQL a user writes on the marts behaves the same way.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ~128 MB per shuffle partition after AQE coalescing; AQE splits skewed
    # partitions above 5x the median (and 256 MB) in sort-merge joins
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    # scan splits of at most 128 MB (Parquet row groups are the unit)
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # files of checkpoints go when their frame is no longer used
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # rows to Python workers by bytes too, so that long texts do not come ten thousand at a time
    "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "stormcab",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    `shuffle_partitions` is the initial shuffle width: size it for the largest
    shuffle (about input bytes / 128 MB; e.g. 10 TB of trips -> ~80,000) and
    AQE coalesces it down to the advisory size for smaller stages.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (`spark.checkpoint.dir`).

    Only a local session without one (a test), where one machine is all there is,
    gets a folder of its own; on a cluster that would be lost to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp")))
    return spark.sparkContext.getCheckpointDir()
