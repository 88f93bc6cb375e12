"""Spark session settings the concepts rely on.

* ``spark.sql.session.timeZone=UTC``: all clinical times are zone-free
  (TIMESTAMP_NTZ); casting them to TIMESTAMP for epoch arithmetic must not
  shift them.
* ANSI mode stays on (Spark 4 default) so silent overflow cannot happen.
* AQE with skew-join handling: chart events per stay are long-tailed.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings concepts depend on (idempotent)."""
    for key, value in DEFAULT_CONF.items():
        if key == "spark.ui.enabled":
            continue  # static conf, only settable at build time
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder all executors share: ``spark.checkpoint.dir``; where that is unset, a
    folder of the warehouse, which a cluster shares too."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_chartwise"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "chartwise", checkpoint_dir: str | None = None) -> SparkSession:
    """Builder used by tests, bench and the command line (local mode)."""
    master = master or os.environ.get("CHARTWISE_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.driver.memory", os.environ.get("CHARTWISE_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:          # else Spark's setting; AQE joins small partitions
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
