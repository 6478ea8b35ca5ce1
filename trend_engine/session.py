"""Session helpers: building a session for tests/bench and finding the shared scratch root.

The shared root is the cluster's ``spark.checkpoint.dir``. It is read from the running
session; a private directory is only created when the setting is missing (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. UTC keeps hour buckets and string renderings stable.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


# Defaults for large inputs, applied by the jobs only where the submitter set nothing:
# ~256 MB scan splits and post-shuffle partitions, many initial shuffle partitions that AQE
# coalesces (so a multi-TB shuffle never lands in a few huge tasks), skew splitting on.
CLUSTER_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def apply_cluster_defaults(spark: SparkSession) -> None:
    """Set each ``CLUSTER_DEFAULTS`` entry the submitter did not set (runtime SQL settings)."""
    given = spark.sparkContext.getConf()
    for key, value in CLUSTER_DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "trend-engine", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (all stored times are UTC instants)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set (HDFS/S3/…) and every executor can reach it. Only when it is
    unset (unit tests on one machine) a private directory is made and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="trend-engine-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused directory under the shared root."""
    return f"{shared_root(spark)}/trend-engine/{purpose}-{uuid.uuid4().hex}"
