"""Spark session defaults and the shared checkpoint folder.

Every job in the library runs on whatever session it is handed; this module
only supplies the settings the plans rely on (UTC session zone, ANSI, AQE,
dynamic partition overwrite) for tests, bench and the driver entry.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library's plans assume. Cluster deployments set the same keys
# in their job config; shuffle partitions are sized there (about 128-256 MB
# of shuffle data per partition at the target scale).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a side partitioned by id needs no new exchange to join on (id, day)
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Spark 4.1: with AQE, reusing a union's output partitioning in a join can
    # fail ("Can't zip RDDs with unequal numbers of partitions")
    "spark.sql.unionOutputPartitioning": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "daybook", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # runtime-settable keys also applied when the session already existed
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.adaptive.enabled",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, conf[k])
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage.
    Only when it is unset and the master is local a scratch folder is created
    and registered; elsewhere it must be set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="daybook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path.removeprefix("file:")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)
