"""Spark session defaults and the shared working folder.

Everything in the library takes a ``SparkSession`` as an argument; this module only
builds one for tests, the bench and scripts, and resolves where intermediate tables
may be written.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings every job relies on: ANSI semantics (bad casts fail loudly unless a
# ``try_`` form is used), UTC wall clock, adaptive execution for runtime re-planning
# (partition coalescing, skew-join splitting, runtime broadcast of measured small sides).
CORE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: planner estimates are off (no broadcast from
    # them); AQE broadcasts a join side after its shuffle stage has run and its real
    # size is known to be under the limit.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # The limit is compared with compressed shuffle bytes, so it is kept low.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


# Defaults for a cluster reading tens of terabytes, applied when the master is not local
# and the deployment has not set them. AQE coalesces the shuffle partitions down to about
# the advisory size, so the initial count only has to be large enough for the biggest
# shuffle (20k x 256 MB = 5 TB per shuffle before skew splitting); scans read ~512 MB
# splits, which column pruning shrinks further.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "martworks",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` (set by spark-submit); ``CLUSTER_CONF`` then
    fills in what the deployment has not set, and AQE sizes partitions at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    local = bool(master and master.startswith("local"))
    if local:
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in conf.items():
        # an existing session keeps its static settings; re-apply the runtime ones
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    if not local:
        deployed = spark.sparkContext.getConf()
        for key, value in CLUSTER_CONF.items():
            # what the deployment (spark-submit, spark-defaults) set wins
            if key not in conf and not deployed.contains(key):
                spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage. Only when
    it is unset (local runs and tests) a folder of our own is created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster intermediate tables need a folder "
            "that the driver and all executors share"
        )
    local = tempfile.mkdtemp(prefix="martworks-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return sc.getCheckpointDir() or local


_SCRATCH = threading.local()


def _work_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/work/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder.

    What is written there stays until :func:`clear_work`, or until the end of the
    :func:`scratch` block that it was asked for in.
    """
    path = f"{_work_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    blocks = getattr(_SCRATCH, "blocks", [])
    if blocks:
        blocks[-1].append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, every work path that this thread asked for in it.

    Results that are still to be read must be written elsewhere before the block ends.
    """
    _SCRATCH.blocks = [*getattr(_SCRATCH, "blocks", []), []]
    try:
        yield
    finally:
        for path in _SCRATCH.blocks.pop():
            remove_path(spark, path)


def clear_work(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; for the end of a job."""
    remove_path(spark, _work_folder(spark))


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(target).isDirectory()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
