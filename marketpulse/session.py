"""Session setup and shared scratch locations.

The library never picks a machine-local folder on its own when running on a
cluster: intermediate tables (landed pages, snapshots, stream checkpoints) go
under the shared folder named by ``spark.checkpoint.dir``. Only a local
session may leave that unset (tests, laptops): it gets a temporary folder, which
is removed when the process ends. On a cluster a missing setting is an error.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library wants. Event times are UTC wall-clock
# TIMESTAMP_NTZ values, so the session zone only matters where an ISO string
# with an offset is turned into an instant; pinning UTC keeps that trivial.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    # batches to Python by size too, so that long texts do not add up
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # remove reliable-checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = "local[8]", app_name: str = "marketpulse",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Session with the library defaults.

    ``master=None`` keeps the cluster's master. Shuffle partitions: in local
    mode one per core unless given; on a cluster the cluster's setting is kept
    (size it to the largest shuffle / ~128 MB; AQE coalesces small partitions
    and splits skewed ones at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is None and master and master.startswith("local"):
        cores = master[len("local["):-1] if master.startswith("local[") else "1"
        shuffle_partitions = os.cpu_count() if cores == "*" else int(cores)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="marketpulse-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return local


def is_local(master: str) -> bool:
    """One process: ``local``, ``local[...]``; not ``local-cluster``."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    return f"{ensure_checkpoint_dir(spark)}/marketpulse/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch folders under the shared checkpoint dir (results that still read them are lost)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/marketpulse")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
