"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "veriscope") -> SparkSession:
    """Session with AQE, skew-join handling and Arrow enabled; UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Sizing for large inputs: scan splits and post-shuffle partitions sized to fit
        # executor memory; AQE merges small partitions and splits skewed ones.
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        # Size-checked automatic broadcasts only (the default 10 MB bound, stated).
        "spark.sql.autoBroadcastJoinThreshold": "10m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Remove reliable-checkpoint files once their DataFrame is no longer referenced.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.memory": os.environ.get("VERISCOPE_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``veriscope`` importable in every Python worker (the ``--py-files``
    mechanism): the package is zipped once on the driver and added with
    ``addPyFile``, so executors fetch it from the driver.  Once per application."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="veriscope-pyfiles-"), "veriscope.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read here.  When
    it is unset, a local run gets a private folder and any other master an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="veriscope-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (unique per call)."""
    return f"{checkpoint_root(spark)}/veriscope-{name}-{uuid.uuid4().hex[:12]}"
