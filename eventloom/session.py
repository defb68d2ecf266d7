"""Session helpers: a local session for tests/bench and shared scratch locations.

Scratch output (checkpoints, exported files, receipts) always goes below the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
absent in a local session (tests) do we create one, and then we register it so every
later call agrees on it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "eventloom") -> SparkSession:
    """A local session with the settings every test and the bench share."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder. Where none is set, a local session gets a temporary
    folder; on a cluster that is an error, because
    executors could not read what others wrote."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no driver-side context (remote session): use the setting as is
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return root.rstrip("/")
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eventloom-ckpt-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
