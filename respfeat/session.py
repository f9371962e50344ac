"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    # Wall-clock arithmetic below never depends on the zone, but text rendering does.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window arrays make a task's work much larger than its shuffle bytes suggest.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "respfeat", **conf: str) -> SparkSession:
    """A session with the library's defaults; a cluster's own settings win over them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder for checkpoints and for tables that are written and read back.

    A cluster names a folder all executors share in ``spark.checkpoint.dir``.
    Only a local session without that setting gets a temporary one, since there
    the driver and the executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="respfeat-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table under the shared folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
