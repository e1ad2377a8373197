"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caselabel")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def workspace(spark: SparkSession, name: str) -> str:
    """Fresh path for a written table in the cluster's shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir``.  Only a local session
    may go without it; there a temporary folder is shared by construction.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "caselabel")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
