"""Folders for intermediate results that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared folder the cluster names in `spark.checkpoint.dir`.

    Only a session in a single JVM may do without that setting; it gets a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tideline-")
    return f"{root.rstrip('/')}/tideline/{purpose}-{uuid.uuid4().hex}"


def delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Have a folder that is there deleted when the session's program ends.

    It is the driver's file system client that remembers it, so a driver that is killed leaves it.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
