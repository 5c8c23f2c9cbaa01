"""Shared work area for staging, feeds and journals.

Staging data must live where every executor and a restarted driver can see it, so the
root is the folder the cluster names in ``spark.checkpoint.dir``. Only when a local session
leaves it unset (tests) is a temporary folder made, one a process; the session's settings
are never changed.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

_KEY = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="sluice-work-")


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect: the master is not visible
        return spark.conf.get("spark.master", "").startswith("local")


def work_root(spark: SparkSession) -> str:
    root = spark.conf.get(_KEY, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        if not _is_local(spark):
            # Executors and a restarted driver could not see a driver-local folder.
            raise ValueError(f"set {_KEY} to a folder shared by the cluster (HDFS, object store)")
        root = _local_root()
    return root.rstrip("/")


def new_dir(spark: SparkSession, kind: str) -> str:
    """A fresh, never-reused folder under the shared root (one per run or call)."""
    return f"{work_root(spark)}/sluice/{kind}/{uuid.uuid4().hex}"
