"""Session settings the plans are written for, and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Results do not depend on these; plan shape does.  Sizes (shuffle partitions, memory) belong to
# the cluster and are left to spark-submit.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Product panels are already hash-partitioned by product_id when they are joined on
    # (product_id, date), so that join can keep the partitioning it has.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site of every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "shelfcast", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    """One temporary folder for the process, removed when it ends."""
    root = tempfile.mkdtemp(prefix="shelfcast-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, below the folder named in ``spark.checkpoint.dir``.

    Executors on every machine must see it, so a temporary folder stands in only for local masters.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
