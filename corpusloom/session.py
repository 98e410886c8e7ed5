"""Session defaults and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(
    app: str = "corpusloom", master: str | None = None, conf: dict | None = None
) -> SparkSession:
    """A session with adaptive execution on; ``master=None`` keeps spark-submit's."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Plans may hold constants of 65,536 keys; keep their printed form short.
        "spark.sql.maxPlanStringLength": "1000000",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="corpusloom-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared folder.

    The folder is the one named in ``spark.checkpoint.dir``. A machine-local
    folder is only made up for local masters, where driver and executors are one
    process; on a cluster a missing setting is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        root = _local_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
