"""Session set-up and the folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "variantry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; `conf` wins over them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Recording the calling line of every expression slows down building wide plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Family names such as "007" must come back as text.
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder the cluster names for intermediate tables.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="variantry-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

