"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a single-machine session may do without."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").split("[")[0] == "local":
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="shared-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, written once as Parquet and read again.

    This cuts the lineage, fixes the rows for all later uses, and survives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
