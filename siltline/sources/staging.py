"""Staged tables: results written to the cluster's shared folder and read back.

Used where a result is needed more than once and must be the same each time. Written files outlive
a lost executor, which cached blocks do not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of our own only in unconfigured local runs."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="siltline-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark)}/siltline/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a frame that reads the written files."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
