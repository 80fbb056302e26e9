"""Session defaults. Partition counts are left to adaptive execution, never fixed here."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "siltline", cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given.

    Its checkpoint folder is one machine's, which is all a local session needs."""
    extra.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="siltline-"))
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", os.environ.get("SILTLINE_DRIVER_MEMORY", "8g"))
    return builder.getOrCreate()
