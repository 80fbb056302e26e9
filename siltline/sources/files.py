"""File tables, seeds and the small file-system calls the sinks need."""

from __future__ import annotations

import time
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder that holds ``<name>.parquet``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_seed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A CSV seed with declared column types; an empty cell is NULL. A header or a value that does
    not fit the declaration is an error."""
    return spark.read.schema(schema).options(
        header=True, enforceSchema=False, nullValue="", emptyValue="", mode="FAILFAST"
    ).csv(path)


def layer_path(root: str, layer: str, schema: str, table: str) -> str:
    """Where a table of a layer (bronze, silver, gold) lives."""
    return f"{root.rstrip('/')}/{layer}/{schema}/{table}"


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """Hadoop file system and path object of ``path``, so any supported store works."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, as the file system names them."""
    fs, path = file_system(spark, pattern)
    return [str(status.getPath().toString()) for status in (fs.globStatus(path) or [])]


def removed(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is gone already is no error."""
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def moved(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in another's place, by the file system's own rename."""
    fs, old = file_system(spark, source)
    _, new = file_system(spark, target)
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was changed."""
    fs, hadoop_path = file_system(spark, path)
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    fs, hadoop_path = file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that appears whole or not at all; an existing one is an error."""
    fs, final = file_system(spark, path)
    _, draft = file_system(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise FileExistsError(path)
