"""Change topics. The parser of the events is separate and takes any frame with a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(
    servers: str, topic: str, starting_offsets: str = "earliest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream of event texts with their position, the order in which changes of a key apply."""
    raw = spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def read_event_files(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of event texts from files with one JSON event per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)
