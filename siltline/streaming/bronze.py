"""Change events into the append-only log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.changes import ChangeFeed, change_log, parse_events
from .runs import start

LOG_DAY = "_ingested_day"


def log_frame(events: DataFrame, feed: ChangeFeed) -> DataFrame:
    """Rows of the log for a stream or a batch of event texts. The query's progress reports the
    events seen and rejected."""
    log = change_log(parse_events(events, feed.row, observed="events"), feed)
    return log.withColumn(LOG_DAY, F.to_date("_ingested_at"))


def once(log: DataFrame, feed: ChangeFeed, within: str) -> DataFrame:
    """Each change of a stream once, though a source sends it again in another batch or file.

    Changes are the same that agree in key, operation and the feed's sequence columns and arrive at
    most ``within`` (an interval) after the first. Spark's state store keeps their positions for that
    long, also over a restart.
    """
    if not feed.sequence:
        raise ValueError("the feed has no sequence columns to know a change by")
    position = [*feed.keys, "_op", *feed.sequence]
    return log.withWatermark("_ingested_at", within).dropDuplicatesWithinWatermark(position)


def append_log(
    events: DataFrame, feed: ChangeFeed, folder: str, checkpoint: str,
    processing_time: str | None = None, once_within: str | None = None,
) -> StreamingQuery:
    """Append a stream of events to the log below ``folder``.

    The file sink commits each batch once, so a restart after a failure repeats no rows;
    ``once_within`` also leaves out events that the source itself repeats, see :func:`once`.
    """
    log = log_frame(events, feed)
    if once_within is not None:
        log = once(log, feed, once_within)
    writer = log.writeStream.format("parquet").outputMode("append")
    return start(writer.option("path", folder).partitionBy(LOG_DAY), checkpoint, processing_time)


def read_log(
    spark: SparkSession, folder: str, schema: StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The log as a stream of committed rows."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)
