"""Starting, watching and bounding streaming queries."""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class TooManyRejected(RuntimeError):
    """More events were rejected than a run allows."""


class RunWatch(StreamingQueryListener):
    """Counts of a run, from the metrics that its batches observe under ``name``: ``seen`` and
    ``rejected`` events, and ``batches``.

    ``most_rejected`` is the share of rejected events that ends the run as failed, looked at from
    ``from_events`` events on.
    """

    def __init__(self, name: str = "events", most_rejected: float = 1.0, from_events: int = 1):
        self.name, self.most_rejected, self.from_events = name, most_rejected, from_events
        self.seen = self.rejected = self.batches = 0
        self.run: str | None = None
        self.news, self.ended = threading.Event(), threading.Event()

    def follow(self, query: StreamingQuery) -> RunWatch:
        """Count this run from now on; earlier counts stay."""
        self.run = str(query.runId)
        self.news.clear()
        self.ended.clear()
        return self

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) != self.run:
            return
        counts = progress.observedMetrics.get(self.name)
        if counts is not None:
            self.seen += counts.seen
            self.rejected += counts.rejected
        self.batches += 1
        self.news.set()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            self.ended.set()
            self.news.set()

    def rejects_too_many(self) -> bool:
        return self.seen >= self.from_events and self.rejected > self.most_rejected * self.seen


def start(
    writer: DataStreamWriter, checkpoint: str, processing_time: str | None = None
) -> StreamingQuery:
    """Start a query that works off what there is and ends, or one that runs every so often."""
    writer = writer.option("checkpointLocation", checkpoint)
    if processing_time is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()


def finish(
    query: StreamingQuery, seconds: float | None = None, watch: RunWatch | None = None,
    grace: float = 60.0,
) -> StreamingQuery:
    """Wait for a query, at most ``seconds``; what is left is done by the next run from the same
    checkpoint. An error in the query is raised here.

    With a ``watch`` the run ends after the batch that is under way when the time is over (``grace``
    seconds later at the latest), and fails with :class:`TooManyRejected` as soon as a batch leaves too
    many rejected events behind.
    """
    if watch is not None:
        return _watched(query, seconds, watch, grace)
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
    return query


def _watched(query: StreamingQuery, seconds: float | None, watch: RunWatch, grace: float) -> StreamingQuery:
    streams = SparkSession.active().streams
    watch.follow(query)
    streams.addListener(watch)
    begun = time.monotonic()
    try:
        while query.isActive and not watch.rejects_too_many():
            left = None if seconds is None else begun + seconds - time.monotonic()
            if left is not None and left <= 0:
                watch.news.clear()
                watch.news.wait(max(0.0, left + grace))  # the batch under way
                break
            watch.news.wait(1.0 if left is None else min(1.0, left))
            watch.news.clear()
        if query.isActive:
            query.stop()
        else:
            query.awaitTermination()  # raises what ended the query
        watch.ended.wait(10.0)  # the last counts arrive after the query's end
    finally:
        streams.removeListener(watch)
    if watch.rejects_too_many():
        raise TooManyRejected(f"{watch.rejected} of {watch.seen} events rejected")
    return query

