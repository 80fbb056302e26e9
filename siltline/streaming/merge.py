"""Changes merged into layer tables, batch by batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import (
    ChangeFeed, added_rows, change_log, changes_to_apply, kept_rows, latest_changes,
    merge_in_sequence, parse_events, passing_changes, quarantined,
)
from ..operators.joins import is_small
from ..sources.keyed_table import KeyedTable
from ..sources.layer_table import LayerTable
from ..sources.staging import staged
from .runs import start


def merge_into(
    table: LayerTable | KeyedTable, changes: DataFrame, keys: Sequence[str],
    batch: tuple[str, int] | None = None, sequence: Sequence[str] = (), written: bool = False,
) -> int:
    """Apply changes (one per key, with ``is_delete``) to a table; its new version.

    Only slots that hold an old or a new row of a changed key are rewritten. The changes are
    written once, since they are counted, joined and added, unless they are ``written`` files
    already. With ``sequence`` a change older than
    the table's row has no effect; the table then keeps those columns and ``is_delete``. A keyed
    table merges by its own partitions.
    """
    if isinstance(table, KeyedTable):
        return table.merge(changes, {batch[0]: batch[1]} if batch else None, sequence, written)
    if not written:
        changes = staged(changes, "changes")
    key = keys[0]
    # Deletes leave a mark of their own only where the sequence is kept.
    lands = F.lit(True) if sequence else ~F.col("is_delete")
    seen = changes.agg(
        F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"),
        # at most one value per slot
        F.collect_set(F.when(lands, table.slot_of())).alias("slots"),
    ).first()
    if seen.n == 0:
        return table.version()
    changed = changes.select(*keys)
    small = is_small(changed)
    if small:
        changed = F.broadcast(changed)

    touched = set(seen.slots)
    if table.slots():
        # The key range reaches the parquet scan and skips row groups without changed keys. Slots with
        # new rows are read anyway.
        near = table.read(table.slots().keys() - touched).where(F.col(key).between(seen.low, seen.high))
        held = near.join(changed, list(keys), "left_semi")
        touched |= {
            r.slot for r in held.select(table.slot_of().alias("slot")).distinct().collect()
        }
    old = table.read(touched)
    if sequence:
        return table.rewrite(merge_in_sequence(old, changes, keys, sequence), touched, batch)
    kept, added = kept_rows(old, changed, keys), added_rows(changes, old.columns)
    if not small:
        return table.rewrite(kept.unionByName(added), touched, batch)
    # Rows kept pass the broadcast join in the tasks that read them, one slot's files after the
    # other, and are written from there; only the added rows are shuffled.
    return table.rewrite(kept.unionByName(table.by_slot(added)), touched, batch, arranged=True)


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query that delivers a batch, which its checkpoint keeps."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


@dataclass(frozen=True)
class SilverMerge:
    """A batch of log rows merged into a cleaned table.

    ``columns`` maps the table's columns to expressions over the log. Upserts that fail a rule go
    to ``quarantine``, a folder, if there is one. A batch that the same query has merged before is
    skipped, so a restarted stream may deliver it again; a new checkpoint is a new query.
    """

    table: LayerTable | KeyedTable
    keys: Sequence[str]
    sequence: Sequence[str]
    columns: Mapping[str, str]
    rules: Mapping[str, str] = field(default_factory=dict)
    quarantine: str | None = None
    remove_failing: bool = False
    guard: bool = False
    writer: str = "silver"

    def __call__(self, log: DataFrame, batch_id: int) -> None:
        writer = f"{self.writer}-{query_id(log)}"
        if self.table.last_batch(writer) >= batch_id:
            return
        latest = staged(latest_changes(log, self.keys, self.sequence), "latest")
        if self.quarantine is not None and self.rules:
            quarantined(latest, self.rules).write.mode("overwrite").parquet(
                f"{self.quarantine}/query={writer}/batch={batch_id}"
            )
        if self.guard and self.rules and not self.remove_failing:
            passing = passing_changes(log, self.rules)
            latest = staged(latest_changes(passing, self.keys, self.sequence), "latest")
        extra = ["is_delete", *(self.sequence if self.guard else ())]
        changes = changes_to_apply(latest, self.rules, self.remove_failing).select(
            *[F.expr(e).alias(name) for name, e in self.columns.items()],
            *[c for c in extra if c not in self.columns],
        )
        merge_into(
            self.table, changes, self.keys, (writer, batch_id),
            self.sequence if self.guard else (), written=True,
        )


def merge_log(
    log: DataFrame, merge: SilverMerge, checkpoint: str, processing_time: str | None = None
) -> StreamingQuery:
    """Merge a stream of log rows into a cleaned table."""
    merge.table.create()
    return start(log.writeStream.foreachBatch(merge), checkpoint, processing_time)


def merge_events(
    events: DataFrame, feed: ChangeFeed, merge: SilverMerge, checkpoint: str,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Merge a stream of event texts into a table directly, without a log in between."""
    log = change_log(parse_events(events, feed.row), feed)
    return merge_log(log, merge, checkpoint, processing_time)
