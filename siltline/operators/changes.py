"""Change events: parsing, the change log, the latest state per key and its merge into a table.

All functions work on batch frames and, where no ordering is involved, on streams as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import RowSpec, envelope_schema
from .latest import latest_per_key

# Operation letters of change events.
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"


@dataclass(frozen=True)
class ChangeFeed:
    """How the events of one source table become rows.

    ``upsert`` and ``delete`` map output columns to SQL expressions over ``src``, the row after a
    change and the row before a delete. ``sequence`` maps columns that order the changes of a key
    to expressions over the event (``before``, ``after``, ``op`` and the source's own columns).
    """

    row: RowSpec
    keys: Sequence[str]
    upsert: Mapping[str, str]
    delete: Mapping[str, str]
    sequence: Mapping[str, str] = field(default_factory=dict)


def parse_events(
    events: DataFrame, row: RowSpec, text: str = "value", observed: str | None = None
) -> DataFrame:
    """JSON events to ``before``, ``after``, ``op``, next to the source's other columns.

    Events without an operation, malformed ones among them, are left out; see
    :func:`rejected_events`. Under the name ``observed`` the run reports how many events it has
    ``seen`` and ``rejected``.
    """
    parsed = F.from_json(F.col(text).cast("string"), envelope_schema(row))
    rest = [c for c in events.columns if c != text]
    # A filter on a projected from_json is pushed below it and parses every text a second time;
    # it is not pushed below a generator.
    flat = events.select(*rest, F.inline(F.array(parsed)))
    if observed is not None:
        flat = flat.observe(
            observed, F.count("*").alias("seen"), F.count_if(F.col("op").isNull()).alias("rejected")
        )
    return flat.where("op IS NOT NULL")


def rejected_events(events: DataFrame, row: RowSpec, text: str = "value") -> DataFrame:
    """The texts that :func:`parse_events` leaves out."""
    parsed = F.from_json(F.col(text).cast("string"), envelope_schema(row))
    return events.where(parsed["op"].isNull())


def change_log(events: DataFrame, feed: ChangeFeed) -> DataFrame:
    """Parsed events as rows of the append-only log: one projection, one pass.

    Columns a delete does not carry are NULL. Events with an unknown operation or an incomplete key
    are left out. Adds ``_op``, ``_ingested_at`` and the feed's sequence columns.
    """
    is_delete = F.col("op") == DELETE_OP
    with_src = events.where(F.col("op").isin(*UPSERT_OPS, DELETE_OP)).withColumn(
        "src", F.when(is_delete, F.col("before")).otherwise(F.col("after"))
    )
    columns = [
        F.when(is_delete, F.expr(feed.delete[name]) if name in feed.delete else F.lit(None))
        .otherwise(F.expr(expression)).alias(name)
        for name, expression in feed.upsert.items()
    ]
    log = with_src.select(
        *columns,
        F.col("op").alias("_op"),
        F.current_timestamp().alias("_ingested_at"),
        *[F.expr(e).alias(name) for name, e in feed.sequence.items()],
    )
    return log.dropna("any", subset=list(feed.keys))


def latest_changes(
    log: DataFrame, keys: Sequence[str], sequence: Sequence[str | Column]
) -> DataFrame:
    """The last change of each key, with ``is_delete``."""
    last = latest_per_key(log.dropna("any", subset=list(keys)), keys, sequence)
    return last.withColumn("is_delete", F.col("_op") == DELETE_OP)


def with_failed_rule(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add ``failed_rule``: the first rule a row does not meet (NULL counts as not met)."""
    tests = [
        F.when(~F.coalesce(F.expr(expression), F.lit(False)), F.lit(name))
        for name, expression in rules.items()
    ]
    return df.withColumn("failed_rule", F.coalesce(*tests, F.lit(None).cast("string")))


def passing_changes(log: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Deletes, and upserts that meet all rules.

    What a guarded merge ranks: a failing upsert then hides no older change of its key, in whatever
    batches they come.
    """
    judged = with_failed_rule(log, rules)
    return judged.where((F.col("_op") == DELETE_OP) | F.col("failed_rule").isNull()).drop("failed_rule")


def changes_to_apply(
    latest: DataFrame, rules: Mapping[str, str], remove_failing: bool = False
) -> DataFrame:
    """Latest changes that take effect: deletes, and upserts that meet all rules.

    An upsert that fails leaves the key's older row in place; with ``remove_failing`` it takes the
    key out, as a delete does.
    """
    judged = with_failed_rule(latest, rules)
    failing = ~F.col("is_delete") & F.col("failed_rule").isNotNull()
    if remove_failing:
        return judged.withColumn("is_delete", F.col("is_delete") | failing).drop("failed_rule")
    return judged.where(~failing).drop("failed_rule")


def quarantined(latest: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Latest upserts that meet not all rules, with the name of the first rule they fail."""
    return with_failed_rule(latest.where(~F.col("is_delete")), rules).where(
        "failed_rule IS NOT NULL"
    )


def kept_rows(target: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key no change concerns; ``changed`` has the changes' keys."""
    return target.join(changed, list(keys), "left_anti").select(*target.columns)


def added_rows(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """New and updated rows."""
    return changes.where(~F.col("is_delete")).select(*columns)


def merge_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], changed: DataFrame | None = None
) -> DataFrame:
    """``target`` after update, insert and delete by key, in one join.

    ``target`` and ``changes`` each have one row per key; ``changes`` has ``is_delete`` and, for
    upserts, every column of the target. ``changed`` gives just the keys, where they are cheaper to
    get than through ``changes``.
    """
    gone = changes.select(*keys) if changed is None else changed
    return kept_rows(target, gone, keys).unionByName(added_rows(changes, target.columns))


def merge_in_sequence(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]
) -> DataFrame:
    """Merge in which a change applies only if it is not older than the row it meets.

    ``target`` keeps the sequence columns and ``is_delete``: deleted keys stay as marks, so that a
    late older change cannot bring them back. The order in which batches arrive has no effect on
    the result, with rules if ``changes`` are the latest of :func:`passing_changes`. ``where("NOT is_delete")`` gives the current rows.
    """
    both = target.withColumn("_new", F.lit(0)).unionByName(
        changes.select(*target.columns).withColumn("_new", F.lit(1))
    )
    return latest_per_key(both, keys, [*sequence, "_new"]).drop("_new")


def replay(
    batches: Sequence[DataFrame], keys: Sequence[str], sequence: Sequence[str | Column],
    columns: Sequence[str], rules: Mapping[str, str] | None = None,
) -> DataFrame:
    """State after applying batches of a change log one after the other, starting from nothing."""
    def state(df: DataFrame) -> DataFrame:
        return changes_to_apply(latest_changes(df, keys, sequence), rules or {})

    first = state(batches[0]).where(~F.col("is_delete")).select(*columns)
    return reduce(lambda t, b: merge_changes(t, state(b), keys), batches[1:], first)

