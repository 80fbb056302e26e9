"""Change events of users: parsing, log, latest state, merges and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import (
    change_log, changes_to_apply, latest_changes, merge_changes, merge_in_sequence, parse_events, passing_changes,
    quarantined, rejected_events, replay,
)
from ..sources.files import read_table
from ..sources.keyed_table import KeyedTable
from ..sources.staging import new_folder, staged
from ..sources.topics import read_event_files
from ..streaming.bronze import append_log, log_frame, read_log
from ..streaming.merge import SilverMerge, merge_events, merge_log
from ..streaming.runs import finish
from . import Workload
from .tables import LOG_SQL, OPS_SQL, USER_FEED, USER_SEQUENCE, user_events

work = Workload()

STATE = ["user_id", "kind", "amount", "happened_at"]
STATE_SCHEMA = "user_id BIGINT, kind STRING, amount DECIMAL(10,2), happened_at TIMESTAMP"
RULES = {"amount_present": "amount IS NOT NULL", "amount_worthwhile": "amount >= 20"}
STATE_SQL = "user_id, kind, CAST(amount AS DOUBLE) AS amount, happened_at"
RANKED_SQL = LOG_SQL + """, ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY _seq_time DESC NULLS LAST, _seq_id DESC NULLS LAST) AS rn
  FROM log)"""
CURRENT_SQL = f"WITH {RANKED_SQL} SELECT {STATE_SQL} FROM ranked WHERE rn = 1 AND _op <> 'd'"


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return change_log(parse_events(user_events(spark, folder), USER_FEED.row), USER_FEED)


@work.add("cdc_parse_envelope", f"""
SELECT op, CASE WHEN op = 'd' THEN user_id END AS user_before,
       CASE WHEN op <> 'd' THEN user_id END AS user_after,
       CASE WHEN op <> 'd' THEN value END AS value_after,
       event_id
FROM (SELECT *, {OPS_SQL} AS op FROM events)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_events(user_events(spark, folder), USER_FEED.row)
    return parsed.select(
        "op", F.col("before.user_id").alias("user_before"),
        F.col("after.user_id").alias("user_after"), F.col("after.value").alias("value_after"),
        F.coalesce("before.event_id", "after.event_id").alias("event_id"),
    )


@work.add("cdc_rejected_events", """
SELECT md5(text) AS text_hash, count(*) AS n FROM conversations GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Events mixed with texts that are not events."""
    texts = read_table(spark, folder, "conversations").select(F.col("text").alias("value"))
    mixed = user_events(spark, folder).unionByName(texts)
    rejected = rejected_events(mixed, USER_FEED.row)
    return rejected.groupBy(F.md5("value").alias("text_hash")).agg(F.count("*").alias("n"))


@work.add("cdc_bronze_log", f"""
WITH {LOG_SQL}
SELECT user_id, kind, CAST(amount AS DOUBLE) AS amount, happened_at, _op, _seq_id FROM log""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _log(spark, folder).select(*STATE, "_op", "_seq_id")


@work.add("cdc_op_counts", f"""
WITH {LOG_SQL}
SELECT _op, _op = 'd' AS is_delete, count(*) AS n, count(amount) AS n_amount FROM log GROUP BY 1, 2""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _log(spark, folder).groupBy(
        "_op", (F.col("_op") == "d").alias("is_delete")
    ).agg(F.count("*").alias("n"), F.count("amount").alias("n_amount"))


@work.add("cdc_latest_per_key", f"""
WITH {RANKED_SQL} SELECT {STATE_SQL}, _op, _op = 'd' AS is_delete FROM ranked WHERE rn = 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return latest_changes(_log(spark, folder), ["user_id"], USER_SEQUENCE).select(
        *STATE, "_op", "is_delete"
    )


@work.add("cdc_quarantine", f"""
WITH {RANKED_SQL}
SELECT {STATE_SQL}, CASE WHEN amount IS NULL THEN 'amount_present' ELSE 'amount_worthwhile' END
  AS failed_rule
FROM ranked WHERE rn = 1 AND _op <> 'd' AND (amount >= 20) IS NOT TRUE""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    latest = latest_changes(_log(spark, folder), ["user_id"], USER_SEQUENCE)
    return quarantined(latest, RULES).select(*STATE, "failed_rule")


# Batches of the replay: the weeks of the month.
WEEK_SQL = "CAST((_seq_time - 1704067200000000) // 604800000000 AS BIGINT)"
REPLAY_SQL = f"""
WITH {LOG_SQL}, per_batch AS (
  SELECT *, row_number() OVER (
    PARTITION BY user_id, {WEEK_SQL} ORDER BY _seq_time DESC, _seq_id DESC) AS rn
  FROM log
), effective AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {WEEK_SQL} DESC) AS last
  FROM per_batch WHERE rn = 1 AND (_op = 'd' OR amount >= 20)
)
SELECT {STATE_SQL} FROM effective WHERE last = 1 AND _op <> 'd'"""


def _weeks(log: DataFrame) -> list[DataFrame]:
    """The log cut into batches: four weeks, and the rest of the month."""
    log = staged(log, "log")  # each batch reads its part of the written log
    start, week = 1_704_067_200_000_000, 604_800_000_000
    at = F.col("_seq_time")
    cuts = [start + i * week for i in range(1, 5)]
    return [
        log.where(at < cuts[0]),
        *[log.where((at >= a) & (at < b)) for a, b in zip(cuts, cuts[1:])],
        log.where(at >= cuts[-1]),
    ]


@work.add("cdc_apply_upserts_deletes", REPLAY_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Batches merged one after the other; an upsert below the rules leaves the older row."""
    return replay(_weeks(_log(spark, folder)), ["user_id"], USER_SEQUENCE, STATE, RULES)


@work.add("cdc_remove_failing", f"""
WITH {RANKED_SQL} SELECT {STATE_SQL} FROM ranked WHERE rn = 1 AND _op <> 'd' AND amount >= 20""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """As above, but an upsert below the rules takes its key out."""
    log = _log(spark, folder)
    weeks = [
        changes_to_apply(latest_changes(w, ["user_id"], USER_SEQUENCE), RULES, remove_failing=True)
        for w in _weeks(log)
    ]
    state = weeks[0].where("NOT is_delete").select(*STATE)
    for week in weeks[1:]:
        state = merge_changes(state, week, ["user_id"])
    return state


@work.add("cdc_sequence_guard", CURRENT_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that arrive newest first end in the same state."""
    columns = [*STATE, "is_delete", *USER_SEQUENCE]
    late_first = list(reversed(_weeks(_log(spark, folder))))
    batches = [latest_changes(w, ["user_id"], USER_SEQUENCE) for w in late_first]
    state = batches[0].select(*columns)
    for batch in batches[1:]:
        state = merge_in_sequence(state, batch, ["user_id"], USER_SEQUENCE)
    return state.where("NOT is_delete").select(*STATE)


@work.add("cdc_guard_with_rules", f"""
WITH {LOG_SQL}, passing AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _seq_time DESC, _seq_id DESC) AS rn
  FROM log WHERE _op = 'd' OR amount >= 20)
SELECT {STATE_SQL} FROM passing WHERE rn = 1 AND _op <> 'd'""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The newest change that meets the rules wins, whatever batches the changes come in."""
    columns = [*STATE, "is_delete", *USER_SEQUENCE]
    batches = [latest_changes(passing_changes(w, RULES), ["user_id"], USER_SEQUENCE).select(*columns)
               for w in reversed(_weeks(_log(spark, folder)))]
    state = batches[0]
    for batch in batches[1:]:
        state = merge_in_sequence(state, batch, ["user_id"], USER_SEQUENCE)
    return state.where("NOT is_delete").select(*STATE)


def _landed(spark: SparkSession, folder: str, files: int = 4) -> str:
    landing = new_folder(spark, "events")
    user_events(spark, folder).repartition(files).write.text(landing)
    return landing


GUARDED = STATE_SCHEMA + ", _seq_time BIGINT, _seq_id BIGINT, is_delete BOOLEAN"


@work.add("cdc_stream_log", f"""
WITH {LOG_SQL}
SELECT user_id, kind, CAST(amount AS DOUBLE) AS amount, happened_at, _op, _seq_id FROM log""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The log as written by the stream, two files per batch."""
    root = new_folder(spark, "log")
    events = read_event_files(spark, _landed(spark, folder), max_files_per_trigger=2)
    finish(append_log(events, USER_FEED, f"{root}/log", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/log").select(*STATE, "_op", "_seq_id")


@work.add("cdc_stream_once", f"""
WITH {LOG_SQL}
SELECT user_id, kind, CAST(amount AS DOUBLE) AS amount, happened_at, _op, _seq_id FROM log""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Events that the source sends a second time, in other files and after a restart."""
    root, landing = new_folder(spark, "once"), _landed(spark, folder)
    for _ in range(2):
        events = read_event_files(spark, landing, max_files_per_trigger=2)
        finish(append_log(events, USER_FEED, f"{root}/log", f"{root}/checkpoint", once_within="1 day"))
        user_events(spark, folder).repartition(3).write.mode("append").text(landing)
    return spark.read.parquet(f"{root}/log").select(*STATE, "_op", "_seq_id")


@work.add("cdc_stream_silver", CURRENT_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Events to log to table, both as streams of several batches in whatever order."""
    root = new_folder(spark, "silver")
    events = read_event_files(spark, _landed(spark, folder), max_files_per_trigger=2)
    finish(append_log(events, USER_FEED, f"{root}/log", f"{root}/checkpoint/log"))
    table = KeyedTable(spark, f"{root}/table", GUARDED, ["user_id"], buckets=8)
    merge = SilverMerge(
        table, ["user_id"], USER_SEQUENCE, {c: c for c in STATE}, guard=True,
    )
    log = read_log(spark, f"{root}/log", log_frame(events, USER_FEED).schema)
    finish(merge_log(log, merge, f"{root}/checkpoint/table"))
    return table.read().where("NOT is_delete").select(*STATE)


@work.add("cdc_direct_upsert_stream", CURRENT_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Events merged into the table without a log, three files per batch."""
    root = new_folder(spark, "direct")
    events = read_event_files(spark, _landed(spark, folder), max_files_per_trigger=3)
    table = KeyedTable(spark, f"{root}/table", GUARDED, ["user_id"], buckets=8)
    merge = SilverMerge(
        table, ["user_id"], USER_SEQUENCE, {c: c for c in STATE}, guard=True, writer="direct",
    )
    finish(merge_events(events, USER_FEED, merge, f"{root}/checkpoint"))
    return table.read().where("NOT is_delete").select(*STATE)
