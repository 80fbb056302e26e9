"""Laws of the streams: chunking, replay, restart and order change nothing in the result."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltline.operators.changes import ChangeFeed
from siltline.plans import gold, silver
from siltline.plans.feeds import GOLD_SCHEMA, SILVER_SCHEMA, TRANSACTION_FEED
from siltline.plans.medallion import StreamLayout, run_streams, silver_merge
from siltline.sources.layer_table import LayerTable
from siltline.sources.topics import read_event_files
from siltline.streaming.bronze import append_log
from siltline.streaming.gold import merge_fact
from siltline.streaming.merge import SilverMerge, merge_events, merge_into
from siltline.streaming.runs import RunWatch, TooManyRejected, finish, start
from siltline.workloads import layers

from .test_changes import event

FEED = ChangeFeed(
    "transaction_id BIGINT, customer_id INT, product_id INT, quantity INT, amount DOUBLE, "
    "transaction_date BIGINT, status STRING, seq BIGINT",
    TRANSACTION_FEED.keys, TRANSACTION_FEED.upsert, TRANSACTION_FEED.delete,
    {"_seq": "coalesce(after.seq, before.seq)"},
)


def numbered(texts, start=0):
    """Events with their number inside the row, as a source position."""
    return [t.replace('{"transaction_id"', f'{{"seq": {start + i}, "transaction_id"', 1)
            for i, t in enumerate(texts)]


def land(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def some_events(n, seed=1):
    rng = random.Random(seed)
    return numbered([
        event(rng.choice("cuurd"), rng.randrange(12), amount=float(rng.randrange(1, 50)),
              day=rng.randrange(1, 6)) for _ in range(n)
    ])


def expected(texts):
    import json
    state = {}
    for text in texts:
        e = json.loads(text)
        if e["op"] == "d":
            state.pop(e["before"]["transaction_id"], None)
        else:
            state[e["after"]["transaction_id"]] = Decimal(e["after"]["amount"]).quantize(Decimal("0.01"))
    return state


def amounts(table):
    rows = table.read()
    if "is_delete" in rows.columns:
        rows = rows.where("NOT is_delete")
    return {r.transaction_id: r.amount for r in rows.collect()}


@pytest.fixture
def empty_dimensions(spark):
    customers = spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in silver.CUSTOMER_TYPES.items()))
    products = spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in silver.PRODUCT_TYPES.items()))
    return customers, products


def test_whole_stream_with_restart(spark, tmp_path, empty_dimensions):
    texts = some_events(90)
    landing, layout = tmp_path / "in", StreamLayout(str(tmp_path / "lake"))

    def run():
        return run_streams(spark, read_event_files(spark, str(landing)), FEED, layout,
                           *empty_dimensions)

    land(landing, "a.json", texts[:60])
    done = run()
    assert amounts(done["silver"]) == expected(texts[:60])
    version = done["silver"].version()
    run()  # nothing new: nothing is delivered again
    assert done["silver"].version() == version
    land(landing, "b.json", texts[60:])
    done = run()
    assert amounts(done["silver"]) == expected(texts)
    # Gold keeps facts that silver has deleted since.
    gone = expected(texts[:60]).keys() - expected(texts).keys()
    assert amounts(done["gold"]).keys() == expected(texts).keys() | gone
    assert {k: v for k, v in amounts(done["gold"]).items() if k not in gone} == expected(texts)
    daily = done["daily_summary"].read()
    assert daily.agg(F.sum("total_transactions")).first()[0] == len(expected(texts))
    again = gold.daily_summary(done["silver"].read())
    assert daily.exceptAll(again.select(daily.columns)).count() == 0
    assert spark.read.parquet(layout.table("bronze")).count() == 90


@pytest.mark.parametrize("files, order", [(1, 1), (4, 1), (4, -1), (9, 1)])
def test_guarded_merge_ignores_chunks_and_order(spark, tmp_path, files, order):
    texts = some_events(72, seed=3)
    landing = tmp_path / "in"
    size = -(-len(texts) // files)
    chunks = [texts[i:i + size] for i in range(0, len(texts), size)][::order]
    table = LayerTable(spark, str(tmp_path / "t"),
                       SILVER_SCHEMA.replace(", net_amount DECIMAL(10,2)", "")
                       + ", _seq BIGINT, is_delete BOOLEAN", "transaction_date")
    merge = SilverMerge(table, ["transaction_id"], ["_seq"], {c: c for c in FEED.upsert}, guard=True)
    for i, chunk in enumerate(chunks):
        land(landing, f"{i}.json", chunk)
        events = read_event_files(spark, str(landing))
        finish(merge_events(events, FEED, merge, str(tmp_path / "checkpoint")))
    assert amounts(table) == expected(texts)


def test_batch_delivered_twice_changes_nothing(spark, tmp_path):
    merge = silver_merge(spark, StreamLayout(str(tmp_path)), ["_seq"])
    merge.table.create()
    from siltline.operators.changes import change_log, parse_events
    df = spark.createDataFrame([(t,) for t in some_events(30)], "value STRING")
    log = change_log(parse_events(df, FEED.row), FEED)
    merge(log, 0)
    version, state = merge.table.version(), amounts(merge.table)
    merge(log, 0)
    assert merge.table.version() == version
    merge(log, 1)  # the same changes in a new batch
    assert amounts(merge.table) == state


def test_quarantine_of_the_stream(spark, tmp_path):
    layout = StreamLayout(str(tmp_path))
    merge = silver_merge(spark, layout, ["_seq"])
    merge.table.create()
    from siltline.operators.changes import change_log, parse_events
    texts = numbered([event("c", 1), event("c", 2, amount=-1.0), event("c", 3, status="cancelled")])
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    merge(change_log(parse_events(df, FEED.row), FEED), 0)
    assert sorted(amounts(merge.table)) == [1, 3]
    assert merge.table.read().where("transaction_id = 3").first().net_amount == 0
    bad = spark.read.parquet(layout.table("quarantine")).collect()
    assert [(r.transaction_id, r.failed_rule) for r in bad] == [(2, "amount_positive")]


def test_log_reports_rejected_events(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "a.json", [*some_events(7), "{broken", "no event"])
    events = read_event_files(spark, str(landing))
    query = finish(append_log(events, FEED, str(tmp_path / "log"), str(tmp_path / "cp")))
    metrics = [p["observedMetrics"]["events"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["seen"] for m in metrics) == 9 and sum(m["rejected"] for m in metrics) == 2
    assert spark.read.parquet(str(tmp_path / "log")).count() == 7


def test_log_is_written_once_across_runs(spark, tmp_path):
    landing = tmp_path / "in"
    for i in range(3):
        land(landing, f"{i}.json", some_events(10, seed=i))
        events = read_event_files(spark, str(landing), max_files_per_trigger=1)
        finish(append_log(events, FEED, str(tmp_path / "log"), str(tmp_path / "cp")))
        assert spark.read.parquet(str(tmp_path / "log")).count() == 10 * (i + 1)


def test_new_checkpoint_is_a_new_query(spark, tmp_path):
    """Batch numbers start again with a new checkpoint; its batches must not be taken for old ones."""
    landing, layout = tmp_path / "in", StreamLayout(str(tmp_path / "lake"))
    merge = silver_merge(spark, layout, ["_seq"])
    land(landing, "a.json", numbered([event("c", 1, 1.0)]))
    finish(merge_events(read_event_files(spark, str(landing)), FEED, merge, str(tmp_path / "cp1")))
    land(landing, "b.json", numbered([event("c", 2, 2.0)], 5))
    finish(merge_events(read_event_files(spark, str(landing)), FEED, merge, str(tmp_path / "cp2")))
    assert sorted(amounts(merge.table)) == [1, 2]
    # The same batch number of the first query is still known.
    version = merge.table.version()
    finish(merge_events(read_event_files(spark, str(landing)), FEED, merge, str(tmp_path / "cp2")))
    assert merge.table.version() == version
    assert len(merge.table.marks()) == 2


def test_bounded_run_goes_on_later(spark, tmp_path):
    landing = tmp_path / "in"
    for i in range(3):
        land(landing, f"{i}.json", some_events(5, seed=i))
    seen = []
    events = read_event_files(spark, str(landing), max_files_per_trigger=1)

    def writer():
        return events.writeStream.foreachBatch(lambda df, i: seen.append(df.count()))

    query = finish(start(writer(), str(tmp_path / "cp"), processing_time="1 hour"), seconds=20)
    assert not query.isActive
    finish(start(writer(), str(tmp_path / "cp")), seconds=300)
    assert sum(seen) == 15


def test_merge_rewrites_only_touched_days(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path / "t"), "id BIGINT, at DATE, v INT", "at")

    def changes(*lines):
        df = spark.createDataFrame(lines, "id BIGINT, at STRING, v INT, is_delete BOOLEAN")
        return df.withColumn("at", F.col("at").cast("date"))

    table.create()
    merge_into(table, changes(*[(i, f"2024-01-0{1 + i % 5}", i, False) for i in range(20)]), ["id"])
    before = table.slots()
    # key 0 moves from day 1 to day 3, key 1 (day 2) is deleted, key 99 is unknown
    merge_into(table, changes((0, "2024-01-03", 100, False), (1, None, None, True),
                              (99, None, None, True)), ["id"], ("w", 3))
    after = table.slots()
    assert sorted(s for s in after if after[s] != before[s]) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    rows = {r.id: (str(r.at), r.v) for r in table.read().collect()}
    assert len(rows) == 19 and rows[0] == ("2024-01-03", 100) and 1 not in rows
    assert table.last_batch("w") == 3
    version = table.version()
    assert merge_into(table, changes((0, None, None, True)).where("false"), ["id"]) == version


def test_small_merge_does_not_shuffle_the_table(spark, tmp_path, monkeypatch):
    table = LayerTable(spark, str(tmp_path / "t"), "id BIGINT, at DATE, v INT", "at")
    days = spark.range(3000).select(
        "id", F.expr("date_add(DATE '2024-01-01', CAST(id % 30 AS INT))").alias("at"),
        F.lit(1).alias("v"))
    table.replace(days)
    plans = []
    write = LayerTable._write

    def watched(self, rows, arranged=False):
        plans.append((arranged, rows._jdf.queryExecution().executedPlan().toString()))
        return write(self, rows, arranged)

    monkeypatch.setattr(LayerTable, "_write", watched)
    few = days.where("id % 100 = 0").withColumns({"v": F.lit(2), "is_delete": F.col("id") < 300})
    merge_into(table, few, ["id"])
    (arranged, plan), = plans
    kept, rest = plan.split("BroadcastExchange")
    assert arranged and "LeftAnti" in kept and "hashpartitioning" not in kept
    assert rest.count("hashpartitioning") == 1  # the added rows
    assert table.read().agg(F.count("*"), F.sum("v")).first() == (2997, 2997 + 27)
    plans.clear()
    monkeypatch.setattr("siltline.streaming.merge.is_small", lambda df: False)
    merge_into(table, few, ["id"])
    assert not plans[0][0]
    assert table.read().agg(F.count("*"), F.sum("v")).first() == (2997, 2997 + 27)


def test_fact_merge_modes(spark, tmp_path, empty_dimensions):
    source = LayerTable(spark, str(tmp_path / "s"), SILVER_SCHEMA, "transaction_date").create()
    fact = LayerTable(spark, str(tmp_path / "g"), GOLD_SCHEMA, "transaction_date")

    def build(rows):
        return gold.fact_transactions(rows, *empty_dimensions)

    def txn(*pairs):
        return spark.createDataFrame(
            [(i, 1, 1, 1, Decimal(a), f"2024-01-0{d} 00:00:00", "NEW", Decimal(a)) for i, d, a in pairs],
            "transaction_id BIGINT, customer_id INT, product_id INT, quantity INT, "
            "amount DECIMAL(10,2), transaction_date STRING, status STRING, net_amount DECIMAL(10,2)",
        ).withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))

    source.replace(txn((1, 1, 10), (2, 2, 20), (3, 3, 30)))
    merge_fact(source, fact, build)
    source.rewrite(txn((1, 1, 11)), ["2024-01-01", "2024-01-02"])
    untouched = fact.slots()["2024-01-03"]
    merge_fact(source, fact, build, changed_only=True)
    assert amounts(fact) == {1: 11, 2: 20, 3: 30}
    assert fact.slots()["2024-01-03"] == untouched
    version = fact.version()
    assert merge_fact(source, fact, build, changed_only=True) == version
    merge_fact(source, fact, build)
    assert amounts(fact) == {1: 11, 2: 20, 3: 30}
    merge_fact(source, fact, build, propagate_deletes=True)
    assert amounts(fact) == {1: 11, 3: 30}


def test_events_sent_again_are_logged_once(spark, tmp_path):
    """Repeated in the same file, in another one, and after a restart."""
    landing, texts = tmp_path / "in", some_events(30)
    land(landing, "a.json", [*texts[:20], *texts[5:10]])
    land(landing, "b.json", texts[10:25])

    def run():
        events = read_event_files(spark, str(landing), max_files_per_trigger=1)
        finish(append_log(events, FEED, str(tmp_path / "log"), str(tmp_path / "cp"), once_within="1 hour"))
        log = spark.read.parquet(str(tmp_path / "log"))
        return log.count(), log.select("transaction_id", "_op", "_seq").distinct().count()

    assert run() == (25, 25)
    land(landing, "c.json", texts[15:])
    assert run() == (30, 30)
    with pytest.raises(ValueError):
        unordered = ChangeFeed(FEED.row, FEED.keys, FEED.upsert, FEED.delete)
        append_log(read_event_files(spark, str(landing)), unordered, "x", "y", once_within="1 hour")


def test_watched_run_counts_and_fails(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "a.json", [*some_events(8), "{broken", "no event"])

    def log(name):
        return append_log(read_event_files(spark, str(landing)), FEED, str(tmp_path / name), str(tmp_path / f"cp-{name}"))

    watch = RunWatch(most_rejected=0.5)
    finish(log("a"), watch=watch)
    assert (watch.seen, watch.rejected) == (10, 2) and watch.batches >= 1
    with pytest.raises(TooManyRejected, match="2 of 10"):
        finish(log("b"), watch=RunWatch(most_rejected=0.1))
    finish(log("c"), watch=RunWatch(most_rejected=0.1, from_events=11))


def test_watched_run_ends_between_batches(spark, tmp_path):
    """Batches that were begun are done; the rest is for the next run."""
    landing, seen = tmp_path / "in", []
    for i in range(6):
        land(landing, f"{i}.json", some_events(5, seed=i))

    def query():
        events = read_event_files(spark, str(landing), max_files_per_trigger=1)

        def slow(df, i):
            import time
            n = df.count()
            time.sleep(2)
            seen.append((i, n))
        return start(events.writeStream.foreachBatch(slow), str(tmp_path / "cp"))

    first = query()
    finish(first, seconds=3, watch=RunWatch())
    done = len(seen)
    assert not first.isActive and 0 < done < 6
    finish(query(), watch=RunWatch())
    assert {i for i, _ in seen} == set(range(6)) and len(seen) <= 7  # at most the one that was cut short comes again


def test_events_land_compressed(spark, monkeypatch):
    """The landed events are the largest thing the streaming query writes."""
    events = spark.createDataFrame([(f'{{"op": "c", "n": {i}}}',) for i in range(50)], "value STRING")
    folders = []

    def landed(spark, folder):
        folders.append(folder)
        raise InterruptedError

    monkeypatch.setattr(layers, "transaction_events", lambda spark, folder: events)
    monkeypatch.setattr(layers, "read_event_files", landed)
    with pytest.raises(InterruptedError):
        layers.work.queries["medallion_stream"](spark, "none")
    found = spark.read.text(folders[0])
    assert all(f.endswith(".gz") for f in found.inputFiles())
    assert sorted(found.collect()) == sorted(events.collect())


def test_merge_looks_for_old_rows_in_other_slots_only(spark, tmp_path, monkeypatch):
    table = LayerTable(spark, str(tmp_path / "t"), "id BIGINT, at DATE, v INT", "at")
    days = spark.range(30).select("id", F.expr("date_add(DATE '2024-01-01', CAST(id % 3 AS INT))").alias("at"), F.lit(1).alias("v"))
    table.replace(days)
    reads, read = [], LayerTable.read

    def watched(self, slots=None):
        reads.append(slots if slots is None else set(slots))
        return read(self, slots)

    monkeypatch.setattr(LayerTable, "read", watched)
    moved = spark.createDataFrame([(0, 9, False), (4, 9, False)], "id BIGINT, v INT, is_delete BOOLEAN")
    merge_into(table, moved.withColumn("at", F.expr("DATE '2024-01-03'")), ["id"])
    assert reads[0] == {"2024-01-01", "2024-01-02"}
    rows = {r.id: (str(r.at), r.v) for r in read(table).collect()}
    assert len(rows) == 30 and rows[0] == rows[4] == ("2024-01-03", 9) and rows[1] == ("2024-01-02", 1)
