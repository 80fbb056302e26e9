import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltline.operators.changes import (
    ChangeFeed, change_log, changes_to_apply, latest_changes, merge_changes, merge_in_sequence, passing_changes,
    parse_events, quarantined, rejected_events, replay,
)
from siltline.plans import silver
from siltline.plans.feeds import EVENT_ROW, NET_AMOUNT, TRANSACTION_FEED, TRANSACTION_RULES
from siltline.sources.schemas import row_schema

DAY = 86_400_000_000


def event(op, key, amount=10.0, day=1, status="NEW", quantity=1):
    row = {"transaction_id": key, "customer_id": 7, "product_id": 8, "quantity": quantity,
           "amount": amount, "transaction_date": day * DAY, "status": status}
    if op == "d":
        return json.dumps({"before": {"transaction_id": key}, "after": None, "op": op})
    return json.dumps({"before": None, "after": row, "op": op})


FEED = ChangeFeed(
    TRANSACTION_FEED.row, TRANSACTION_FEED.keys, TRANSACTION_FEED.upsert, TRANSACTION_FEED.delete,
    {"_seq": "seq"},
)
COLUMNS = [*FEED.upsert]


def log_of(spark, texts, start=0):
    df = spark.createDataFrame([(t, start + i) for i, t in enumerate(texts)], "value STRING, seq BIGINT")
    return change_log(parse_events(df, FEED.row), FEED)


def state(*batches, rules=None):
    out = replay(list(batches), ["transaction_id"], ["_seq"], COLUMNS, rules)
    return {r.transaction_id: (r.amount, r.status) for r in out.collect()}


def test_row_schema():
    fields = [{"name": "a", "type": "LONG"}, {"name": "b", "type": "string"}]
    assert row_schema(fields).simpleString() == "struct<a:bigint,b:string>"
    with pytest.raises(ValueError):
        row_schema([{"name": "a", "type": "money"}])


def test_row_schema_from_ddl(spark):
    assert len(row_schema(EVENT_ROW).fields) == 7


def test_parsing_leaves_out_what_is_no_event(spark):
    texts = [event("c", 1), "{not json", "", None, '{"op": null}', '{"after": {}, "op": "c"}',
             event("x", 2), "[]"]
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    assert [r.op for r in parse_events(df, EVENT_ROW).collect()] == ["c", "c", "x"]
    assert rejected_events(df, EVENT_ROW).count() == 5


def test_log_projection(spark):
    log = log_of(spark, [event("c", 1, 12.345), event("d", 1), event("c", None), event("x", 3),
                         event("r", 4, 1e12)])
    rows = {r._seq: r for r in log.collect()}
    assert sorted(rows) == [0, 1, 4]
    assert rows[0].amount == Decimal("12.35") and rows[0]._op == "c"
    assert rows[0].transaction_date == datetime(1970, 1, 2)
    assert rows[1].transaction_id == 1 and rows[1].amount is None and rows[1].status is None
    assert rows[4].amount is None  # does not fit decimal(10,2)
    assert rows[0]._ingested_at is not None


def test_last_change_of_a_batch_wins(spark):
    assert state(log_of(spark, [event("c", 1), event("u", 1, 20.0), event("d", 1)])) == {}
    assert state(log_of(spark, [event("d", 1), event("c", 1, 5.0)])) == {1: (Decimal("5.00"), "NEW")}
    assert state(log_of(spark, [event("d", 99)])) == {}


def test_batches_apply_in_their_order(spark):
    first = log_of(spark, [event("c", 1, 1.0), event("c", 2, 2.0), event("c", 3, 3.0)])
    second = log_of(spark, [event("u", 1, 9.0), event("d", 2), event("c", 4, 4.0)], 10)
    want = {1: Decimal("9.00"), 3: Decimal("3.00"), 4: Decimal("4.00")}
    assert {k: v[0] for k, v in state(first, second).items()} == want
    assert {k: v[0] for k, v in state(first, second, second).items()} == want


def test_failing_change_leaves_the_older_row(spark):
    first = log_of(spark, [event("c", 1, 1.0), event("c", 2, 2.0)])
    second = log_of(spark, [event("u", 1, -5.0), event("u", 2, 7.0, status="lost")], 10)
    assert {k: v[0] for k, v in state(first, second, rules=TRANSACTION_RULES).items()} == {
        1: Decimal("1.00"), 2: Decimal("2.00")}
    bad = quarantined(latest_changes(second, ["transaction_id"], ["_seq"]), TRANSACTION_RULES)
    assert {r.transaction_id: r.failed_rule for r in bad.collect()} == {
        1: "amount_positive", 2: "status_accepted"}
    latest = latest_changes(second, ["transaction_id"], ["_seq"])
    removing = changes_to_apply(latest, TRANSACTION_RULES, remove_failing=True)
    target = first.select(*COLUMNS)
    assert merge_changes(target, removing, ["transaction_id"]).count() == 0


@pytest.mark.parametrize("field, value, rule", [
    ("quantity", None, "quantity_positive"), ("status", None, "status_present"),
    ("amount", None, "amount_positive"), ("amount", 0.0, "amount_positive"),
])
def test_null_and_zero_fail_the_rules(spark, field, value, rule):
    log = log_of(spark, [event("c", 1, **{field: value})])
    bad = quarantined(latest_changes(log, ["transaction_id"], ["_seq"]), TRANSACTION_RULES)
    assert [r.failed_rule for r in bad.collect()] == [rule]


def test_net_amount_and_status_case(spark):
    raw = log_of(spark, [event("c", 1, status="cancelled"), event("c", 2, status="Pending"),
                         event("c", 3, status="gone")])
    out = silver.transactions(raw.withColumnRenamed("_seq", "s"), ["s"])
    assert {r.transaction_id: r.net_amount for r in out.collect()} == {
        1: Decimal("0.00"), 2: Decimal("10.00")}
    assert dict(out.dtypes)["net_amount"] == "decimal(10,2)"
    assert NET_AMOUNT.startswith("CASE")


def test_sequence_guard_makes_arrival_order_irrelevant(spark):
    parts = [
        log_of(spark, [event("c", 1, 1.0), event("c", 2, 2.0)], 0),
        log_of(spark, [event("d", 1), event("u", 2, 5.0)], 10),
        log_of(spark, [event("c", 3, 3.0), event("u", 2, 6.0)], 20),
    ]
    results = []
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2], [1, 2, 0, 1]):
        batches = [latest_changes(parts[i], ["transaction_id"], ["_seq"]) for i in order]
        columns = [*COLUMNS, "_seq", "is_delete"]
        table = batches[0].select(*columns)
        for batch in batches[1:]:
            table = merge_in_sequence(table, batch, ["transaction_id"], ["_seq"])
        results.append({r.transaction_id: r.amount for r in table.where("NOT is_delete").collect()})
    assert results == [{2: Decimal("6.00"), 3: Decimal("3.00")}] * 4


@pytest.mark.parametrize("cuts", [[5], [1, 2, 3, 4, 5], [2, 5]])
@pytest.mark.parametrize("order", [1, -1])
def test_guard_with_rules_ignores_batches(spark, cuts, order):
    events = [event("c", 1, 1.0), event("u", 1, -1.0), event("c", 2, -5.0), event("c", 3, 3.0), event("u", 3, 4.0)]
    log, rules = log_of(spark, events), {"positive": "amount > 0"}
    columns, low, batches = [*COLUMNS, "_seq", "is_delete"], 0, []
    first = log.agg(F.min("_seq")).first()[0]
    for high in cuts:
        part = log.where((F.col("_seq") >= first + low) & (F.col("_seq") < first + high))
        batches.append(latest_changes(passing_changes(part, rules), ["transaction_id"], ["_seq"]).select(*columns))
        low = high
    batches = batches[::order]
    table = batches[0]
    for batch in batches[1:]:
        table = merge_in_sequence(table, batch, ["transaction_id"], ["_seq"])
    assert {r.transaction_id: r.amount for r in table.collect()} == {1: Decimal("1.00"), 3: Decimal("4.00")}
