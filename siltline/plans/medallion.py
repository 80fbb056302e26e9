"""The whole job, layer by layer: as a batch over copied tables, and as streams over changes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from .. import quality as dq
from ..operators.changes import ChangeFeed
from ..sources.databases import ingest_tables
from ..sources.files import layer_path
from ..sources.keyed_table import KeyedTable
from ..sources.layer_table import LayerTable
from ..streaming.bronze import append_log, log_frame, read_log
from ..streaming.merge import SilverMerge, merge_log
from ..streaming.runs import RunWatch, finish
from ..streaming.upkeep import Dimension, KeptMetric, maintain_fact, sync
from . import gold, silver
from .feeds import GOLD_SCHEMA, NET_AMOUNT, SILVER_SCHEMA, TRANSACTION_DAY, TRANSACTION_KEYS, TRANSACTION_RULES


def key_rules(key: str) -> list[dq.Rule]:
    return [dq.not_null(key), dq.unique(key)]


def publish(
    spark: SparkSession, path: str, rows: DataFrame, rules: Iterable[dq.Rule] = ()
) -> LayerTable:
    """Replace a table, after its rules hold on the written rows."""
    table, rules = LayerTable(spark, path, rows.schema), list(rules)
    table.replace(rows, (lambda df: dq.Suite(df, rules).enforce()) if rules else None)
    return table


def run_batch(
    spark: SparkSession,
    read_source: Callable[[str], DataFrame],
    transactions: DataFrame,
    root: str,
    schema: str = "sales",
    newest: Mapping[str, Sequence[str | Column]] | None = None,
) -> dict[str, LayerTable]:
    """Copy the customers and products, clean them, and build the metric tables.

    ``transactions`` are the cleaned transactions. ``newest`` has, for customers and products, the
    order that finds the newest version of a key; it should be total, ``updated_at`` alone leaves
    versions of one moment to chance. A table whose rules fail is not published, and
    nothing that depends on it is built.
    """
    order = {"customers": ("updated_at",), "products": ("updated_at",), **(newest or {})}
    raw = ingest_tables(spark, read_source, ["customers", "products"], root, schema)

    def path(layer: str, table: str) -> str:
        return layer_path(root, layer, schema, table)

    customers = publish(
        spark, path("silver", "customers"), silver.customers(raw["customers"].read(), order["customers"]),
        key_rules("customer_id"),
    )
    products = publish(
        spark, path("silver", "products"), silver.products(raw["products"].read(), order["products"]),
        key_rules("product_id"),
    )
    dq.Suite(transactions, key_rules("transaction_id")).enforce()
    done = {"customers": customers, "products": products}
    for name, rows, rules in [
        ("daily_summary", gold.daily_summary(transactions), []),
        ("customer_metrics", gold.customer_metrics(transactions, customers.read()), []),
        ("product_performance", gold.product_performance(transactions, products.read()), []),
    ]:
        done[name] = publish(spark, path("gold", name), rows, rules)
    return done


@dataclass(frozen=True)
class StreamLayout:
    """Where the streaming job keeps its tables and checkpoints."""

    root: str
    schema: str = "sales"
    name: str = "transactions"
    slot: str = TRANSACTION_DAY
    buckets: int = 4

    def table(self, layer: str, name: str | None = None) -> str:
        return layer_path(self.root, layer, self.schema, name or self.name)

    def checkpoint(self, layer: str) -> str:
        return layer_path(self.root, "checkpoints", f"{layer}/{self.schema}", self.name)


def silver_merge(
    spark: SparkSession, layout: StreamLayout, sequence: Sequence[str], **options
) -> SilverMerge:
    names = [part.split()[0] for part in SILVER_SCHEMA.split(", ")]
    return SilverMerge(
        table=KeyedTable(
            spark, layout.table("silver"), SILVER_SCHEMA, TRANSACTION_KEYS, layout.slot, layout.buckets
        ),
        keys=TRANSACTION_KEYS,
        sequence=sequence,
        columns={n: n for n in names if n != "net_amount"} | {"net_amount": NET_AMOUNT},
        rules=TRANSACTION_RULES,
        quarantine=layout.table("quarantine"),
        **options,
    )


def run_streams(
    spark: SparkSession,
    events: DataFrame,
    feed: ChangeFeed,
    layout: StreamLayout,
    customers: DataFrame,
    products: DataFrame,
    seconds: float | None = None,
    max_files_per_trigger: int | None = None,
    propagate_deletes: bool = False,
    watch: RunWatch | None = None,
    once_within: str | None = None,
    **merge_options,
) -> dict[str, KeyedTable | KeptMetric]:
    """Work off a stream of change events: log, cleaned transactions, fact, daily metrics.

    Each layer handles what is there and ends; a further call goes on from the checkpoints.
    ``customers`` and ``products`` are what they are now: the rows that differ from the last call are
    merged into tables of the job. Fact and metrics are kept by the changes of all these tables.
    ``watch`` counts the events and can fail the run before anything is merged; ``once_within`` leaves
    out events that the source sends again.
    """
    bronze = append_log(
        events, feed, layout.table("bronze"), layout.checkpoint("bronze"), once_within=once_within
    )
    finish(bronze, seconds, watch)
    merge = silver_merge(spark, layout, list(feed.sequence), **merge_options)
    log = read_log(
        spark, layout.table("bronze"), log_frame(events, feed).schema, max_files_per_trigger
    )
    finish(merge_log(log, merge, layout.checkpoint("silver")), seconds)
    dimensions = []
    for name, rows, key, columns in (
        ("customers", customers, "customer_id", ["full_name", "country", "city"]),
        ("products", products, "product_id", ["product_name", "category", "brand"]),
    ):
        rows = rows.select(key, *columns)
        table = KeyedTable(spark, layout.table("dimensions", name), rows.schema, [key], buckets=layout.buckets)
        sync(table, rows)
        dimensions.append(Dimension(table, key, columns))
    fact = KeyedTable(
        spark, layout.table("gold"), GOLD_SCHEMA, TRANSACTION_KEYS, layout.slot, layout.buckets
    )
    maintain_fact(
        merge.table, fact, dimensions,
        lambda rows: gold.fact_transactions(rows, *[d.table.read() for d in dimensions]),
        propagate_deletes,
    )
    daily = KeptMetric(
        merge.table, layout.table("gold", "daily_summary"), gold.DAILY, gold.DAILY_COLUMNS, layout.buckets
    )
    daily.refresh()
    return {"silver": merge.table, "gold": fact, "daily_summary": daily}
