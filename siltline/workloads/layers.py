"""Cleaned tables, metrics, the fact, and the two whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import ChangeFeed, merge_changes
from ..operators.latest import latest_per_key
from ..plans import gold, silver
from ..plans.feeds import GOLD_SCHEMA, SILVER_SCHEMA, TRANSACTION_FEED, TRANSACTION_KEYS
from ..plans.medallion import StreamLayout, run_batch, run_streams
from ..sources.files import read_seed, read_table
from ..sources.keyed_table import KeyedTable
from ..sources.layer_table import LayerTable
from ..sources.staging import new_folder, staged
from ..sources.topics import read_event_files
from ..streaming.gold import merge_fact, refresh_metrics
from ..streaming.merge import merge_into
from ..streaming.upkeep import Dimension, KeptMetric, Metric, maintain_fact, sync
from . import Workload
from .tables import (
    CUSTOMERS_SQL, LATEST_SQL, PRODUCTS_SQL, SILVER_SQL, TRANSACTION_ORDER,
    raw_customers, raw_products, raw_transactions, silver_customers, silver_products,
    silver_transactions,
)

work = Workload()

TXN_COLUMNS = """CAST(transaction_id AS BIGINT) AS transaction_id,
  CAST(customer_id AS BIGINT) AS customer_id, CAST(product_id AS BIGINT) AS product_id,
  CAST(quantity AS BIGINT) AS quantity, CAST(amount AS DOUBLE) AS amount, transaction_date, status"""


@work.add("silver_dedup_latest", f"WITH {LATEST_SQL} SELECT {TXN_COLUMNS} FROM latest")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(raw_transactions(spark, folder), TRANSACTION_KEYS, TRANSACTION_ORDER)


@work.add("silver_net_amount_quality", f"""
WITH {SILVER_SQL}
SELECT {TXN_COLUMNS}, CAST(net_amount AS DOUBLE) AS net_amount FROM silver""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return silver_transactions(spark, folder)


@work.add("silver_quarantine", f"""
WITH {LATEST_SQL}
SELECT {TXN_COLUMNS},
  CASE WHEN amount IS NULL OR amount <= 0 THEN 'amount_positive'
       WHEN quantity IS NULL OR quantity <= 0 THEN 'quantity_positive'
       WHEN status IS NULL THEN 'status_present' ELSE 'status_accepted' END AS failed_rule
FROM latest
WHERE (amount > 0 AND quantity > 0 AND status IS NOT NULL
  AND upper(status) IN ('COMPLETED', 'PENDING', 'CANCELLED', 'NEW')) IS NOT TRUE""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return silver.transaction_quarantine(raw_transactions(spark, folder), TRANSACTION_ORDER)


@work.add("silver_customers", f"""
WITH {CUSTOMERS_SQL}
SELECT * REPLACE (CAST(customer_id AS BIGINT) AS customer_id,
                  CAST(CAST(birth_date AS DATE) AS VARCHAR) AS birth_date)
FROM customers""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return silver_customers(spark, folder)


@work.add("silver_products", f"""
WITH {PRODUCTS_SQL}
SELECT * REPLACE (CAST(product_id AS BIGINT) AS product_id,
                  CAST(unit_price AS DOUBLE) AS unit_price, CAST(cost_price AS DOUBLE) AS cost_price)
FROM products""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return silver_products(spark, folder)


# Average to cents, rounded half up in whole numbers.
AVERAGE_SQL = """CAST((2 * CAST(sum(net_amount) * 100 AS HUGEINT) + count(*)) // (2 * count(*))
       AS DOUBLE) / 100"""

DAILY_SQL = f"""daily AS (
  SELECT CAST(transaction_date AS DATE) AS metric_date, count(*) AS total_transactions,
         CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
         CAST(sum(quantity) AS BIGINT) AS total_quantity,
         count(*) FILTER (WHERE upper(status) = 'CANCELLED') AS cancelled_count,
         count(*) FILTER (WHERE upper(status) = 'PENDING') AS pending_count,
         {AVERAGE_SQL} AS avg_order_value
  FROM silver GROUP BY 1)"""

DAILY_RESULT_SQL = f"""
WITH {SILVER_SQL}, {DAILY_SQL}
SELECT * REPLACE (CAST(metric_date AS VARCHAR) AS metric_date) FROM daily"""


@work.add("gold_daily_summary", DAILY_RESULT_SQL)
def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_summary(silver_transactions(spark, folder))


@work.add("gold_daily_dense", f"""
WITH {SILVER_SQL}, {DAILY_SQL}, days AS (
  SELECT CAST(unnest(generate_series(min(metric_date), max(metric_date), INTERVAL 1 DAY)) AS DATE)
    AS metric_date
  FROM daily)
SELECT CAST(days.metric_date AS VARCHAR) AS metric_date,
       coalesce(total_transactions, 0) AS total_transactions,
       coalesce(total_revenue, 0) AS total_revenue, coalesce(total_quantity, 0) AS total_quantity,
       coalesce(cancelled_count, 0) AS cancelled_count,
       coalesce(pending_count, 0) AS pending_count, avg_order_value
FROM days LEFT JOIN daily ON days.metric_date = daily.metric_date""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dense_daily_summary(silver_transactions(spark, folder))


CUSTOMER_METRICS_SQL = f"""
WITH {SILVER_SQL}, {CUSTOMERS_SQL}, totals AS (
  SELECT customer_id, min(transaction_date) AS first_purchase_date,
         max(transaction_date) AS last_purchase_date, count(*) AS total_orders,
         CAST(sum(net_amount) AS DOUBLE) AS total_spent, {AVERAGE_SQL} AS avg_order_value
  FROM silver GROUP BY customer_id)
SELECT CAST(t.customer_id AS BIGINT) AS customer_id, full_name, country, city, customer_segment,
       first_purchase_date, last_purchase_date, total_orders, total_spent, avg_order_value
FROM totals t LEFT JOIN customers c ON t.customer_id = c.customer_id"""


@work.add("gold_customer_metrics", CUSTOMER_METRICS_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return gold.customer_metrics(
        silver_transactions(spark, folder), silver_customers(spark, folder)
    )


PRODUCT_PERFORMANCE_SQL = f"""
WITH {SILVER_SQL}, {PRODUCTS_SQL}, totals AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
         count(*) AS total_transactions, CAST(sum(net_amount) AS DOUBLE) AS total_revenue
  FROM silver GROUP BY product_id)
SELECT CAST(t.product_id AS BIGINT) AS product_id, product_name, category, brand, color,
       CAST(unit_price AS DOUBLE) AS unit_price, total_quantity_sold, total_transactions,
       total_revenue
FROM totals t LEFT JOIN products p ON t.product_id = p.product_id"""


@work.add("gold_product_performance", PRODUCT_PERFORMANCE_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return gold.product_performance(
        silver_transactions(spark, folder), silver_products(spark, folder)
    )


FACT_SQL = f"""{SILVER_SQL}, {CUSTOMERS_SQL}, {PRODUCTS_SQL}, fact AS (
  SELECT transaction_id, transaction_date, CAST(s.customer_id AS BIGINT) AS customer_id,
         full_name AS customer_name, country, city, CAST(s.product_id AS BIGINT) AS product_id,
         product_name, category, brand, CAST(quantity AS BIGINT) AS quantity,
         CAST(amount AS DOUBLE) AS amount, CAST(net_amount AS DOUBLE) AS net_amount, status
  FROM silver s LEFT JOIN customers c ON s.customer_id = c.customer_id
  LEFT JOIN products p ON s.product_id = p.product_id)"""


def fact(spark: SparkSession, folder: str, transactions: DataFrame | None = None) -> DataFrame:
    """The cleaned tables are written, as in the whole job: they are counted and then joined."""
    if transactions is None:
        transactions = staged(silver_transactions(spark, folder), "transactions")
    return gold.fact_transactions(
        transactions,
        staged(silver_customers(spark, folder), "customers"),
        staged(silver_products(spark, folder), "products"),
    )


@work.add("gold_fact_transactions", f"WITH {FACT_SQL} SELECT * FROM fact")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fact(spark, folder)


@work.add("gold_fact_merge", f"""
WITH {FACT_SQL}, held AS (
  SELECT transaction_id, min(transaction_date) AS transaction_date,
         CAST(NULL AS BIGINT) AS customer_id, 'earlier' AS customer_name,
         CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS city,
         CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS VARCHAR) AS product_name,
         CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS brand,
         CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(amount) AS DOUBLE) AS amount,
         CAST(sum(amount) AS DOUBLE) AS net_amount, min(status) AS status
  FROM raw GROUP BY transaction_id)
SELECT * FROM fact
UNION ALL
SELECT * FROM held WHERE transaction_id NOT IN (SELECT transaction_id FROM fact)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The fact merged into an earlier one that also has transactions held back since."""
    transactions = staged(silver_transactions(spark, folder), "transactions")
    new = fact(spark, folder, transactions)
    earlier = raw_transactions(spark, folder).groupBy("transaction_id").agg(
        F.min("transaction_date").alias("transaction_date"),
        F.lit("earlier").alias("customer_name"),
        F.sum("quantity").cast("int").alias("quantity"),
        F.sum("amount").alias("amount"), F.sum("amount").alias("net_amount"),
        F.min("status").alias("status"),
    )
    kinds = {f.name: f.dataType for f in new.schema.fields}
    wide = earlier.select(*[
        F.col(c) if c in earlier.columns else F.lit(None).cast(kinds[c]).alias(c)
        for c in new.columns
    ])
    return merge_changes(
        wide, new.withColumn("is_delete", F.lit(False)), TRANSACTION_KEYS,
        transactions.select(*TRANSACTION_KEYS),
    )


def _by_year(spark: SparkSession, folder: str, root: str) -> tuple[DataFrame, LayerTable]:
    """The cleaned transactions, and a table that holds those before 1999 so far."""
    transactions = staged(silver_transactions(spark, folder), "transactions")
    table = LayerTable(
        spark, f"{root}/silver", SILVER_SCHEMA, "date_trunc('YEAR', transaction_date)"
    )
    table.replace(transactions.where("year(transaction_date) < 1999"))
    return transactions, table


def _add_the_rest(transactions: DataFrame, table: LayerTable) -> None:
    later = transactions.where("year(transaction_date) >= 1999 OR transaction_date IS NULL")
    merge_into(table, later.withColumn("is_delete", F.lit(False)), TRANSACTION_KEYS)


@work.add("gold_daily_incremental", DAILY_RESULT_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The daily summary built for some years, then brought up to date for those added."""
    root = new_folder(spark, "daily")
    transactions, table = _by_year(spark, folder, root)
    metrics = LayerTable(
        spark, f"{root}/daily", gold.daily_summary(transactions).schema,
        "date_trunc('YEAR', metric_date)",
    )
    refresh_metrics(table, metrics, gold.daily_summary)
    _add_the_rest(transactions, table)
    refresh_metrics(table, metrics, gold.daily_summary)
    return metrics.read()


@work.add("gold_fact_incremental", f"WITH {FACT_SQL} SELECT * FROM fact")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The fact merged for some years, then for the slots that changed since."""
    root = new_folder(spark, "fact")
    transactions, table = _by_year(spark, folder, root)
    customers = staged(silver_customers(spark, folder), "customers")
    products = staged(silver_products(spark, folder), "products")

    def build(rows: DataFrame) -> DataFrame:
        return gold.fact_transactions(rows, customers, products)

    held = LayerTable(
        spark, f"{root}/fact", GOLD_SCHEMA, "date_trunc('YEAR', transaction_date)"
    )
    merge_fact(table, held, build)
    _add_the_rest(transactions, table)
    table.expire(1, 0)  # the listing that the fact was made from is gone: all slots count as changed
    merge_fact(table, held, build, changed_only=True)
    return held.read()


def _changing(spark: SparkSession, folder: str, root: str) -> tuple[KeyedTable, DataFrame]:
    """A keyed table of transactions that is wrong in many rows, and the changes that mend it: rows
    of later years are missing, some amounts and dates are others, and some rows must go."""
    true = staged(silver_transactions(spark, folder), "transactions")
    table = KeyedTable(
        spark, f"{root}/silver", SILVER_SCHEMA, TRANSACTION_KEYS, "date_trunc('YEAR', transaction_date)", 4
    )
    key = F.col("transaction_id")
    early = true.where("year(transaction_date) < 1998").withColumns({
        "net_amount": F.when(key % 7 == 0, F.col("net_amount") + 1000).otherwise(F.col("net_amount")),
        "transaction_date": F.when(key % 11 == 0, F.col("transaction_date") - F.expr("INTERVAL 900 DAYS"))
        .when(key % 13 == 0, F.col("transaction_date") + F.expr("INTERVAL 3000 DAYS")).otherwise(F.col("transaction_date")),
    })
    extra = true.where(key % 17 == 0).withColumns({
        "transaction_id": -key, "transaction_date": F.col("transaction_date") - F.expr("INTERVAL 4000 DAYS")})
    table.replace(early.unionByName(extra))
    changed = "transaction_id % 7 = 0 OR transaction_id % 11 = 0 OR transaction_id % 13 = 0 " \
              "OR transaction_date IS NULL OR year(transaction_date) >= 1998"
    mended = true.where(changed).withColumn("is_delete", F.lit(False))
    return table, mended.unionByName(extra.withColumn("is_delete", F.lit(True)))


def _kept(spark: SparkSession, folder: str, metric: Metric, columns: dict[str, str]) -> DataFrame:
    """A metric computed once, then kept through a merge by its signed rows."""
    root = new_folder(spark, "kept")
    table, changes = _changing(spark, folder, root)
    kept = KeptMetric(table, f"{root}/metric", metric, columns, buckets=4)
    kept.refresh()
    table.merge(changes)
    kept.refresh()
    return kept.read()


@work.add("keyed_table_merge", f"""
WITH {SILVER_SQL}
SELECT {TXN_COLUMNS}, CAST(net_amount AS DOUBLE) AS net_amount FROM silver""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions in partitions by year and key bucket, mended by one merge."""
    table, changes = _changing(spark, folder, new_folder(spark, "merge"))
    table.merge(changes)
    return table.read()


@work.add("gold_daily_by_deltas", DAILY_RESULT_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(spark, folder, gold.DAILY, gold.DAILY_COLUMNS)


@work.add("gold_customers_by_deltas", CUSTOMER_METRICS_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """First and last purchases are computed anew only where a removed row held them."""
    return gold.with_customer(_kept(spark, folder, gold.CUSTOMER, gold.CUSTOMER_COLUMNS), silver_customers(spark, folder))


@work.add("gold_products_by_deltas", PRODUCT_PERFORMANCE_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return gold.with_product(_kept(spark, folder, gold.PRODUCT, gold.PRODUCT_COLUMNS), silver_products(spark, folder))


@work.add("gold_fact_by_deltas", f"WITH {FACT_SQL} SELECT * FROM fact")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of wrong transactions and earlier names, then kept through changes of all sides."""
    root = new_folder(spark, "deltas")
    table, changes = _changing(spark, folder, root)
    dimensions, now = [], []
    for name, rows, key, columns in (
        ("customers", silver_customers(spark, folder), "customer_id", ["full_name", "country", "city"]),
        ("products", silver_products(spark, folder), "product_id", ["product_name", "category", "brand"]),
    ):
        rows = staged(rows.select(key, *columns), name)
        held = KeyedTable(spark, f"{root}/{name}", rows.schema, [key], buckets=4)
        earlier = F.when(F.col(key) % 50 == 0, F.lit("earlier")).otherwise(F.col(columns[0]))
        sync(held, rows.withColumn(columns[0], earlier).where(F.col(key) % 50 != 1))
        dimensions.append(Dimension(held, key, columns))
        now.append(rows)
    wide = KeyedTable(
        spark, f"{root}/fact", GOLD_SCHEMA, TRANSACTION_KEYS, "date_trunc('YEAR', transaction_date)", 4
    )

    def build(rows: DataFrame) -> DataFrame:
        return gold.fact_transactions(rows, *[d.table.read() for d in dimensions])

    maintain_fact(table, wide, dimensions, build, propagate_deletes=True)
    table.merge(changes)
    for dimension, rows in zip(dimensions, now):
        sync(dimension.table, rows)
    maintain_fact(table, wide, dimensions, build, propagate_deletes=True)
    return wide.read()


@work.add("layer_table_rewrites", """
SELECT year(o_orderdate)::BIGINT AS y, count(*) + count(*) FILTER (WHERE o_orderstatus = 'P') AS n,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS finished
FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderstatus = 'F' GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Orders replaced, appended to, compacted, and one year of them rewritten."""
    orders = read_table(spark, folder, "orders")
    table = LayerTable(
        spark, new_folder(spark, "orders"), orders.schema, "date_trunc('YEAR', o_orderdate)"
    ).create()
    table.replace(orders)
    table.append(orders.where("o_orderstatus = 'P'"))
    table.compact()
    year = ["1997-01-01"]
    table.rewrite(table.read(year).where("o_orderstatus = 'F'"), year)
    return table.read().groupBy(F.year("o_orderdate").alias("y")).agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("finished")
    )


@work.add("source_seed_csv", """
SELECT c_custkey, nullif(c_name, '') AS c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
       CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segment
FROM customer""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as a CSV seed and loaded with declared types; empty cells are NULL."""
    customers = read_table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"),
    )
    path = new_folder(spark, "seed")
    customers.write.option("header", True).csv(path)
    return read_seed(spark, path, customers.schema)


def _batch(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The batch job over raw versions; one of its tables, read back."""
    sources = {"customers": raw_customers(spark, folder), "products": raw_products(spark, folder)}
    transactions = staged(silver_transactions(spark, folder), "transactions")
    done = run_batch(
        spark, sources.__getitem__, transactions, new_folder(spark, "batch"),
        newest={"customers": ["updated_at", "version_id"],
                "products": ["updated_at", "cost_price", "version_id"]},
    )
    return done[table].read()


@work.add("medallion_batch", CUSTOMER_METRICS_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Raw copies, cleaned dimensions, checks and metrics as tables; the customers' metrics."""
    return _batch(spark, folder, "customer_metrics")


@work.add("medallion_batch_daily", DAILY_RESULT_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job's daily table."""
    return _batch(spark, folder, "daily_summary")


@work.add("medallion_batch_products", PRODUCT_PERFORMANCE_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job's product table."""
    return _batch(spark, folder, "product_performance")


TRANSACTION_FILE_FEED = ChangeFeed(
    row=TRANSACTION_FEED.row, keys=TRANSACTION_KEYS, upsert=TRANSACTION_FEED.upsert,
    delete=TRANSACTION_FEED.delete,
    sequence={
        "_seq_time": "after.transaction_date", "_seq_product": "after.product_id",
        "_seq_quantity": "after.quantity", "_seq_amount": "after.amount",
        "_seq_status": "after.status", "_seq_customer": "after.customer_id",
    },
)


def transaction_events(spark: SparkSession, folder: str) -> DataFrame:
    """Raw transactions as change events."""
    row = F.struct(
        "transaction_id", "customer_id", "product_id", "quantity",
        F.col("amount").cast("double").alias("amount"),
        F.unix_micros(F.col("transaction_date").cast("timestamp")).alias("transaction_date"),
        "status",
    )
    event = F.struct(F.lit(None).cast("struct<transaction_id:bigint>").alias("before"),
                     row.alias("after"), F.lit("c").alias("op"))
    return raw_transactions(spark, folder).select(F.to_json(event).alias("value"))


@work.add("medallion_stream", f"WITH {FACT_SQL} SELECT * FROM fact")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """All raw transactions as a stream of change events, through log, merge and fact."""
    landing, root = new_folder(spark, "events"), new_folder(spark, "stream")
    transaction_events(spark, folder).write.option("compression", "gzip").text(landing)
    layout = StreamLayout(root, slot="date_trunc('YEAR', transaction_date)")
    done = run_streams(
        spark, read_event_files(spark, landing), TRANSACTION_FILE_FEED, layout,
        staged(silver_customers(spark, folder), "customers"),
        staged(silver_products(spark, folder), "products"),
    )
    return done["gold"].read()
