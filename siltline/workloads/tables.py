"""The logical tables of the layered model, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import ChangeFeed
from ..plans import silver
from ..sources.files import read_table

# -- transactions: line items with the customer of their order ------------------------------------

TRANSACTION_ORDER = [
    "transaction_date", "product_id", "quantity", "amount", "status", "customer_id",
]

RAW_SQL = """raw AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
         CAST(o_custkey AS INTEGER) AS customer_id, CAST(l_partkey AS INTEGER) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
         l_shipdate AS transaction_date,
         CASE WHEN l_returnflag = 'R' THEN 'cancelled'
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Pending'
              WHEN l_returnflag = 'N' THEN 'on hold'
              WHEN l_linestatus = 'O' THEN 'NEW' ELSE 'COMPLETED' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LATEST_SQL = RAW_SQL + """, latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY transaction_id
      ORDER BY transaction_date DESC NULLS LAST, product_id DESC NULLS LAST,
               quantity DESC NULLS LAST, amount DESC NULLS LAST, status DESC NULLS LAST,
               customer_id DESC NULLS LAST) AS rn
    FROM raw)
  WHERE rn = 1)"""

SILVER_SQL = LATEST_SQL + """, silver AS (
  SELECT *, CASE WHEN upper(status) = 'CANCELLED' THEN CAST(0 AS DECIMAL(10,2))
                 ELSE amount END AS net_amount
  FROM latest
  WHERE amount > 0 AND quantity > 0 AND status IS NOT NULL
    AND upper(status) IN ('COMPLETED', 'PENDING', 'CANCELLED', 'NEW'))"""


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item, repeats of a transaction id included."""
    items = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    status = F.expr(
        "CASE WHEN l_returnflag = 'R' THEN 'cancelled' "
        "WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Pending' "
        "WHEN l_returnflag = 'N' THEN 'on hold' "
        "WHEN l_linestatus = 'O' THEN 'NEW' ELSE 'COMPLETED' END"
    )
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
        F.col("l_shipdate").alias("transaction_date"),
        status.alias("status"),
    )


def silver_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return silver.transactions(raw_transactions(spark, folder), TRANSACTION_ORDER)


# -- customers: a version per order; products: a version per sale ---------------------------------

CUSTOMER_ORDER = ["updated_at", "version_id"]
PRODUCT_ORDER = ["updated_at", "cost_price", "version_id"]

CUSTOMERS_SQL = """customers AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT CAST(c_custkey AS INTEGER) AS customer_id, split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) AS last_name, c_name AS full_name,
           DATE '1970-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS birth_date,
           CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           lower(c_mktsegment) || c_custkey || '@example.com' AS email,
           c_nationkey || '-' || c_custkey AS phone, n_name AS country, r_name AS city,
           o_orderpriority AS address, o_orderdate AS registration_date,
           c_mktsegment AS customer_segment, o_orderstatus <> 'F' AS is_active,
           o_orderdate AS created_at, o_orderdate AS updated_at,
           row_number() OVER (PARTITION BY c_custkey
             ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  WHERE rn = 1)"""

PRODUCTS_SQL = """products AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT CAST(p_partkey AS INTEGER) AS product_id, p_name AS product_name, p_type AS category,
           p_brand AS brand, split_part(p_name, ' ', 1) AS color,
           CAST(p_size AS VARCHAR) AS size, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS cost_price, 'piece' AS unit_of_measure,
           l_returnflag <> 'R' AS is_active, l_shipdate AS created_at, l_shipdate AS updated_at,
           row_number() OVER (PARTITION BY p_partkey
             ORDER BY l_shipdate DESC NULLS LAST,
                      CAST(l_extendedprice AS DECIMAL(10,2)) DESC NULLS LAST,
                      l_orderkey * 10 + l_linenumber DESC NULLS LAST) AS rn
    FROM lineitem JOIN part ON l_partkey = p_partkey)
  WHERE rn = 1)"""


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer versions: each order brings one."""
    return (
        read_table(spark, folder, "orders")
        .join(read_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("c_name").alias("full_name"),
            F.expr("date_add(DATE '1970-01-01', CAST(c_custkey % 10000 AS INT))").alias("birth_date"),
            F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender"),
            F.expr("concat(lower(c_mktsegment), c_custkey, '@example.com')").alias("email"),
            F.concat_ws("-", "c_nationkey", "c_custkey").alias("phone"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("city"),
            F.col("o_orderpriority").alias("address"),
            F.col("o_orderdate").alias("registration_date"),
            F.col("c_mktsegment").alias("customer_segment"),
            (F.col("o_orderstatus") != "F").alias("is_active"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
            F.col("o_orderkey").alias("version_id"),
        )
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Product versions: each sale brings one."""
    return (
        read_table(spark, folder, "lineitem")
        .join(read_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.split_part("p_name", F.lit(" "), F.lit(1)).alias("color"),
            F.col("p_size").cast("string").alias("size"),
            F.col("p_retailprice").alias("unit_price"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("cost_price"),
            F.lit("piece").alias("unit_of_measure"),
            (F.col("l_returnflag") != "R").alias("is_active"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("version_id"),
        )
    )


def silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    return silver.customers(raw_customers(spark, folder), CUSTOMER_ORDER)


def silver_products(spark: SparkSession, folder: str) -> DataFrame:
    return silver.products(raw_products(spark, folder), PRODUCT_ORDER)


# -- user change events ---------------------------------------------------------------------------

USER_FEED = ChangeFeed(
    row="user_id BIGINT, event_id BIGINT, kind STRING, value DOUBLE, ts_micros BIGINT",
    keys=["user_id"],
    upsert={
        "user_id": "src.user_id",
        "kind": "src.kind",
        "amount": "try_cast(src.value AS DECIMAL(10,2))",
        "happened_at": "timestamp_micros(src.ts_micros)",
    },
    delete={"user_id": "src.user_id"},
    sequence={
        "_seq_time": "coalesce(after.ts_micros, before.ts_micros)",
        "_seq_id": "coalesce(after.event_id, before.event_id)",
    },
)
USER_SEQUENCE = ["_seq_time", "_seq_id"]

# Operation letter of an event, by its type.
OPS_SQL = """CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd'
         ELSE 'u' END"""

LOG_SQL = f"""log AS (
  SELECT user_id, op AS _op,
         CASE WHEN op <> 'd' THEN event_type END AS kind,
         CASE WHEN op <> 'd' THEN CAST(value AS DECIMAL(10,2)) END AS amount,
         CASE WHEN op <> 'd' THEN ts END AS happened_at,
         epoch_us(ts) AS _seq_time, event_id AS _seq_id
  FROM (SELECT *, {OPS_SQL} AS op FROM events)
  WHERE user_id IS NOT NULL)"""


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Change events as JSON text, one per row of ``events``."""
    events = read_table(spark, folder, "events")
    row = F.struct(
        "user_id", "event_id", F.col("event_type").alias("kind"), "value",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_micros"),
    )
    op = F.expr(OPS_SQL)
    event = F.struct(
        F.when(op == "d", row).alias("before"), F.when(op != "d", row).alias("after"),
        op.alias("op"),
    )
    return events.select(F.to_json(event).alias("value"))


# -- documents with their labels, where they have some --------------------------------------------

LABELLED_SQL = """labelled AS (
  SELECT d.doc_id, lang, source, n_chars, quality, toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(read_table(spark, folder, "labels"), "doc_id", "left")
