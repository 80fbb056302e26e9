"""Data checks: violations of each rule over whole tables, and a fused suite."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import quality as dq
from ..operators.latest import latest_per_key
from ..plans.feeds import TRANSACTION_KEYS
from ..sources.files import read_table
from ..sources.staging import staged
from . import Workload
from .tables import (
    LABELLED_SQL, LATEST_SQL, RAW_SQL, SILVER_SQL, TRANSACTION_ORDER, labelled_documents,
    raw_transactions, silver_transactions,
)

work = Workload()

AS_OF = datetime(2024, 1, 31)


@work.add("dq_not_null", f"""
WITH {LABELLED_SQL} SELECT doc_id, lang, source FROM labelled WHERE quality IS NULL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    documents = labelled_documents(spark, folder)
    return dq.violations(documents, dq.not_null("quality")).select("doc_id", "lang", "source")


@work.add("dq_unique", f"""
WITH {RAW_SQL}
SELECT transaction_id, count(*) AS n_records FROM raw
WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return dq.violations(raw_transactions(spark, folder), dq.unique("transaction_id"))


@work.add("dq_accepted_values", f"""
WITH {RAW_SQL}
SELECT status, count(*) AS n_records FROM raw
WHERE status NOT IN ('cancelled', 'Pending', 'NEW') GROUP BY status""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.accepted_values("status", ["cancelled", "Pending", "NEW"])
    return dq.violations(raw_transactions(spark, folder), rule)


@work.add("dq_accepted_range", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice
FROM lineitem
WHERE l_linestatus = 'O' AND (NOT l_extendedprice > 2000 OR NOT l_extendedprice < l_quantity * 2050)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.accepted_range(
        "l_extendedprice", 2000, "l_quantity * 2050", inclusive=False, where="l_linestatus = 'O'"
    )
    return dq.violations(read_table(spark, folder, "lineitem"), rule).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


@work.add("dq_at_least_one", f"""
WITH {LABELLED_SQL}
SELECT lang, source, count(CASE WHEN toxic = 1 THEN 1 END) AS n_present FROM labelled
GROUP BY 1, 2 HAVING count(CASE WHEN toxic = 1 THEN 1 END) = 0""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.at_least_one("CASE WHEN toxic = 1 THEN 1 END", by=["lang", "source"])
    return dq.violations(labelled_documents(spark, folder), rule)


@work.add("dq_at_least_one_global", """
SELECT count(o_orderpriority) AS n_present FROM orders WHERE o_totalprice < 0
HAVING count(o_orderpriority) = 0""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.at_least_one("o_orderpriority", where="o_totalprice < 0")
    return dq.violations(read_table(spark, folder, "orders"), rule)


@work.add("dq_cardinality_equality", """
WITH a AS (SELECT l_suppkey AS value, count(*) AS num_rows FROM lineitem GROUP BY 1),
b AS (SELECT l_suppkey AS value, count(*) AS num_rows FROM lineitem
      WHERE l_shipdate < TIMESTAMP '2001-06-01' GROUP BY 1)
SELECT 'model' AS side, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'other' AS side, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem")
    earlier = items.where("l_shipdate < TIMESTAMP_NTZ '2001-06-01'")
    return dq.cardinality_equality(items, "l_suppkey", earlier, "l_suppkey").frame


COUNTS_SQL = SILVER_SQL + """, a AS (SELECT {key}, count(*) AS n FROM raw GROUP BY 1),
b AS (SELECT {key}, count(*) AS n FROM silver GROUP BY 1),
counts AS (
  SELECT coalesce(a.{key}, b.{key}) AS {key}, coalesce(a.n, 0) AS rows_model,
         coalesce(b.n, 0) AS rows_other, a.n AS na, b.n AS nb
  FROM a FULL JOIN b ON a.{key} IS NOT DISTINCT FROM b.{key})"""


@work.add("dq_equal_rowcount", f"""
WITH {COUNTS_SQL.format(key='status')}
SELECT status, rows_model, rows_other, abs(rows_model - rows_other) AS diff_count
FROM counts WHERE rows_model <> rows_other""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_transactions(spark, folder)
    return dq.equal_rowcount(raw, silver_transactions(spark, folder), by=["status"]).frame


@work.add("dq_equal_rowcount_lenient", f"""
WITH {COUNTS_SQL.format(key='status')}
SELECT status, rows_model, rows_other, abs(na - nb) AS diff_count
FROM counts WHERE coalesce(abs(na - nb), 0) <> 0""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_transactions(spark, folder)
    silver = silver_transactions(spark, folder)
    return dq.equal_rowcount(raw, silver, by=["status"], strict=False).frame


@work.add("dq_fewer_rows_than", f"""
WITH {COUNTS_SQL.format(key='customer_id')}
SELECT CAST(customer_id AS BIGINT) AS customer_id, rows_model, rows_other,
       CASE WHEN rows_model = rows_other THEN 1 ELSE rows_model - rows_other END AS row_count_delta
FROM counts WHERE rows_model >= rows_other""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_transactions(spark, folder)
    return dq.fewer_rows_than(raw, silver_transactions(spark, folder), by=["customer_id"]).frame


@work.add("dq_equality_single_pass", f"""
WITH {LATEST_SQL}, a AS (SELECT transaction_id, customer_id, status FROM raw),
b AS (SELECT transaction_id, customer_id, status FROM latest WHERE status <> 'on hold'
      UNION ALL SELECT transaction_id, customer_id, NULL FROM latest WHERE status = 'on hold')
SELECT which_diff, transaction_id, CAST(customer_id AS BIGINT) AS customer_id, status FROM (
  SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
  UNION ALL SELECT 'b_minus_a' AS which_diff, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_transactions(spark, folder)
    latest = latest_per_key(raw, TRANSACTION_KEYS, TRANSACTION_ORDER).withColumn(
        "status", F.expr("nullif(status, 'on hold')")
    )
    return dq.equality(raw, latest, columns=["transaction_id", "customer_id", "status"]).frame


@work.add("dq_equality_by_buckets", """
WITH a AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_returnflag FROM lineitem),
b AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_orderkey % 1000 = 7 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
        CASE WHEN l_orderkey % 1500 = 11 THEN NULL ELSE l_returnflag END AS l_returnflag
      FROM lineitem WHERE l_orderkey % 2000 <> 13)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a' AS which_diff, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Nearly equal tables: only rows of differing buckets are shuffled."""
    a = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    key = F.col("l_orderkey")
    b = a.where(key % 2000 != 13).withColumns({
        "l_quantity": F.when(key % 1000 == 7, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")),
        "l_returnflag": F.when(key % 1500 != 11, F.col("l_returnflag")),
    })
    return dq.equality(a, b, buckets=4096).frame


@work.add("dq_equality_precision", """
WITH a AS (SELECT l_orderkey, round(l_extendedprice, 2) AS price FROM lineitem),
b AS (SELECT l_orderkey,
        round(l_extendedprice + CASE WHEN l_quantity <= 25 THEN 0.0001 ELSE 1 END, 2) AS price
      FROM lineitem)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a' AS which_diff, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem")
    a = items.select("l_orderkey", F.col("l_extendedprice").alias("price"))
    shift = F.when(F.col("l_quantity") <= 25, F.lit(0.0001)).otherwise(F.lit(1.0))
    b = items.select("l_orderkey", (F.col("l_extendedprice") + shift).alias("price"))
    return dq.equality(a, b, precision=2).frame


@work.add("dq_equality_multiset", """
WITH a AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '1995-07-01' GROUP BY ALL)
SELECT CASE WHEN a.n > coalesce(b.n, 0) THEN 'a_minus_b' ELSE 'b_minus_a' END AS which_diff,
       coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey,
       coalesce(a.l_returnflag, b.l_returnflag) AS l_returnflag
FROM a FULL JOIN b ON a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag
WHERE a.n IS DISTINCT FROM b.n""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_shipdate")
    later = items.where("l_shipdate >= TIMESTAMP_NTZ '1995-07-01'")
    return dq.equality(items, later, exclude=["L_SHIPDATE"], multiset=True).frame


@work.add("dq_expression_is_true", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_discount, l_tax FROM lineitem
WHERE l_returnflag = 'R' AND NOT (l_discount >= l_tax)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.expression_is_true(">= l_tax", "l_discount", where="l_returnflag = 'R'")
    return dq.violations(read_table(spark, folder, "lineitem"), rule).select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax"
    )


@work.add("dq_relationships_where", """
SELECT l_partkey AS id, count(*) AS n_rows FROM lineitem
WHERE l_partkey IS NOT NULL AND l_returnflag <> 'A'
  AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return dq.relationships_where(
        read_table(spark, folder, "lineitem"), "l_partkey",
        read_table(spark, folder, "part"), "p_partkey", "l_returnflag <> 'A'", "p_size > 10",
    ).frame


# Each range looks up the smallest bound among those after it: a larger lower bound, or the same one
# with a larger upper bound (open ones are largest), or an equal range with a later number.
RANGES_SQL = """
WITH r AS (SELECT row_number() OVER () AS id, *, upper_bound IS NULL AS is_open FROM ({source})),
after_it AS (
  SELECT a.id, min(b.lower_bound) AS next_lower_bound FROM r a JOIN r b ON {same}
    ((b.lower_bound > a.lower_bound)
     OR (b.lower_bound = a.lower_bound AND b.is_open > a.is_open)
     OR (b.lower_bound = a.lower_bound AND b.is_open = a.is_open AND b.upper_bound > a.upper_bound)
     OR (b.lower_bound = a.lower_bound AND b.upper_bound IS NOT DISTINCT FROM a.upper_bound AND b.id > a.id))
  GROUP BY a.id)
SELECT {by} lower_bound, upper_bound, next_lower_bound, count(*) AS n_rows,
       (lower_bound {length} upper_bound) IS TRUE AS lower_before_upper,
       next_lower_bound IS NULL OR (upper_bound {gap} next_lower_bound) IS TRUE AS upper_before_next
FROM r LEFT JOIN after_it USING (id)
WHERE (lower_bound {length} upper_bound) IS NOT TRUE
   OR (next_lower_bound IS NOT NULL AND (upper_bound {gap} next_lower_bound) IS NOT TRUE)
GROUP BY ALL"""


@work.add("dq_mutually_exclusive_ranges", RANGES_SQL.format(
    by="o_custkey,", same="a.o_custkey = b.o_custkey AND", length="<", gap="<=",
    source="SELECT o_custkey, o_orderdate AS lower_bound, "
           "o_orderdate + INTERVAL 10 DAY AS upper_bound FROM orders"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Ten days from each order of a customer should end before the next order."""
    return dq.mutually_exclusive_ranges(
        read_table(spark, folder, "orders"), "o_orderdate", "o_orderdate + INTERVAL 10 DAY",
        by=["o_custkey"],
    ).frame


@work.add("dq_mutually_exclusive_ranges_global", RANGES_SQL.format(
    by="", same="", length="<=", gap="<",
    source="SELECT ts AS lower_bound, CASE WHEN event_type <> 'error' "
           "THEN ts + INTERVAL 3 MINUTE END AS upper_bound FROM events"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Three minutes from each event; errors stay open. One order over the whole table."""
    return dq.mutually_exclusive_ranges(
        read_table(spark, folder, "events"), "ts",
        "CASE WHEN event_type <> 'error' THEN ts + INTERVAL 3 MINUTE END",
        gaps="required", zero_length=True,
    ).frame


@work.add("dq_not_accepted_values", """
SELECT l_returnflag, count(*) AS n_records FROM lineitem
WHERE l_returnflag IN ('R', 'X') GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.not_accepted_values("l_returnflag", ["R", "X"])
    return dq.violations(read_table(spark, folder, "lineitem"), rule)


@work.add("dq_not_constant", """
SELECT o_custkey, min(o_orderpriority) AS lowest, max(o_orderpriority) AS highest FROM orders
GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.not_constant("o_orderpriority", by=["o_custkey"])
    return dq.violations(read_table(spark, folder, "orders"), rule)


@work.add("dq_not_empty_string", """
SELECT page_id, url FROM pages WHERE trim(split_part(url, '#', 2)) = ''""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.not_empty_string("split_part(url, '#', 2)")
    return dq.violations(read_table(spark, folder, "pages"), rule).select("page_id", "url")


@work.add("dq_not_null_proportion", f"""
WITH {LABELLED_SQL}
SELECT lang, source, count(quality) / count(*) AS not_null_proportion FROM labelled GROUP BY 1, 2
HAVING count(quality) / count(*) < 0.35 OR count(quality) / count(*) > 0.6""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.not_null_proportion("quality", 0.35, 0.6, by=["lang", "source"])
    return dq.violations(labelled_documents(spark, folder), rule)


@work.add("dq_recency_asof", """
SELECT user_id, max(ts) AS most_recent FROM events GROUP BY 1
HAVING max(ts) < TIMESTAMP '2024-01-31' - INTERVAL 8 HOUR OR max(ts) IS NULL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.recency("ts", "hour", 8, as_of=AS_OF, by=["user_id"])
    return dq.violations(read_table(spark, folder, "events"), rule)


@work.add("dq_recency_date", """
SELECT o_custkey, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS most_recent FROM orders
GROUP BY 1 HAVING CAST(max(o_orderdate) AS DATE) < DATE '2001-07-31' - INTERVAL 1 YEAR""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.recency(
        "o_orderdate", "year", 1, as_of=datetime(2001, 7, 31, 13), ignore_time=True, by=["o_custkey"]
    )
    return dq.violations(read_table(spark, folder, "orders"), rule)


@work.add("dq_sequential_values", """
SELECT l_orderkey, value, previous, count(*) AS n_rows FROM (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS value, CAST(lag(l_linenumber) OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber) AS BIGINT) AS previous
  FROM lineitem)
WHERE NOT (value = previous + 1) GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem")
    return dq.sequential_values(items, "l_linenumber", by=["l_orderkey"]).frame


@work.add("dq_sequential_values_global", """
SELECT value, previous, count(*) AS n_rows FROM (
  SELECT l_shipdate AS value, lag(l_shipdate) OVER (ORDER BY l_shipdate) AS previous FROM lineitem)
WHERE NOT (value = previous + INTERVAL 1 DAY) GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return dq.sequential_values(read_table(spark, folder, "lineitem"), "l_shipdate", 1, "day").frame


@work.add("dq_sequential_values_sliced", """
SELECT l_suppkey, value, previous, count(*) AS n_rows FROM (
  SELECT l_suppkey, l_partkey AS value, lag(l_partkey) OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS previous
  FROM lineitem)
WHERE NOT (value = previous + 100) GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem")  # cut through the groups, whatever their size
    return dq.sequential_values(items, "l_partkey", 100, by=["l_suppkey"], slice_bytes=1 << 16).frame


@work.add("dq_unique_combination", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_records
FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.unique_combination(["l_orderkey", "l_linenumber"])
    return dq.violations(read_table(spark, folder, "lineitem"), rule)


@work.add("dq_assert_equal", f"""
WITH {LABELLED_SQL}
SELECT doc_id, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM labelled
WHERE quality <> toxic""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rule = dq.assert_equal("quality", "toxic")
    return dq.violations(labelled_documents(spark, folder), rule).select("doc_id", "quality", "toxic")


@work.add("dq_columns_match", """
SELECT column_name, 'unexpected' AS finding, rows FROM (
  VALUES ('l_tax')) t(column_name), (SELECT count(*) AS rows FROM lineitem)
UNION ALL
SELECT column_name, 'missing' AS finding, rows FROM (
  VALUES ('l_comment')) t(column_name), (SELECT count(*) AS rows FROM lineitem)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Columns on one side only, with the size of the table they concern."""
    items = read_table(spark, folder, "lineitem")
    expected = [c.upper() for c in items.columns if c != "l_tax"] + ["L_COMMENT"]
    findings = dq.columns_match(items, expected)
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.lit(f).alias("finding")) for c, f in findings
    ]
    return items.agg(F.count("*").alias("rows")).select(F.inline(F.array(*lines)), "rows")


def transaction_suite(raw: DataFrame, parts: DataFrame) -> dq.Suite:
    """One suite with rules of every kind."""
    return dq.Suite(raw, [
        dq.not_null("transaction_id"),
        dq.accepted_range("amount", 1000, 100000),
        dq.expression_is_true("amount >= quantity", name="amount_covers_quantity"),
        dq.not_empty_string("status"),
        dq.not_null_proportion("product_id", 0.99),
        dq.not_constant("customer_id"),
        dq.at_least_one("status"),
        dq.accepted_range("quantity", 1, 40, name="quantity_when_new", where="status = 'NEW'",
                          warn_if="> 10", error_if="> 100000000"),
        dq.unique("transaction_id"),
        dq.accepted_values("status", ["cancelled", "Pending", "NEW", "COMPLETED"]),
        dq.not_accepted_values("status", ["on hold"], warn_if="> 5"),
        dq.at_least_one("CASE WHEN quantity = 50 THEN 1 END", by=["customer_id"],
                        name="customer_with_full_order"),
        dq.not_constant("status", by=["customer_id"], name="customer_status_varies"),
        dq.recency("transaction_date", "day", 30, as_of=datetime(2001, 11, 4)),
        dq.relationships_where(raw, "product_id", parts, "p_partkey", to_condition="p_size <> 7"),
        dq.sequential_values(raw, "product_id", name="product_ids_dense"),
    ])


@work.add("dq_suite_fused", f"""
WITH {RAW_SQL}, found AS (
  SELECT 'not_null_transaction_id' AS rule, count(*) AS failures FROM raw
  WHERE transaction_id IS NULL
  UNION ALL SELECT 'accepted_range_amount', count(*) FROM raw
  WHERE NOT amount >= 1000 OR NOT amount <= 100000
  UNION ALL SELECT 'amount_covers_quantity', count(*) FROM raw WHERE NOT amount >= quantity
  UNION ALL SELECT 'not_empty_string_status', count(*) FROM raw WHERE trim(status) = ''
  UNION ALL SELECT 'not_null_proportion_product_id',
    CAST(count(product_id) / count(*) < 0.99 AS BIGINT) FROM raw
  UNION ALL SELECT 'not_constant_customer_id', CAST(count(DISTINCT customer_id) = 1 AS BIGINT) FROM raw
  UNION ALL SELECT 'at_least_one_status', CAST(count(status) = 0 AS BIGINT) FROM raw
  UNION ALL SELECT 'quantity_when_new', count(*) FROM raw
  WHERE status = 'NEW' AND (NOT quantity >= 1 OR NOT quantity <= 40)
  UNION ALL SELECT 'unique_transaction_id', count(*) FROM (
    SELECT transaction_id FROM raw GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'accepted_values_status', count(DISTINCT status) FROM raw
  WHERE status NOT IN ('cancelled', 'Pending', 'NEW', 'COMPLETED')
  UNION ALL SELECT 'not_accepted_values_status', count(DISTINCT status) FROM raw
  WHERE status IN ('on hold')
  UNION ALL SELECT 'customer_with_full_order', count(*) FROM (
    SELECT customer_id FROM raw GROUP BY 1 HAVING count(CASE WHEN quantity = 50 THEN 1 END) = 0)
  UNION ALL SELECT 'customer_status_varies', count(*) FROM (
    SELECT customer_id FROM raw GROUP BY 1 HAVING count(DISTINCT status) = 1)
  UNION ALL SELECT 'recency_transaction_date',
    CAST(max(transaction_date) < TIMESTAMP '2001-11-04' - INTERVAL 30 DAY AS BIGINT) FROM raw
  UNION ALL SELECT 'relationships_product_id', count(*) FROM raw
  WHERE product_id NOT IN (SELECT p_partkey FROM part WHERE p_size <> 7)
  UNION ALL SELECT 'product_ids_dense', count(*) FROM (
    SELECT product_id, lag(product_id) OVER (ORDER BY product_id) AS previous FROM raw)
  WHERE NOT product_id = previous + 1),
judged AS (
  SELECT *, CASE rule WHEN 'quantity_when_new' THEN failures > 10
      WHEN 'not_accepted_values_status' THEN failures > 5 ELSE failures <> 0 END AS should_warn,
    CASE rule WHEN 'quantity_when_new' THEN failures > 100000000
      ELSE failures <> 0 END AS should_error
  FROM found)
SELECT *, CASE WHEN should_error THEN 'error' WHEN should_warn THEN 'warn' ELSE 'pass' END AS status
FROM judged""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    raw = staged(raw_transactions(spark, folder), "raw")  # the rules run on a written table
    return transaction_suite(raw, read_table(spark, folder, "part")).report()


@work.add("dq_suite_where", """
WITH m AS (SELECT * FROM orders WHERE o_orderstatus = 'F'),
sizes AS (
  SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS a, count(*) AS b FROM orders GROUP BY 1),
later AS (
  SELECT o_custkey, o_orderdate, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS following
  FROM m)
SELECT 'rows' AS rule, sum(b - a)::BIGINT AS failures FROM sizes WHERE a <> b
UNION ALL SELECT 'fewer', CASE WHEN (SELECT count(*) FROM m) < (SELECT count(*) FROM orders) THEN 0 ELSE 1 END
UNION ALL SELECT 'cardinality', sum((a > 0)::INT + 1)::BIGINT FROM sizes WHERE a <> b
UNION ALL SELECT 'equal', 2 * count(*) FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'related', count(*) FROM m WHERE o_custkey NOT IN (
  SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'sequence', count(*) FROM (
  SELECT o_orderkey - lag(o_orderkey) OVER (ORDER BY o_orderkey) AS step FROM m) WHERE step <> 1
UNION ALL SELECT 'ranges', count(*) FROM later WHERE o_orderdate + INTERVAL 10 DAY > following""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Checks that bring a frame, each over finished orders only."""
    orders, customers = read_table(spark, folder, "orders"), read_table(spark, folder, "customer")
    done = {"where": "o_orderstatus = 'F'"}
    return dq.Suite(orders, [
        dq.equal_rowcount(orders, orders, by=["o_custkey"], name="rows", **done),
        dq.fewer_rows_than(orders, orders, name="fewer", **done),
        dq.cardinality_equality(orders, "o_custkey", orders, "o_custkey", name="cardinality", **done),
        dq.equality(orders, orders, ["o_orderkey", "o_totalprice"], name="equal", **done),
        dq.relationships_where(
            orders, "o_custkey", customers, "c_custkey", to_condition="c_acctbal > 0", name="related", **done),
        dq.sequential_values(orders, "o_orderkey", name="sequence", **done),
        dq.mutually_exclusive_ranges(
            orders, "o_orderdate", "o_orderdate + INTERVAL 10 DAY", by=["o_custkey"], name="ranges", **done),
    ]).report().select("rule", "failures")
