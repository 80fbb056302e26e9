"""Reshaping operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import shape
from ..operators.latest import latest_per_key
from ..operators.series import date_spine, parts_between, series
from ..sources.databases import ingest_tables
from ..sources.discovery import folder_tables, tables_with_prefix
from ..sources.files import read_table
from ..sources.staging import new_folder
from . import Workload

work = Workload()


@work.add("shape_union_relations", """
SELECT 'customers' AS source_table, c_name AS name, c_nationkey::BIGINT AS nationkey,
       c_acctbal AS acctbal, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS suppkey
FROM customer WHERE c_acctbal > 0
UNION ALL
SELECT 'suppliers', s_name, s_nationkey::BIGINT, s_acctbal, NULL, s_suppkey
FROM supplier WHERE s_acctbal > 0""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Parties with an open balance; each table lacks a column of the other."""
    customers = read_table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"), "c_custkey",
    )
    suppliers = read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("NAME"),
        F.col("s_nationkey").alias("NationKey"), F.col("s_acctbal").alias("acctbal"),
    )
    return shape.union_tables(
        {"customers": customers, "suppliers": suppliers}, exclude=["C_CUSTKEY"], where="acctbal > 0"
    )


@work.add("shape_union_common_type", """
SELECT CAST(o_orderkey AS VARCHAR) AS reference, o_totalprice AS amount FROM orders
UNION ALL SELECT props, value FROM events""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A number in one table and a text in the other make a text."""
    return shape.union_tables({
        "orders": read_table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("reference"), F.col("o_totalprice").alias("amount"),
            "o_orderstatus"),
        "events": read_table(spark, folder, "events").select(
            F.col("props").alias("reference"), F.col("value").alias("amount")),
    }, include=["REFERENCE", "amount"], source_column=None)


@work.add("shape_union_wider_type", """
SELECT CAST(p_size AS DOUBLE) AS number, CAST(p_partkey AS BIGINT) AS wide, CAST(NULL AS TIMESTAMP) AS at
FROM part
UNION ALL SELECT o_totalprice, 5000000000 + o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) FROM orders
UNION ALL SELECT value, NULL, ts FROM events""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Narrow types first: numbers, longer numbers and times keep all they hold."""
    return shape.union_tables({
        "part": read_table(spark, folder, "part").select(
            F.col("p_size").cast("int").alias("number"), F.col("p_partkey").cast("int").alias("wide")),
        "orders": read_table(spark, folder, "orders").select(
            F.col("o_totalprice").alias("number"), (F.col("o_orderkey") + F.lit(5000000000)).alias("wide"),
            F.col("o_orderdate").cast("date").alias("at")),
        "events": read_table(spark, folder, "events").select(
            F.col("value").alias("number"), F.col("ts").cast("timestamp_ntz").alias("at")),
    }, source_column=None)


@work.add("shape_union_discovered", """
SELECT source_table, n::BIGINT AS n, total FROM (
  SELECT 'market.party_customer' AS source_table, count(*) AS n, sum(c_nationkey)::BIGINT AS total
  FROM customer
  UNION ALL SELECT 'market.party_supplier', count(*), sum(s_nationkey)::BIGINT FROM supplier)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Tables copied to a layer, found again by their prefix, and united."""
    root = new_folder(spark, "discovery")
    sources = {
        "party_customer": read_table(spark, folder, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation")),
        "party_supplier": read_table(spark, folder, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation")),
        "place_nation": read_table(spark, folder, "nation"),
    }
    tables = ingest_tables(spark, sources.__getitem__, sources, root, "market")
    found = tables_with_prefix(spark, f"{root}/bronze", "market", "PARTY_", exclude="%nation%")
    assert found.keys() <= folder_tables(spark, f"{root}/bronze", "%").keys()
    united = shape.union_tables({n: tables[n.split(".")[1]].read() for n in found})
    return united.groupBy("source_table").agg(
        F.count("*").alias("n"), F.sum("nation").alias("total")
    )


@work.add("shape_pivot", """
SELECT l_shipdate, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS qty_a,
       sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS qty_n,
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS qty_r
FROM lineitem GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Values found in the data become columns."""
    items = read_table(spark, folder, "lineitem")
    flags = shape.value_list(items, "l_returnflag")
    return shape.pivot(
        items, ["l_shipdate"], "l_returnflag", flags, prefix="qty ", then_value="l_quantity",
        else_value=0, slug_names=True,
    )


@work.add("shape_pivot_distinct", """
SELECT l_returnflag, count(DISTINCT CASE WHEN l_quantity < 10 THEN l_partkey END) AS under_10,
       count(DISTINCT CASE WHEN l_quantity < 30 THEN l_partkey END) AS under_30
FROM lineitem GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return shape.pivot(
        read_table(spark, folder, "lineitem"), ["l_returnflag"], "l_quantity", [10, 30],
        agg="count", cmp="<", prefix="under_", then_value="l_partkey", else_value=None,
        distinct=True,
    )


@work.add("shape_unpivot", """
SELECT o_orderkey, field, val FROM (
  SELECT o_orderkey, 'o_custkey' AS field, CAST(o_custkey AS VARCHAR) AS val FROM orders
  UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey, 'is_big', CAST(o_totalprice > 250000 AS VARCHAR) FROM orders
  UNION ALL SELECT o_orderkey, 'nothing', NULL FROM orders)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        "*", (F.col("o_totalprice") > 250000).alias("is_big"), F.lit(None).cast("int").alias("nothing")
    )
    return shape.unpivot(
        orders, keep=["O_ORDERKEY"], remove=["o_totalprice", "O_orderdate"], field_name="field",
        value_name="val",
    )


@work.add("shape_unpivot_totals", """
SELECT field_name, CAST(sum(value) AS DOUBLE) AS total, count(*) AS n FROM (
  SELECT 'l_quantity' AS field_name, CAST(l_quantity AS DECIMAL(18,2)) AS value FROM lineitem
  UNION ALL SELECT 'l_extendedprice', CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem
  UNION ALL SELECT 'l_tax', CAST(l_tax AS DECIMAL(18,2)) FROM lineitem
  UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS DECIMAL(18,2)) FROM lineitem)
GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Measures unpivoted to one type and summed, in one scan."""
    items = read_table(spark, folder, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_tax", "l_linenumber"
    )
    return shape.unpivot(items, cast_to="decimal(18,2)").groupBy("field_name").agg(
        F.sum("value").alias("total"), F.count("*").alias("n")
    )


@work.add("shape_star", """
SELECT o_orderkey AS order_o_orderkey_raw, o_custkey AS customer,
       o_orderpriority AS order_o_orderpriority_raw
FROM orders""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").alias("o")
    return orders.select(*shape.star(
        orders, leave_out=["O_ORDERSTATUS", "o_totalprice", "o_orderdate"], prefix="order_",
        suffix="_raw", rename={"O_CUSTKEY": "customer"}, relation="o",
    ))


@work.add("shape_star_aggregate", """
SELECT lang, source, sum(n_chars)::BIGINT AS total FROM documents GROUP BY 1, 2""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    keys = documents.select(*shape.star(documents, leave_out=["doc_id", "text", "n_chars"])).columns
    return documents.groupBy(*keys).agg(F.sum("n_chars").alias("total"))


@work.add("shape_nullcheck", """
SELECT page_id, nullif(split_part(url, '?', 2), '') AS query, nullif(split_part(url, '#', 2), '') AS
  fragment
FROM pages""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select(
        "page_id", F.expr("split_part(url, '?', 2)").alias("query"),
        F.expr("split_part(url, '#', 2)").alias("fragment"),
    )
    return shape.nulls_for_empty(pages)


@work.add("shape_deduplicate", """
SELECT text_hash, doc_id, lang, source FROM (
  SELECT md5(text) AS text_hash, doc_id, lang, source,
         row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn
  FROM documents)
WHERE rn = 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """First document of every text. Texts are hashed first, so they are not shuffled."""
    documents = read_table(spark, folder, "documents").select(
        F.md5("text").alias("text_hash"), "doc_id", "lang", "source"
    )
    return latest_per_key(documents, ["text_hash"], [F.asc("doc_id")])


@work.add("shape_series", """
SELECT g.generated_number::BIGINT AS generated_number
FROM (SELECT unnest(generate_series(1, (SELECT max(o_orderkey) FROM orders))) AS generated_number) g
WHERE g.generated_number NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers up to the highest order that no order of normal priority has."""
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("generated_number"), "o_orderpriority")
    highest = shape.single_value(orders.agg(F.max("generated_number")), 0)
    return series(spark, highest).join(
        orders.where("o_orderpriority <> '1-URGENT'"), "generated_number", "left_anti")


@work.add("shape_date_spine", """
WITH ends AS (SELECT date_trunc('month', min(o_orderdate)) AS a, max(o_orderdate) AS b FROM orders),
spine AS (
  SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS date_month FROM ends)
SELECT date_month, count(o_orderkey) AS orders
FROM spine LEFT JOIN orders ON date_trunc('month', o_orderdate) = date_month
WHERE date_month < (SELECT date_trunc('month', b) FROM ends)
GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per month of the table's time span, the last begun month left out."""
    orders = read_table(spark, folder, "orders")
    ends = orders.agg(
        F.date_trunc("month", F.min("o_orderdate")).cast("timestamp_ntz").alias("a"),
        F.date_trunc("month", F.max("o_orderdate")).cast("timestamp_ntz").alias("b"),
    ).first()
    monthly = orders.groupBy(
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("date_month")
    ).agg(F.count("*").alias("orders"))
    spine = date_spine(spark, "month", ends.a, ends.b)
    return spine.join(monthly, "date_month", "left").fillna(0, subset=["orders"])


@work.add("shape_intervals_between", """
SELECT o_custkey, date_sub('day', min(o_orderdate), max(o_orderdate)) AS days,
       date_sub('hour', min(o_orderdate), max(o_orderdate)) AS hours,
       12 * (year(max(o_orderdate)) - year(min(o_orderdate))) + month(max(o_orderdate))
         - month(min(o_orderdate))
         - CASE WHEN day(max(o_orderdate)) < day(min(o_orderdate)) THEN 1 ELSE 0 END AS months
FROM orders GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Whole days, hours and months between a customer's first and last order."""
    ends = read_table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")
    )
    return ends.select("o_custkey", *[
        parts_between("a", "b", part).alias(f"{part}s") for part in ("day", "hour", "month")
    ])


@work.add("shape_column_values_topk", """
SELECT l_partkey AS value FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1
ORDER BY count(*) DESC, l_partkey LIMIT 25""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return shape.top_values(
        read_table(spark, folder, "lineitem"), "l_partkey", limit=25, where="l_returnflag = 'N'"
    )


@work.add("shape_column_values", """
SELECT split_part(p_name, ' ', 1) AS value FROM part GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return shape.top_values(
        read_table(spark, folder, "part"), "split_part(p_name, ' ', 1)",
        order_by=["max(p_size) DESC"],
    )


@work.add("shape_attach_scalar", """
SELECT o_orderkey, o_totalprice, (SELECT max(o_totalprice) FROM orders) AS highest,
       CAST(-1 AS BIGINT) AS absent
FROM orders""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A value of another query on every row; the default where that query has no rows."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    highest = orders.agg(F.max("o_totalprice"))
    nothing = orders.where("o_totalprice < 0").select("o_orderkey")
    return shape.attach_scalar(
        shape.attach_scalar(orders, highest, "highest"), nothing, "absent", default=-1
    )


@work.add("shape_group_first", """
SELECT l_returnflag, l_linestatus, count(*) AS total, CAST(sum(CAST(l_quantity AS DECIMAL(18,2)))
  AS DOUBLE) AS quantity
FROM lineitem GROUP BY 1, 2""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return shape.group_first(
        items, 2, F.count("*").alias("total"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"),
    )


@work.add("shape_span_in_parts", """
SELECT user_id, date_sub('day', min(ts), max(ts)) AS days, date_sub('hour', min(ts), max(ts)) AS hours
FROM events GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Whole days and hours between a user's first and last event."""
    ends = read_table(spark, folder, "events").groupBy("user_id").agg(
        F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ends.select("user_id", *[
        parts_between("a", "b", part).cast("bigint").alias(f"{part}s")
        for part in ("day", "hour")
    ])
