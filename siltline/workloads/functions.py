"""Column functions inside the table jobs that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric, text, urls
from ..operators.joins import lookup
from ..sources.files import read_table
from . import Workload

work = Workload()


@work.add("col_surrogate_key", f"""
SELECT md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
           coalesce(nullif(l_returnflag, 'N'), '{text.NULL_KEY_PART}')) AS item_key,
       md5(CAST(l_orderkey AS VARCHAR) || '-' || coalesce(nullif(l_returnflag, 'N'), ''))
         AS legacy_key
FROM lineitem""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        text.surrogate_key("l_orderkey", "l_linenumber", "nullif(l_returnflag, 'N')")
        .alias("item_key"),
        text.surrogate_key("l_orderkey", "nullif(l_returnflag, 'N')", nulls_as_empty=True)
        .alias("legacy_key"),
    )


@work.add("col_safe_math", """
SELECT d.doc_id, coalesce(quality, 0) + coalesce(toxic, 0) + n_chars AS added,
       n_chars - coalesce(quality, 0) - coalesce(toxic, 0) AS subtracted,
       n_chars / nullif(quality, 0) AS divided
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "n_chars")
    return documents.join(read_table(spark, folder, "labels"), "doc_id", "left").select(
        "doc_id",
        numeric.safe_add("quality", "toxic", "n_chars").alias("added"),
        numeric.safe_subtract("n_chars", "quality", "toxic").alias("subtracted"),
        numeric.safe_divide("n_chars", "quality").alias("divided"),
    )


@work.add("col_width_bucket_histogram", """
SELECT CASE WHEN l_extendedprice < 20000 THEN 0 WHEN l_extendedprice >= 80000 THEN 13
            ELSE CAST(floor((l_extendedprice - 20000) / 5000) AS BIGINT) + 1 END AS bucket,
       count(*) AS n
FROM lineitem GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    bucket = numeric.width_bucket("l_extendedprice", "20000", "80000", 12)
    return read_table(spark, folder, "lineitem").groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n")
    )


@work.add("col_haversine", """
WITH points AS (
  SELECT vec_id, label, CAST(CAST(embedding[1] AS DOUBLE) * 90 AS DECIMAL(18,9)) AS lat,
         CAST(CAST(embedding[2] AS DOUBLE) * 180 AS DECIMAL(18,9)) AS lon
  FROM embeddings),
centres AS (
  SELECT label, CAST(sum(lat) AS DOUBLE) / count(*) AS clat, CAST(sum(lon) AS DOUBLE) / count(*) AS clon
  FROM points GROUP BY 1),
angles AS (
  SELECT vec_id, p.label, radians(CAST(lat AS DOUBLE)) AS p1, radians(CAST(lon AS DOUBLE)) AS l1,
         radians(clat) AS p2, radians(clon) AS l2
  FROM points p JOIN centres c ON p.label = c.label),
distances AS (
  SELECT vec_id, label, 2 * 3961 * asin(sqrt(pow(sin((p2 - p1) / 2), 2)
    + cos(p1) * cos(p2) * pow(sin((l2 - l1) / 2), 2))) AS miles
  FROM angles)
SELECT vec_id, CAST(label AS BIGINT) AS label, round(miles, 4) AS miles,
       round(miles * 1.60934, 4) AS kilometres
FROM distances""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Distance of every point to the centre of its group."""
    def coordinate(i: int, span: int) -> F.Column:
        return (F.col("embedding")[i].cast("double") * span).cast("decimal(18,9)")

    points = read_table(spark, folder, "embeddings").select(
        "vec_id", "label", coordinate(0, 90).alias("lat"), coordinate(1, 180).alias("lon")
    )
    centres = points.groupBy("label").agg(
        (F.sum("lat").cast("double") / F.count("*")).alias("clat"),
        (F.sum("lon").cast("double") / F.count("*")).alias("clon"),
    )
    at = ["CAST(lat AS DOUBLE)", "CAST(lon AS DOUBLE)", "clat", "clon"]
    return lookup(points, centres, "label").select(
        "vec_id", "label", F.round(numeric.haversine(*at), 4).alias("miles"),
        F.round(numeric.haversine(*at, unit="km"), 4).alias("kilometres"),
    )


SCHEME = "(?:(?:android-app|https?)://)?"
HOST_SQL = f"regexp_extract(url, '^{SCHEME}([^/?]*)', 1)"


@work.add("col_url_host_report", f"""
SELECT {HOST_SQL} AS host, count(*) AS pages, count(DISTINCT url) AS urls FROM pages GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("url")
    return pages.groupBy(urls.url_host("url").alias("host")).agg(
        F.count("*").alias("pages"), F.count_distinct("url").alias("urls")
    )


PATH = f"^{SCHEME}[^/?]*/([^?]*)"


@work.add("col_url_path_report", f"""
SELECT regexp_extract(path, '^[^/]*') AS section, count(*) AS pages, count(DISTINCT path) AS paths
FROM (SELECT regexp_extract(url, '{PATH}', 1) AS path FROM pages WHERE regexp_matches(url, '{PATH}'))
GROUP BY 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select(urls.url_path("url").alias("path"))
    return pages.where("path IS NOT NULL").groupBy(
        F.split_part("path", F.lit("/"), F.lit(1)).alias("section")
    ).agg(F.count("*").alias("pages"), F.count_distinct("path").alias("paths"))


@work.add("col_url_parameter_report", """
SELECT nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source,
       nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
       count(*) AS pages
FROM pages GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "pages").groupBy(
        urls.url_parameter("url", "utm_source").alias("source"),
        urls.url_parameter("url", "page").alias("page"),
    ).agg(F.count("*").alias("pages"))


# One character at a time: a gap gives an underscore where it begins, other signs give nothing.
SLUG_SQL = """(SELECT CASE WHEN kept[1] BETWEEN '0' AND '9' THEN '_' || kept ELSE kept END FROM (
  SELECT array_to_string(list_transform(signs, lambda c, i: CASE
    WHEN c BETWEEN 'a' AND 'z' OR c BETWEEN '0' AND '9' OR c = '_' THEN c
    WHEN c IN (' ', '-') AND (i = 1 OR signs[i - 1] NOT IN (' ', '-')) THEN '_' ELSE '' END), '') AS kept
  FROM (SELECT string_split(lower({0}), '') AS signs)))"""


@work.add("col_slugify", f"""
SELECT {SLUG_SQL.format("o_orderpriority")} AS priority_slug,
       {SLUG_SQL.format("o_orderstatus || ' ' || o_orderpriority")} AS both_slug, count(*) AS n
FROM orders GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").groupBy(
        text.slug("o_orderpriority").alias("priority_slug"),
        text.slug("concat(o_orderstatus, ' ', o_orderpriority)").alias("both_slug"),
    ).agg(F.count("*").alias("n"))


@work.add("col_slugify_documents", f"""
SELECT doc_id, md5({SLUG_SQL.format('text')}) AS slug_hash FROM documents""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs of whole texts, as hashes."""
    return read_table(spark, folder, "documents").select(
        "doc_id", F.md5(text.slug("text")).alias("slug_hash")
    )
