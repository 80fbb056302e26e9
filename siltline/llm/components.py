"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged


def components(links: DataFrame) -> DataFrame:
    """Links ``a, b`` (two longs) to ``node, root``: every node with the smallest node it reaches.

    Each round hangs the larger neighbours of a node, then the smaller ones, under its smallest
    neighbour. Rounds needed follow the logarithm of a component's width. A node with very many
    links is grouped by partial minima and joined back, which skew joins can split. Each round is
    a written table. NULLs and loops are left out; no links, no rows.
    """
    current = staged(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "links")
    state = None
    while (now := _state(current)) != state:
        state = now
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("at"), F.least("a", "low").alias("low"))
        large = staged(
            both.join(least, F.col("a") == F.col("at")).filter("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "at")
        hung = large.join(least, F.col("a") == F.col("at")).select(
            F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("low").alias("b"))
        current = staged(hung.union(least.select("at", "low")).filter("a <> b").distinct(), "links")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select("b", "b").distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
