"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(columns: Sequence[str | Column]) -> list[Column]:
    """Descending order with NULLs last; Columns are taken as they are."""
    return [F.desc_nulls_last(c) if isinstance(c, str) else c for c in columns]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]
) -> DataFrame:
    """The newest row of each key, whole rows, NULL columns and NULL keys included.

    ``newest`` should order the rows of a key totally, so the result does not depend on file order.
    The rank filter reaches below the shuffle (WindowGroupLimit): each task ships at most one row
    per key, so a key with very many rows costs no more than any other.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first(newest))
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").drop("_rank")
