"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DateType, MapType, NumericType, StringType, StructType,
    TimestampNTZType, TimestampType,
)

# A table of at most this many rows and bytes may be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 128 * 1024 * 1024
# A key counts as heavy from this share of the rows, so there are at most 1 / share of them.
HEAVY_SHARE = 0.005
SALTS = 64
# Keys a sketch of frequent keys tracks for each that can be heavy; its counts are then off by at most
# 0.1 % of the rows.
TRACKED = 20
SKETCHED = (NumericType, StringType, BooleanType, DateType, TimestampType, TimestampNTZType)


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: text and nested values by their length, others by a fixed 16 bytes."""
    size = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size.cast("bigint")


def is_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` has at most so many rows and bytes. The rows of a file table are counted from
    its footers; only a table with few rows is read."""
    if df.count() > max_rows:
        return False
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= max_bytes


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Values of ``key`` that hold at least ``share`` of the rows: at most 1 / share values.

    One pass, in which each task ships a sketch of its frequent keys and not its keys. The sketch
    loses no heavy key; where there are very many keys it can take one for heavy that is just below.
    """
    most = math.ceil(1 / share)
    if isinstance(df.schema[key].dataType, SKETCHED):
        top = F.expr(f"approx_top_k(`{key}`, {most}, {max(TRACKED * most, 4000)})")
        seen = df.agg(top.alias("top"), F.count("*").alias("total")).first()
        return [row["item"] for row in seen.top if row["count"] >= max(seen.total * share, 1)]
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total")).scalar()
    heavy = counts.where(F.col("n") >= F.greatest(total * F.lit(share), F.lit(1)))
    return [row[0] for row in heavy.select(key).limit(most).collect()]


def _in_values(column: Column, values: list) -> Column:
    tests = []
    present = [v for v in values if v is not None]
    if present:
        tests.append(F.coalesce(column.isin(present), F.lit(False)))
    if len(present) < len(values):
        tests.append(column.isNull())
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def lookup(
    facts: DataFrame, dimension: DataFrame, key: str, max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS, keys_of: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``facts`` with a table that has one row per ``key``.

    A dimension measured as small is broadcast. Otherwise the join shuffles, and the rows of heavy
    keys are spread over ``salts`` sub-keys, for which the dimension's row is repeated. The heavy
    keys are counted in ``keys_of``, a cheaper frame with the same keys, where there is one.
    """
    if is_small(dimension, max_rows):
        return facts.join(F.broadcast(dimension), key, "left")
    heavy = heavy_keys(facts if keys_of is None else keys_of, key)
    if not heavy:
        return facts.join(dimension, key, "left")
    others = [F.col(f"`{c}`") for c in facts.columns if c != key]
    spread = F.when(
        _in_values(F.col(key), heavy), F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    ).otherwise(F.lit(0))
    copies = F.when(
        _in_values(F.col(key), heavy), F.sequence(F.lit(0), F.lit(salts - 1))
    ).otherwise(F.array(F.lit(0)))
    left = facts.withColumn("_salt", spread)
    right = dimension.withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"], "left").drop("_salt")
