"""Number series and date spines."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Date parts that a spine or a check may step by.
DATE_PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def check_part(part: str) -> str:
    if part.lower() not in DATE_PARTS:
        raise ValueError(f"date part must be one of {DATE_PARTS}, not {part!r}")
    return part.upper()


def series(spark: SparkSession, upper: int, name: str = "generated_number") -> DataFrame:
    """1, 2, .. ``upper``, made in parallel and in no order."""
    if upper <= 0:
        raise ValueError("the upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", name)


def parts_between(start: Column | str, end: Column | str, part: str) -> Column:
    """Number of whole date parts between two columns of times."""
    ends = [(F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz") for c in (start, end)]
    return F.timestamp_diff(check_part(part), *ends)


def intervals_between(
    spark: SparkSession, start: date | datetime, end: date | datetime, part: str
) -> int:
    """Number of whole date parts from ``start`` to ``end``."""
    return spark.range(1).select(parts_between(F.lit(start), F.lit(end), part)).first()[0]


def date_spine(
    spark: SparkSession, part: str, start: date | datetime, end: date | datetime
) -> DataFrame:
    """One row per whole date part from ``start`` on, ``end`` left out; none if start >= end."""
    steps = intervals_between(spark, start, end, part)
    at = F.timestamp_add(
        check_part(part), F.col("id").cast("int"), F.lit(start).cast("timestamp_ntz")
    )
    return spark.range(max(steps, 0)).select(at.alias(f"date_{part.lower()}"))
