"""Queries over the test tables, one per operator, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Workload:
    """Named queries and, where SQL can say the same, their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = lambda spark, folder: portable(query(spark, folder))
            if sql is not None:
                self.sql[name] = sql.strip()
            return query

        return register


def portable(df: DataFrame) -> DataFrame:
    """Column types that compare alike across engines: 64-bit numbers, plain timestamps, dates as
    text."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    kinds = {
        T.DecimalType: "double", T.FloatType: "double", T.IntegerType: "bigint",
        T.ShortType: "bigint", T.ByteType: "bigint", T.DateType: "string",
        T.TimestampType: "timestamp_ntz",
    }
    return df.select(*[
        F.col(f"`{f.name}`").cast(kinds[type(f.dataType)]).alias(f.name)
        if type(f.dataType) in kinds else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
