"""Database tables over JDBC, and the copy of a list of tables into the raw layer."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .files import layer_path
from .layer_table import LayerTable


@dataclass(frozen=True)
class KeySplit:
    """Ranges of a key column, read as parallel queries."""

    column: str
    low: int | str
    high: int | str
    parts: int


@dataclass(frozen=True)
class Database:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10_000

    def read_options(self, table: str, split: KeySplit | None = None) -> dict[str, str]:
        """Reader options; without a split the table comes through one connection."""
        options = {
            "url": self.url, "dbtable": table, "user": self.user, "password": self.password,
            "driver": self.driver, "fetchsize": str(self.fetch_size),
        }
        if split is not None:
            if split.parts < 1:
                raise ValueError("a split needs at least one part")
            options |= {
                "partitionColumn": split.column, "lowerBound": str(split.low),
                "upperBound": str(split.high), "numPartitions": str(split.parts),
            }
        return options

    def read(self, spark: SparkSession, table: str, split: KeySplit | None = None) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options(table, split)).load()


def ingest_tables(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    names: Iterable[str],
    root: str,
    schema: str,
    layer: str = "bronze",
) -> dict[str, LayerTable]:
    """Copy every named table whole into its layer, replacing the table's earlier content."""
    done = {}
    for name in names:
        source = read(name)
        table = LayerTable(spark, layer_path(root, layer, schema, name), source.schema)
        table.replace(source)
        done[name] = table
    return done
