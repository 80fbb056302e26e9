"""Finding tables by name pattern, in the session catalog or below a folder."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from .files import matching_paths


def _like(pattern: str) -> re.Pattern[str]:
    """Case-insensitive SQL LIKE pattern: % any text, _ one character."""
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(ch, re.escape(ch)) for ch in pattern), re.I | re.S)


def _chosen(names: list[str], pattern: str, exclude: str) -> list[str]:
    keep, drop = _like(pattern), _like(exclude)
    return sorted(n for n in names if keep.fullmatch(n) and not drop.fullmatch(n))


def catalog_tables(
    spark: SparkSession, table_pattern: str, schema_pattern: str = "%", exclude: str = ""
) -> list[str]:
    """``schema.table`` names in the catalog, and the names of matching temporary views."""
    found = []
    for database in spark.catalog.listDatabases():
        if _like(schema_pattern).fullmatch(database.name):
            names = [t.name for t in spark.catalog.listTables(database.name) if not t.isTemporary]
            found += [f"{database.name}.{n}" for n in _chosen(names, table_pattern, exclude)]
    views = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    return found + _chosen(views, table_pattern, exclude)


def folder_tables(
    spark: SparkSession, root: str, table_pattern: str, schema_pattern: str = "%", exclude: str = ""
) -> dict[str, str]:
    """``schema.table`` -> path for table folders at ``root/<schema>/<table>``."""
    by_schema: dict[str, dict[str, str]] = {}
    for path in matching_paths(spark, f"{root.rstrip('/')}/*/*"):
        schema, table = path.rstrip("/").split("/")[-2:]
        by_schema.setdefault(schema, {})[table] = path
    return {
        f"{schema}.{name}": tables[name]
        for schema, tables in sorted(by_schema.items())
        if _like(schema_pattern).fullmatch(schema)
        for name in _chosen(list(tables), table_pattern, exclude)
    }


def tables_with_prefix(spark: SparkSession, root: str, schema: str, prefix: str, exclude: str = ""
                       ) -> dict[str, str]:
    return folder_tables(spark, root, f"{prefix}%", schema, exclude)
