"""Row schemas of change events."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql.types import (
    DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

# Type names a row schema may use.
TYPE_NAMES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
}


RowSpec = StructType | str | Iterable[Mapping[str, str]]


def row_schema(fields: RowSpec) -> StructType:
    """Schema from a DDL string or from ``{"name", "type"}`` entries; unknown types raise."""
    if isinstance(fields, StructType):
        return fields
    if isinstance(fields, str):
        return StructType.fromDDL(fields)
    out = []
    for field in fields:
        kind = TYPE_NAMES.get(field["type"].lower())
        if kind is None:
            raise ValueError(f"column {field['name']}: unknown type {field['type']!r}")
        out.append(StructField(field["name"], kind, True))
    return StructType(out)


def envelope_schema(row: RowSpec) -> StructType:
    """Schema of one change event: row before, row after, operation letter."""
    row = row_schema(row)
    return StructType([
        StructField("before", row), StructField("after", row), StructField("op", StringType()),
    ])
