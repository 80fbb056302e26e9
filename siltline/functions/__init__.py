"""Column functions. A string argument is a SQL expression, so plain column names work too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.expr(value) if isinstance(value, str) else value
