"""Reshaping: column selection, union, pivot, unpivot, value lists, scalars."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType, StructField

from ..functions import ColumnLike, as_column
from ..functions.text import null_if_empty, slug_name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def other_columns(df: DataFrame, leave_out: Iterable[str] = ()) -> list[str]:
    """Column names except some, whatever their case."""
    out = {c.lower() for c in leave_out}
    return [c for c in df.columns if c.lower() not in out]


def star(
    df: DataFrame,
    leave_out: Iterable[str] = (),
    prefix: str = "",
    suffix: str = "",
    rename: Mapping[str, str] | None = None,
    relation: str | None = None,
) -> list[Column]:
    """All columns but some, for ``select``; a rename goes before prefix and suffix."""
    names = {k.lower(): v for k, v in (rename or {}).items()}
    lead = f"{relation}." if relation else ""
    return [
        F.col(f"{lead}{quoted(c)}").alias(names.get(c.lower(), f"{prefix}{c}{suffix}"))
        for c in other_columns(df, leave_out)
    ]


def nulls_for_empty(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every string column."""
    return df.select(*[
        null_if_empty(F.col(quoted(f.name))).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(quoted(f.name))
        for f in df.schema.fields
    ])


def group_first(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    """Group by the first ``n`` columns."""
    if not 1 <= n <= len(df.columns):
        raise ValueError(f"cannot group by the first {n} of {len(df.columns)} columns")
    return df.groupBy(*[quoted(c) for c in df.columns[:n]]).agg(*aggregates)


def union_tables(
    tables: Mapping[str, DataFrame],
    include: Iterable[str] = (),
    exclude: Iterable[str] = (),
    types: Mapping[str, str | DataType] | None = None,
    source_column: str | None = "source_table",
    where: str | None = None,
) -> DataFrame:
    """Union of tables by column name, whatever the case; a table lacking a column gives NULL.

    A column has the widest type it has in any table, or text if any table has text there, so no
    value is cut; ``types`` overrides. ``where`` filters each table before the union.
    """
    chosen, dropped = {c.lower() for c in include}, {c.lower() for c in exclude}
    if chosen and dropped:
        raise ValueError("give columns to include or to exclude, not both")
    if not tables:
        raise ValueError("no tables to union")

    wanted: dict[str, StructField] = {}
    for df in tables.values():
        for f in df.schema.fields:
            name = f.name.lower()
            if name in dropped or (chosen and name not in chosen):
                continue
            known = wanted.setdefault(name, f)
            if isinstance(f.dataType, StringType) and not isinstance(known.dataType, StringType):
                wanted[name] = StructField(known.name, f.dataType)
    if not wanted:
        raise ValueError(f"no columns left to union for {', '.join(tables)}")
    forced = {c.lower(): t for c, t in (types or {}).items()}

    def kind_of(name: str) -> str | DataType | None:
        """The type to cast to; without one the union widens numbers and times itself."""
        text = wanted[name].dataType if isinstance(wanted[name].dataType, StringType) else None
        return forced.get(name, text)

    def aligned(label: str, df: DataFrame) -> DataFrame:
        rows = df.where(where) if where else df
        own = {c.lower(): c for c in df.columns}
        columns = [
            (F.col(quoted(own[name])) if name in own else F.lit(None))
            for name in wanted
        ]
        columns = [
            (c.cast(kind) if (kind := kind_of(name)) is not None else c).alias(f.name)
            for c, (name, f) in zip(columns, wanted.items())
        ]
        source = [F.lit(label).alias(source_column)] if source_column else []
        return rows.select(*source, *columns)

    return reduce(DataFrame.unionByName, [aligned(n, df) for n, df in tables.items()])


def top_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[ColumnLike] = ("count(*) DESC",),
    limit: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values of a column as ``value``, in an order that may use aggregates."""
    rows = df.where(where) if where else df
    orders = [_order(o) for o in order_by]
    keyed = rows.groupBy(as_column(column).alias("value")).agg(
        *[c.alias(f"_order{i}") for i, (c, _) in enumerate(orders)]
    )
    sort = [
        (F.desc_nulls_last if down else F.asc_nulls_last)(f"_order{i}")
        for i, (_, down) in enumerate(orders)
    ]
    out = keyed.orderBy(*sort, F.asc_nulls_last("value"))
    return (out if limit is None else out.limit(limit)).select("value")


def _order(term: ColumnLike) -> tuple[Column, bool]:
    """An aggregate and whether it sorts downwards."""
    if not isinstance(term, str):
        return term, False
    words = term.split()
    if words[-1].lower() in ("asc", "desc"):
        return F.expr(" ".join(words[:-1])), words[-1].lower() == "desc"
    return F.expr(term), False


def value_list(df: DataFrame, column: str, default: list | None = None, **options) -> list:
    """Values of :func:`top_values` on the driver, all of them unless a ``limit`` is given.

    For columns whose values become columns or names; give known values to :func:`pivot` directly.
    """
    rows = top_values(df, column, **options).toLocalIterator()
    return [r.value for r in rows] or (default if default is not None else [])


COMPARISONS: dict[str, Callable[[Any, Any], Column]] = {
    "=": operator.eq, "!=": operator.ne, "<>": operator.ne, "<": operator.lt,
    "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "like": lambda a, b: a.like(b), "ilike": lambda a, b: a.ilike(b),
}
AGGREGATES: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "sum": (F.sum, F.sum_distinct), "count": (F.count, F.count_distinct),
    "min": (F.min, F.min), "max": (F.max, F.max),
}


def pivot(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    values: Sequence[Any],
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: ColumnLike | int = 1,
    else_value: ColumnLike | int | None = 0,
    distinct: bool = False,
    slug_names: bool = False,
) -> DataFrame:
    """One column per value: an aggregate of ``then_value`` where the comparison holds, else
    ``else_value``. One grouped pass, whatever the number of values."""
    plain, distinctly = AGGREGATES[agg.lower()]
    compare, aggregate = COMPARISONS[cmp.lower()], distinctly if distinct else plain

    def operand(v: ColumnLike | int | None) -> Column:
        return as_column(v) if isinstance(v, (str, Column)) else F.lit(v)

    out = []
    for value in values:
        label = f"{prefix}{value}{suffix}"
        hit = F.when(compare(F.col(quoted(column)), F.lit(value)), operand(then_value))
        out.append(
            aggregate(hit.otherwise(operand(else_value)))
            .alias(slug_name(label) if slug_names else label)
        )
    return df.groupBy(*keys).agg(*out)


def unpivot(
    df: DataFrame,
    keep: Sequence[str] = (),
    remove: Iterable[str] = (),
    cast_to: str = "string",
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows in one scan. ``keep`` stays on every row, ``remove`` is dropped, the others
    are cast to one type; NULL values stay."""
    by_name = {c.lower(): c for c in df.columns}
    ids = [by_name[c.lower()] for c in keep]
    values = other_columns(df, [*keep, *remove])
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def cast(name: str) -> Column:
        column = F.col(quoted(name))
        if isinstance(kinds[name], BooleanType):
            column = column.cast("string")
        return column.cast(cast_to).alias(name)

    flat = df.select(*[F.col(quoted(c)) for c in ids], *[cast(c) for c in values])
    return flat.unpivot(
        [F.col(quoted(c)) for c in ids], [F.col(quoted(c)) for c in values], field_name, value_name
    )


def attach_scalar(df: DataFrame, query: DataFrame, name: str, default: Any = None) -> DataFrame:
    """Add the first column of a query's first row to every row; ``default`` if it has no rows."""
    first = query.select(F.col(quoted(query.columns[0]))).limit(1).scalar()
    return df.withColumn(name, F.coalesce(first, F.lit(default)))


def single_value(query: DataFrame, default: Any = None) -> Any:
    """First column of the first row on the driver, ``default`` if there are no rows."""
    row = query.limit(1).collect()
    return row[0][0] if row else default
