"""Rules on one table.

A :class:`RowRule` is a condition that failing rows meet. A :class:`GroupRule` groups the table,
computes measures and has a condition that failing groups meet; without keys the table is the one
group. Both kinds can be fused. A :class:`FrameRule` brings its own frame of violations.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ColumnLike, as_column
from ..operators.series import check_part
from ..operators.shape import quoted


@dataclass(frozen=True, kw_only=True)
class Rule:
    """``where`` limits the rows looked at; ``warn_if`` and ``error_if`` compare the failures."""

    name: str
    where: str | None = None
    warn_if: str = "!= 0"
    error_if: str = "!= 0"

    def with_options(self, **options) -> Rule:
        return replace(self, **options)


@dataclass(frozen=True, kw_only=True)
class RowRule(Rule):
    fails: Column


@dataclass(frozen=True, kw_only=True)
class GroupRule(Rule):
    """``keys`` are SQL expressions, which also name the key columns. ``fails`` gets the columns of
    the keys and measures by name, so that rules can share one aggregation. Without keys, one row
    that meets ``decides`` may be enough to tell the outcome."""

    keys: Sequence[str] = ()
    measures: Mapping[str, Column]
    fails: Callable[[Mapping[str, Column]], Column]
    decides: Column | None = None

    def key_columns(self) -> list[Column]:
        return [as_column(k).alias(k) for k in self.keys]

    def fails_where(self, rename: Callable[[str], str] = str) -> Column:
        """The failing condition, with measures under the names ``rename`` gives them."""
        columns = {k: F.col(quoted(k)) for k in self.keys}
        columns |= {n: F.col(rename(n)) for n in self.measures}
        return F.coalesce(self.fails(columns), F.lit(False))


@dataclass(frozen=True, kw_only=True)
class FrameRule(Rule):
    """``failures`` reduces the frame to the number of failures. The rows to look at are chosen
    before the frame is made, by the ``where`` of the function that makes it."""

    frame: DataFrame
    failures: Column = field(default_factory=lambda: F.count("*"))

    def __post_init__(self) -> None:
        if self.where:
            raise ValueError("give where to the check; its frame is made already")


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """Failing rows, or failing groups with their measures."""
    if isinstance(rule, FrameRule):
        return rule.frame
    rows = df.where(rule.where) if rule.where else df
    if isinstance(rule, RowRule):
        return rows.where(rule.fails)
    if isinstance(rule, GroupRule):
        if rule.decides is not None and not rule.keys:
            rows = rows.where(rule.decides).limit(1)  # the scan stops at the first such row
        return rows.groupBy(*rule.key_columns()).agg(
            *[m.alias(n) for n, m in rule.measures.items()]
        ).where(rule.fails_where())
    raise TypeError(f"not a rule: {rule!r}")


def _named(name: str, options: dict) -> dict:
    """The options of a rule, with a name where none is given."""
    return {"name": name, **options}


# -- row rules ------------------------------------------------------------------------------------

def not_null(column: str, **options) -> RowRule:
    return RowRule(fails=as_column(column).isNull(), **_named(f"not_null_{column}", options))


def accepted_range(
    column: str, low: ColumnLike | float | None = None, high: ColumnLike | float | None = None,
    inclusive: bool = True, **options,
) -> RowRule:
    """Value outside the bounds, which may be expressions over the row; NULL passes."""
    value, fails = as_column(column), F.lit(False)

    def bound(b) -> Column:
        return as_column(b) if isinstance(b, (str, Column)) else F.lit(b)

    if low is not None:
        fails = fails | ~(value >= bound(low) if inclusive else value > bound(low))
    if high is not None:
        fails = fails | ~(value <= bound(high) if inclusive else value < bound(high))
    return RowRule(fails=fails, **_named(f"accepted_range_{column}", options))


def expression_is_true(expression: str, column: str | None = None, **options) -> RowRule:
    """Expression, or its continuation after ``column``, is false; NULL passes."""
    whole = expression if column is None else f"{column} {expression}"
    return RowRule(
        fails=~F.expr(f"({whole})"), **_named(f"expression_is_true_{whole}", options)
    )


def not_empty_string(column: str, trim: bool = True, **options) -> RowRule:
    value = as_column(column)
    return RowRule(
        fails=(F.trim(value) if trim else value) == "",
        **_named(f"not_empty_string_{column}", options),
    )


def assert_equal(actual: ColumnLike, expected: ColumnLike, null_safe: bool = False, **options
                 ) -> RowRule:
    """Two columns differ; a NULL on either side passes unless ``null_safe``."""
    a, b = as_column(actual), as_column(expected)
    return RowRule(
        fails=~a.eqNullSafe(b) if null_safe else a != b,
        **_named(f"assert_equal_{actual}_{expected}", options),
    )


# -- group rules ----------------------------------------------------------------------------------

def unique(column: str, **options) -> GroupRule:
    """Non-NULL value on more than one row."""
    return GroupRule(
        **_named(f"unique_{column}", options), keys=[column], measures={"n_records": F.count("*")},
        fails=lambda m: m[column].isNotNull() & (m["n_records"] > 1),
    )


def unique_combination(columns: Sequence[str], **options) -> GroupRule:
    """Combination on more than one row, NULLs counting as equal."""
    return GroupRule(
        **_named(f"unique_combination_{'_'.join(columns)}", options), keys=list(columns),
        measures={"n_records": F.count("*")}, fails=lambda m: m["n_records"] > 1,
    )


def accepted_values(column: str, values: Sequence, **options) -> GroupRule:
    """Value outside the list; NULL passes. One violation per value."""
    return GroupRule(
        **_named(f"accepted_values_{column}", options), keys=[column], measures={"n_records": F.count("*")},
        fails=lambda m: ~m[column].isin(*values),
    )


def not_accepted_values(column: str, values: Sequence, **options) -> GroupRule:
    """Value that is in the list. One violation per value."""
    return GroupRule(
        **_named(f"not_accepted_values_{column}", options), keys=[column], measures={"n_records": F.count("*")},
        fails=lambda m: m[column].isin(*values),
    )


def at_least_one(column: str, by: Sequence[str] = (), **options) -> GroupRule:
    """Group without any non-NULL value; an empty table fails."""
    return GroupRule(
        **_named(f"at_least_one_{column}", options), keys=list(by),
        measures={"n_present": F.count(as_column(column))}, fails=lambda m: m["n_present"] == 0,
        decides=as_column(column).isNotNull(),
    )


def not_constant(column: str, by: Sequence[str] = (), **options) -> GroupRule:
    """Group with exactly one distinct non-NULL value."""
    return GroupRule(
        **_named(f"not_constant_{column}", options), keys=list(by),
        measures={"lowest": F.min(as_column(column)), "highest": F.max(as_column(column))},
        fails=lambda m: m["lowest"] == m["highest"],
    )


def not_null_proportion(
    column: str, at_least: float, at_most: float = 1.0, by: Sequence[str] = (), **options
) -> GroupRule:
    """Share of non-NULL values outside the bounds."""
    share = F.try_divide(F.count(as_column(column)), F.count("*"))
    return GroupRule(
        **_named(f"not_null_proportion_{column}", options), keys=list(by),
        measures={"not_null_proportion": share},
        fails=lambda m: (m["not_null_proportion"] < at_least) | (m["not_null_proportion"] > at_most),
    )


def recency(
    column: str, part: str, interval: int, as_of: datetime | None = None,
    ignore_time: bool = False, by: Sequence[str] = (), **options,
) -> GroupRule:
    """Newest value older than ``interval`` date parts before ``as_of``, or no value at all."""
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else F.lit(as_of)
    threshold = F.timestamp_add(check_part(part), F.lit(-interval), now.cast("timestamp_ntz"))
    newest = F.max(as_column(column))
    if ignore_time:
        newest, threshold = newest.cast("date"), threshold.cast("date")
    return GroupRule(
        **_named(f"recency_{column}", options), keys=list(by), measures={"most_recent": newest},
        fails=lambda m: (m["most_recent"] < threshold) | m["most_recent"].isNull(),
    )
