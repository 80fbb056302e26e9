"""Rules that compare tables, or neighbouring rows of one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import as_column
from ..operators.neighbours import groups_are_small, with_neighbour
from ..operators.series import check_part
from ..operators.shape import other_columns, quoted
from .rules import FrameRule


def _limited(model: DataFrame, options: dict) -> DataFrame:
    """The rows of the checked table that ``where`` leaves, before anything is made of them."""
    where = options.pop("where", None)
    return model.where(where) if where else model


def _side_counts(
    model: DataFrame, other: DataFrame, model_keys: Sequence[Column], other_keys: Sequence[Column]
) -> DataFrame:
    """Rows per key on both sides. One shuffle of partial counts; NULL keys match each other."""
    def side(df: DataFrame, keys: Sequence[Column], a: int, b: int) -> DataFrame:
        return df.select(*keys, F.lit(a).alias("_a"), F.lit(b).alias("_b"))

    both = side(model, model_keys, 1, 0).union(side(other, other_keys, 0, 1))
    names = [c for c in both.columns if c not in ("_a", "_b")]
    return both.groupBy(*[quoted(n) for n in names]).agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("rows_model"),
        F.coalesce(F.sum("_b"), F.lit(0)).alias("rows_other"),
    )


def _comparable(by: Sequence[str]) -> Column:
    """Whether both sides have the group, as an equi-join over non-NULL keys would find it."""
    present = [F.col(quoted(b)).isNotNull() for b in by]
    return reduce(
        lambda x, y: x & y, present, (F.col("rows_model") > 0) & (F.col("rows_other") > 0)
    )


def equal_rowcount(
    model: DataFrame, other: DataFrame, by: Sequence[str] = (), strict: bool = True, **options
) -> FrameRule:
    """Different number of rows, per group. ``strict`` counts a missing group as 0 rows; otherwise
    a group that only one side has is not compared."""
    model = _limited(model, options)
    keys = [F.col(quoted(b)) for b in by]
    counts = _side_counts(model, other, keys, keys)
    diff = F.abs(F.col("rows_model") - F.col("rows_other"))
    if not strict:
        diff = F.when(_comparable(by), diff)
    frame = counts.withColumn("diff_count", diff).where(F.coalesce(diff, F.lit(0)) != 0)
    return FrameRule(
        name=options.pop("name", "equal_rowcount"), frame=frame,
        failures=F.coalesce(F.sum("diff_count"), F.lit(0)), **options,
    )


def fewer_rows_than(
    model: DataFrame, other: DataFrame, by: Sequence[str] = (), strict: bool = True, **options
) -> FrameRule:
    """Not fewer rows than the other table, per group: the surplus, or 1 for equal numbers."""
    model = _limited(model, options)
    keys = [F.col(quoted(b)) for b in by]
    counts = _side_counts(model, other, keys, keys)
    surplus = F.greatest(F.col("rows_model") - F.col("rows_other"), F.lit(1))
    delta = F.when(F.col("rows_model") >= F.col("rows_other"), surplus).otherwise(F.lit(0))
    if not strict:
        delta = F.when(_comparable(by), delta).otherwise(F.lit(0))
    frame = counts.withColumn("row_count_delta", delta).where("row_count_delta != 0")
    return FrameRule(
        name=options.pop("name", "fewer_rows_than"), frame=frame,
        failures=F.coalesce(F.sum("row_count_delta"), F.lit(0)), **options,
    )


def cardinality_equality(
    model: DataFrame, column: str, other: DataFrame, field: str, **options
) -> FrameRule:
    """(value, number of rows) pairs that only one side has."""
    model = _limited(model, options)
    counts = _side_counts(
        model, other, [as_column(column).alias("value")], [as_column(field).alias("value")]
    ).where("rows_model != rows_other")
    sides = F.array(
        F.struct(F.lit("model").alias("side"), F.col("rows_model").alias("num_rows")),
        F.struct(F.lit("other").alias("side"), F.col("rows_other").alias("num_rows")),
    )
    present = F.filter(sides, lambda s: s["num_rows"] > 0)
    frame = counts.select("value", F.inline(present))
    return FrameRule(name=options.pop("name", f"cardinality_equality_{column}"), frame=frame, **options)


def equality(
    model: DataFrame, other: DataFrame, columns: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None, precision: int | None = None, multiset: bool = False,
    buckets: int | None = None, **options,
) -> FrameRule:
    """Rows that only one side has, NULLs counting as equal and repeats ignored.

    Both sides go through one shuffle of map-side combined rows. ``precision`` rounds numbers first;
    ``multiset`` compares how often a row occurs as well.

    With ``buckets`` rows are compared only where the sides differ: each side adds up the hashes of its
    rows per hash bucket (one row per bucket and task is shuffled, in whatever order the rows come),
    and rows of buckets with equal sums stay where they are. For tables that are nearly equal. A
    difference is overlooked only if 96 bits of hashes add up alike.
    """
    model = _limited(model, options)
    if columns and exclude:
        raise ValueError("give columns to compare or to exclude, not both")
    if columns:
        names = list(columns)
    else:
        names = other_columns(model, exclude or ())
        if {c.lower() for c in names} != {c.lower() for c in other_columns(other, exclude or ())}:
            raise ValueError("the tables have different columns; name those to compare")

    def side(df: DataFrame, in_model: int) -> DataFrame:
        kinds = {f.name.lower(): f.dataType for f in df.schema.fields}

        def value(name: str) -> Column:
            column = F.col(quoted(name))
            numeric = isinstance(kinds[name.lower()], NumericType)
            return (F.round(column, precision) if numeric and precision is not None
                    else column).alias(name)

        return df.select(
            *[value(n) for n in names],
            F.lit(in_model).alias("_a"), F.lit(1 - in_model).alias("_b"),
        )

    measure = F.sum if multiset else F.max
    both = side(model, 1).union(side(other, 0))
    if buckets is not None:
        both = _in_differing_buckets(both, names, buckets)
    grouped = both.groupBy(*[quoted(n) for n in names]).agg(
        measure("_a").alias("_a"), measure("_b").alias("_b")
    )
    which = F.when(F.col("_a") > F.col("_b"), "a_minus_b").otherwise("b_minus_a")
    frame = grouped.where("_a != _b").select(which.alias("which_diff"), *[quoted(n) for n in names])
    only_a = F.count_if(F.col("which_diff") == "a_minus_b")
    only_b = F.count_if(F.col("which_diff") == "b_minus_a")
    return FrameRule(
        name=options.pop("name", "equality"), frame=frame,
        failures=F.count("*") + F.abs(only_a - only_b), **options,
    )


def _in_differing_buckets(both: DataFrame, names: Sequence[str], buckets: int) -> DataFrame:
    """Rows of the hash buckets in which the sums over both sides are not the same."""
    columns = [F.col(quoted(n)) for n in names]
    row_hash, sign = F.xxhash64(*columns), F.col("_a") - F.col("_b")
    hashed = both.select(
        F.pmod(row_hash, F.lit(buckets)).alias("_bucket"), sign.alias("_sign"),
        # halves, so that no sum overflows
        row_hash.bitwiseAND(F.lit(0xFFFFFFFF)).alias("_low"), F.shiftright(row_hash, 32).alias("_high"),
        F.hash(*columns).cast("bigint").alias("_other"),
    )
    sums = [F.sum("_sign"), *[F.sum(F.col(c) * F.col("_sign")) for c in ("_low", "_high", "_other")]]
    differing = hashed.groupBy("_bucket").agg(F.array(*sums).alias("_sums")).where(
        F.exists("_sums", lambda s: s != 0)).select("_bucket")
    return both.withColumn("_bucket", F.pmod(row_hash, F.lit(buckets))).join(
        F.broadcast(differing), "_bucket", "left_semi").drop("_bucket")  # at most as many as buckets


def relationships_where(
    model: DataFrame, column: str, other: DataFrame, field: str,
    from_condition: str = "true", to_condition: str = "true", **options,
) -> FrameRule:
    """Ids without a match, with the number of rows that have them.

    Both sides are reduced to one row per id before the join, however often an id occurs.
    """
    model = _limited(model, options)
    ids = model.where(from_condition).groupBy(as_column(column).alias("id")).agg(
        F.count("*").alias("n_rows")
    ).where("id IS NOT NULL")
    known = other.where(to_condition).select(as_column(field).alias("id")).distinct()
    return FrameRule(
        name=options.pop("name", f"relationships_{column}"), frame=ids.join(known, "id", "left_anti"),
        failures=F.coalesce(F.sum("n_rows"), F.lit(0)), **options,
    )


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, part: str | None = None,
    by: Sequence[str] = (), slice_bytes: int | None = None, **options,
) -> FrameRule:
    """Values that are not the previous one plus ``interval``, with the number of such rows.

    Equal rows are counted first: one of them follows the previous value, the others follow their
    own value. With ``slice_bytes`` groups are not counted; slices of that size are cut through them.
    """
    df = _limited(df, options)
    rows = df.where(as_column(column).isNotNull()).groupBy(
        *by, as_column(column).alias("value")
    ).agg(F.count("*").alias("_n"))
    found = with_neighbour(
        rows, by, ["value"], "value", "previous",
        small_groups=slice_bytes is None and groups_are_small(df, by), slice_bytes=slice_bytes,
    )

    def out_of_step(previous: Column) -> Column:
        if part is None:
            return F.col("value") != previous + F.lit(interval)
        return F.col("value").cast("timestamp_ntz") != F.timestamp_add(
            check_part(part), F.lit(interval), previous.cast("timestamp_ntz")
        )

    first = F.when(
        F.coalesce(out_of_step(F.col("previous")), F.lit(False)),
        F.struct(F.col("previous"), F.lit(1).cast("bigint").alias("n_rows")),
    )
    repeats = F.when(
        (F.col("_n") > 1) & out_of_step(F.col("value")),
        F.struct(F.col("value").alias("previous"), (F.col("_n") - 1).alias("n_rows")),
    )
    frame = found.select(*by, "value", F.inline(F.array_compact(F.array(first, repeats))))
    return FrameRule(
        name=options.pop("name", f"sequential_values_{column}"), frame=frame,
        failures=F.coalesce(F.sum("n_rows"), F.lit(0)), **options,
    )


# How an upper bound must relate to the next lower bound.
GAPS = {"not_allowed": "=", "allowed": "<=", "required": "<"}


def mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, by: Sequence[str] = (), gaps: str = "allowed",
    zero_length: bool = False, slice_bytes: int | None = None, **options,
) -> FrameRule:
    """Ranges that are empty or meet the next one, with the number of such rows.

    ``lower`` and ``upper`` are expressions. A range with a NULL bound is a violation. ``slice_bytes``
    as in :func:`sequential_values`.
    """
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {sorted(GAPS)}, not {gaps!r}")
    df = _limited(df, options)
    ranges = df.groupBy(
        *by, as_column(lower).alias("lower_bound"), as_column(upper).alias("upper_bound")
    ).agg(F.count("*").alias("_n"))
    bounded = ranges.where("lower_bound IS NOT NULL").withColumn(
        "_open", F.col("upper_bound").isNull()  # NULL upper bounds sort last
    )
    following = with_neighbour(
        bounded, by, ["lower_bound", "_open", "upper_bound"], "lower_bound", "next_lower_bound",
        following=True, small_groups=slice_bytes is None and groups_are_small(df, by),
        slice_bytes=slice_bytes,
    ).drop("_open")
    # Of equal rows, all but the last are followed by their own bound.
    each = F.array(
        F.struct(F.col("next_lower_bound"), F.lit(1).cast("bigint").alias("n_rows")),
        F.struct(F.col("lower_bound").alias("next_lower_bound"), (F.col("_n") - 1).alias("n_rows")),
    )
    rows = following.select(*by, "lower_bound", "upper_bound", F.inline(each)).where("n_rows > 0")
    unbounded = ranges.where("lower_bound IS NULL").select(
        *by, "lower_bound", "upper_bound", F.lit(None).alias("next_lower_bound"),
        F.col("_n").alias("n_rows"),
    )
    length = F.expr(f"coalesce(lower_bound {'<=' if zero_length else '<'} upper_bound, false)")
    meets = F.expr(f"next_lower_bound IS NULL OR coalesce(upper_bound {GAPS[gaps]} next_lower_bound, false)")
    frame = rows.unionByName(unbounded).select(
        "*", length.alias("lower_before_upper"), meets.alias("upper_before_next")
    ).where("NOT (lower_before_upper AND upper_before_next)")
    return FrameRule(
        name=options.pop("name", f"mutually_exclusive_ranges_{lower}_{upper}"), frame=frame,
        failures=F.coalesce(F.sum("n_rows"), F.lit(0)), **options,
    )


def columns_match(model: DataFrame, expected: Sequence[str]) -> list[tuple[str, str]]:
    """Column names on one side only, whatever their case; a schema comparison without a job."""
    have, want = {c.lower() for c in model.columns}, {c.lower() for c in expected}
    return [(c, "unexpected") for c in sorted(have - want)] + [
        (c, "missing") for c in sorted(want - have)
    ]
