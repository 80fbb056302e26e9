"""Previous or next row in an order, without gathering a group in one task.

A window per group puts the whole group on one task. Here the rows are range-partitioned over
(group, order) instead, so a heavy group is cut into many slices; each slice finds its own
neighbours, and the one row at the edge of a slice takes its neighbour from the adjoining slice.
There are as many slices as the rows' size asks for. Where the groups were counted and none is heavy,
or all rows fit into one slice, a plain window costs less.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged
from .joins import BROADCAST_ROWS, row_bytes

SLICE = "_slice"
# A slice holds about so many bytes.
SLICE_BYTES = 128 * 1024 * 1024
# Groups of at most this many rows may be windowed whole.
WINDOW_ROWS = 1_000_000


def _same_group(by: Sequence[str], edge: str) -> Column:
    tests = [F.col(b).eqNullSafe(F.col(f"{edge}.{b}")) for b in by]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def groups_are_small(df: DataFrame, by: Sequence[str], max_rows: int = WINDOW_ROWS) -> bool:
    """Whether no group of ``df`` has more than ``max_rows`` rows; reads the group columns only."""
    if not by:
        return False
    heaviest = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return (heaviest or 0) <= max_rows


def with_neighbour(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    take: str,
    name: str,
    following: bool = False,
    small_groups: bool = False,
    slice_bytes: int | None = None,
) -> DataFrame:
    """Add ``name``: column ``take`` of the previous (or following) row of the same group.

    Rows are ordered by ``order`` within the groups ``by``. (by, order) must be unique per row and
    ``take`` must not be NULL: group equal rows first and carry their number. ``small_groups`` says
    that the groups were counted, see :func:`groups_are_small`. Otherwise the rows are written once and
    measured, and cut into slices of about ``slice_bytes``.
    """
    step = F.lead if following else F.lag
    if small_groups:
        return df.withColumn(name, step(take).over(Window.partitionBy(*by).orderBy(*order)))
    keys = [*by, *order]
    # Range bounds come from a sample, which would compute the rows a second time.
    rows = staged(df, "rows")
    size = rows.agg(F.sum(row_bytes(rows))).first()[0] or 0
    slices = math.ceil(size / (slice_bytes or SLICE_BYTES))
    if slices <= 1:
        return rows.withColumn(name, step(take).over(Window.partitionBy(*by).orderBy(*order)))
    # Sampled bounds may differ between two evaluations, so the slices are written once, too.
    sliced = staged(
        rows.repartitionByRange(slices, *keys).withColumn(SLICE, F.spark_partition_id()), "slices"
    )
    window = Window.partitionBy(SLICE, *by).orderBy(*order)
    pick = F.min if following else F.max
    # One row per slice: its last row (first row, looking forward) as a struct.
    edges = sliced.groupBy(SLICE).agg(pick(F.struct(*keys)).alias("_edge"))
    # Slices without rows have no edge; the order of the others carries over them.
    adjoining = edges.select(SLICE, step("_edge").over(Window.orderBy(SLICE)).alias("_edge"))
    if slices <= BROADCAST_ROWS:
        adjoining = F.broadcast(adjoining)
    found = sliced.withColumn(name, step(take).over(window)).join(adjoining, SLICE, "left")
    at_edge = F.when(_same_group(by, "_edge"), F.col(f"_edge.{take}"))
    return found.withColumn(name, F.coalesce(F.col(name), at_edge)).drop(SLICE, "_edge")
