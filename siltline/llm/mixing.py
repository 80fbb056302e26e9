"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged
from .columns import WORD, carried, whole

BINS = 10  # 2 ** BINS slices of a source's draws; one slice of a source is sorted in one task
DRAW_BITS = 52


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """A whole number of 52 bits that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, max_epochs: float = 3.0, share: float = 1.0) -> DataFrame:
    """``source, source_size, weight`` to the same rows with ``target``.

    The sources share ``share`` of all words by weight. A source stops at ``max_epochs`` times its
    size and what it can't take goes to the others by weight, until none is above. Sorted by size
    over weight, those that stop come first, so running sums find them at once. The frame has one
    row per source; missing or negative weights count as 0 and get nothing.
    """
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    everything = Window.partitionBy()
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = (
        sizes.withColumn("w", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.when(F.col("w") > 0, F.col("cap") / F.col("w"))
                    .otherwise(F.lit(float("inf"))))
        .withColumn("left", F.sum("source_size").over(everything) * F.lit(float(share))
                    - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weights", F.sum("w").over(rest))
        .withColumn("place", F.row_number().over(order))
        .withColumn("stops", (F.col("w") > 0)
                    & (F.col("cap") * F.col("weights") <= F.col("left") * F.col("w")))
        .withColumn("first", F.min(F.when(~F.col("stops"), F.col("place"))).over(everything))
    )
    at_first = F.col("place") == F.col("first")
    level = (F.max(F.when(at_first, F.col("left"))).over(everything) * F.col("w")
             / F.nullif(F.max(F.when(at_first, F.col("weights"))).over(everything), F.lit(0.0)))
    return filled.select(
        "source", "source_size", "weight",
        F.when(F.col("stops"), F.col("cap"))
        .otherwise(F.least(F.coalesce(level, F.lit(0.0)), F.col("cap"))).alias("target"),
    )


def plan(sized: DataFrame, weigh, *, max_epochs: float = 3.0, share: float = 1.0) -> DataFrame:
    """One row per source: its target, the whole repetitions, and the last draw that gets one more.

    Draws are summed by slices first; only the slice in which the fractional rest is reached is
    sorted row by row.
    """
    sized = sized.withColumn("bin", _bin())
    bins = sized.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    sources = staged(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), "mix-sources")
    goals = (
        targets(weigh(sources), max_epochs, share)
        .withColumn("whole", F.coalesce(
            F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select(F.col("source").alias("of"), "source_size", "target", "whole", "rest")
    )
    same = F.col("source").eqNullSafe(F.col("of"))
    below = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    kept = ("source_size", "target", "whole", "rest")
    cuts = staged(
        bins.withColumn("below", F.coalesce(F.sum("bin_size").over(below), F.lit(0)))
        .join(goals, same, "left").drop("of")
        .groupBy(F.col("source").alias("of")).agg(
            F.min_by(F.struct("bin", "below"), F.when(
                F.col("below") + F.col("bin_size") > F.col("rest"), F.col("bin"))).alias("cut"),
            *[F.max(c).alias(c) for c in kept])
        .select("of", *kept, F.coalesce("cut.bin", F.lit(2 ** BINS)).alias("cut"),
                F.coalesce("cut.below", F.lit(0)).alias("below")), "mix-cuts")
    upto = Window.partitionBy("source").orderBy("draw", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        sized.join(cuts, same).filter(F.col("bin") == F.col("cut"))
        .withColumn("middle", F.col("below") + F.sum("size").over(upto) - F.col("size") / 2)
        .filter(F.col("middle") <= F.col("rest"))
        .groupBy("source").agg(F.max(F.struct("draw", "doc_id", "size")).alias("last"))
    )
    return staged(cuts.join(last, same, "left").select("of", *kept, "cut", "last"), "mix-plan")


def _bin() -> Column:
    return F.shiftright("draw", DRAW_BITS - BINS)


def dealt(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``source_size, target, repeats, taken`` to rows of ``doc_id, source, size, draw``."""
    more = (_bin() < F.col("cut")) | (
        (_bin() == F.col("cut")) & F.coalesce(F.struct("draw", "doc_id", "size") <= F.col("last"), F.lit(False)))
    repeats = F.col("whole") + more.cast("int")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("of")), "left") \
        .withColumns({"repeats": repeats, "taken": F.col("size") * repeats}) \
        .drop("of", "whole", "rest", "cut", "last")


def _sized(documents: DataFrame, seed: int) -> DataFrame:
    return documents.withColumns({"size": word_count(F.col("text")), "draw": draw(F.col("doc_id"), seed)})


def mix(documents: DataFrame, weigh, *, max_epochs: float = 3.0, share: float = 1.0,
        seed: int = 0) -> DataFrame:
    """How often each document enters the mix.

    ``weigh`` gets the sources (``source, source_size``, one row each) and returns them with a
    column ``weight``. A source whose target is e times its size takes every document floor(e)
    times; the fractional rest goes to documents in the order of their seeded draws until the words
    are nearest to the target. Result: ``doc_id, size, source_size, target, taken, source, repeats``,
    one row per row of ``documents``.

    A NULL source is a source. NULL and empty texts have size 0 and take 0 words. Repeated rows
    are documents of their own; those of one id and size are dealt alike. Other columns of
    ``documents`` are ignored. No documents, no rows.
    """
    sized = staged(_sized(documents.select("doc_id", "source", "text"), seed).drop("text"), "mix-sizes")
    return dealt(sized, plan(sized, weigh, max_epochs=max_epochs, share=share)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def mixed(documents: DataFrame, weigh, *, max_epochs: float = 3.0, share: float = 1.0,
          seed: int = 0) -> DataFrame:
    """The documents that enter the mix, whole rows with ``size, source_size, target, repeats,
    taken``; columns of these names are replaced, all others stay. No document enters more often
    than ``max_epochs`` rounded up, empty ones included."""
    small = _sized(documents.select("doc_id", "source", "text"), seed).drop("text")
    recipe = plan(staged(small, "mix-sizes"), weigh, max_epochs=max_epochs, share=share)
    added = ("size", "source_size", "target", "repeats", "taken")
    rows = carried(documents, F.col("doc_id"), F.col("source"), F.col("text"), without=added)
    limit = F.lit(math.ceil(max_epochs)).cast("long")
    return dealt(_sized(rows, seed).drop("text"), recipe).withColumn("repeats", F.least("repeats", limit)) \
        .filter("repeats > 0").select("_row.*", *added)
