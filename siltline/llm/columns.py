"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK = r"[\x20\x09-\x0D]+"
BLOCK = 100
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, empty for NULL."""
    return F.coalesce(text, F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def matches(frame: DataFrame, pattern: str, name: str, when: Column | None = None) -> DataFrame:
    """Adds ``name``: all leftmost matches of ``pattern`` in column ``text``, as an array of
    ``start, end`` (code points, end exclusive), ``found, before, after`` (the text up to the
    neighbouring matches).

    Built-in functions give the matches and the pieces between them, whose lengths add up to the
    places. ``when`` is a cheap test that texts with a match pass.
    """
    none = F.array().cast("array<string>")
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    step = frame.withColumn("_found", found if when is None else F.when(when, found).otherwise(none))
    step = step.withColumn("_found", F.coalesce("_found", none))
    step = step.withColumn("_pieces", F.when(F.size("_found") > 0, F.split("text", pattern, -1)).otherwise(none))

    none_at = F.array().cast("array<int>")
    # places are sums of lengths: of blocks first, then within a block, which stays near linear
    step = step.withColumn("_sizes", F.transform(
        "_found", lambda m, i: F.length(F.get("_pieces", i)) + F.length(m)))
    blocks = F.when(F.size("_sizes") > 0, F.sequence(F.lit(0), F.floor((F.size("_sizes") - 1) / BLOCK).cast("int")))
    step = step.withColumn("_blocks", F.transform(
        F.coalesce(blocks, none_at), lambda k: _total(F.slice("_sizes", k * BLOCK + 1, BLOCK))))
    step = step.withColumn("_upto", F.transform("_blocks", lambda b, k: _total(F.slice("_blocks", 1, k))))

    def place(m: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        end = F.get("_upto", block) + _total(F.slice("_sizes", block * BLOCK + 1, i % BLOCK + 1))
        return F.struct((end - F.length(m)).alias("start"), end.alias("end"))

    step = step.withColumn("_places", F.transform("_found", place))
    return step.withColumn(name, F.transform("_places", lambda p, i: F.struct(
        p["start"].alias("start"), p["end"].alias("end"),
        F.get("_found", i).alias("found"), F.get("_pieces", i).alias("before"),
        F.get("_pieces", i + 1).alias("after"),
    ))).drop("_found", "_pieces", "_places", "_sizes", "_blocks", "_upto")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, n: a + n)


def carried(documents: DataFrame, *beside: Column, without: tuple[str, ...] = ()) -> DataFrame:
    """The rows as one column ``_row``, so that no name of theirs meets one of ours, with the columns
    ``beside`` it. ``select("_row.*")`` gives them back."""
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in without]
    return documents.select(F.struct(*kept).alias("_row"), *beside)


def sampled(frame: DataFrame, key: str, about: int) -> DataFrame:
    """All rows, or ``about`` so many of them: those whose hash of ``key`` is below the share that
    this is. Needs one count and no sort."""
    share = min(1.0, about / max(1, frame.count()))
    return frame.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
