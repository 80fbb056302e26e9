"""Near duplicates by SimHash: an index on byte positions, tallied bytes, verified bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .columns import carried
from .components import components

SEED = 42
STRIDE = 1 << 16  # shingles whose bits are counted at a time
LONG_LIST = 32  # fingerprints in one posting list whose pairs are counted; longer ones are narrowed


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority of the bits of XXH64 over word shingles, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[shingle - 1:] or ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, len(last), STRIDE):
        spans = zip(starts[low:low + STRIDE], last[low:low + STRIDE])
        hashes = np.array([digest(line[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    most = np.packbits((2 * ones > len(last)).astype(np.uint8), bitorder="little")
    return int(most.view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, key, fp``: key is a hash of the text, fp the fingerprint as a signed long."""
    kept = documents.select("doc_id", F.xxhash64("text").alias("key"), "text")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], "<u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view("<i8"))], names=["doc_id", "key", "fp"])

    return kept.mapInArrow(each, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, key long, fp long")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _mask(positions: tuple[int, ...]) -> int:
    """All bits of some byte positions, as a signed long."""
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) * (mask >> 63)


def _rest(positions: tuple[int, ...]) -> list[int]:
    return [p for p in range(8) if p not in positions]


# Lists of single positions would hold 1/256 of all fingerprints each, so a posting holds four. In this
# choice of fours any three positions lie together in exactly one: fingerprints that differ in 1, 2, 3
# bytes meet in 7, 3, 1 lists, in more bytes in one at most. The lists two share thus tell their bytes.
FOURS = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
LISTS_SHARED = {1: 7, 2: 3}


def _narrowed(max_distance: int) -> list[tuple[int, ...]]:
    """Choices of the 8 - d positions that fingerprints d bytes apart share."""
    return list(combinations(range(8), 8 - max_distance))


def _crowded(postings: DataFrame) -> DataFrame:
    """``choice, bytes, fp, count``: the postings of lists with two fingerprints or more."""
    lists = postings.groupBy("choice", "bytes").count().filter("count > 1") \
        .select(F.col("choice").alias("c"), F.col("bytes").alias("y"), "count")
    return staged(postings.join(lists, (F.col("choice") == F.col("c")) & (F.col("bytes") == F.col("y")))
                  .select("choice", "bytes", "fp", "count"), "postings")


def _within(lists: DataFrame, worth: int) -> DataFrame:
    """``a, b, n``: the pairs of every short list, each with what meeting in it is worth."""
    short = lists.filter(F.col("count") <= LONG_LIST).groupBy("choice", "bytes") \
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    return short.select("fps", F.explode("fps").alias("a")) \
        .select("a", F.explode("fps").alias("b")).filter("a < b").withColumn("n", F.lit(worth))


def tallied(fps: DataFrame, max_distance: int = 2) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of distinct fingerprints that share 8 - d positional bytes or more, and the
    postings ``choice, bytes, fp`` of lists that are still long after narrowing.

    Lists of up to 32 fingerprints give their pairs, which are counted over all lists by partial
    sums; pairs that reach the count are kept. Longer lists are narrowed: their members are listed
    anew under each choice of 8 - d positions that holds the four, where meeting is the full count.
    """
    least = LISTS_SHARED[max_distance]
    fours = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_mask(c))).alias("bytes"))
                      for i, c in enumerate(FOURS)])
    lists = _crowded(fps.select("fp", F.inline(fours)))
    narrow = _narrowed(max_distance)
    holding = F.array(*[F.array(*[F.lit(i) for i, wide in enumerate(narrow) if set(c) <= set(wide)]) for c in FOURS])
    masks = F.array(*[F.lit(_mask(c)) for c in narrow])
    again = lists.filter(F.col("count") > LONG_LIST) \
        .select("fp", F.explode(F.get(holding, F.col("choice"))).alias("choice")).distinct() \
        .select("choice", F.col("fp").bitwiseAND(F.get(masks, F.col("choice"))).alias("bytes"), "fp")
    lists_again = _crowded(again)
    counted = _within(lists, 1).union(_within(lists_again, least)).groupBy("a", "b").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least).select("a", "b"), lists_again.filter(F.col("count") > LONG_LIST)


def link_fingerprints(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Links ``a, b`` that join distinct fingerprints ``fp`` as all pairs within the distance would.

    Pairs with enough shared positional bytes are verified by their differing bits. Where more than
    32 fingerprints share the same 8 - d bytes, their number of pairs has no bound: each emits
    itself with each bit of its other bytes flipped; those that meet in one variant are at most two
    bits apart and hang on its smallest (for d = 1: on the variant itself). That is 17 variants at
    most a posting, so a third of all fingerprints in one list costs no more a row than any other.
    """
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance is 0, 1 or 2")
    if max_distance == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("a <> b")
    pairs, long = tallied(fps, max_distance)
    light = pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)

    def flips(positions: tuple[int, ...]) -> Column:
        bits = [8 * p + i for p in _rest(positions) for i in range(8)]
        return F.array(*[F.lit(m).cast("long") for m in [0, *((1 << i) - (1 << 64) * (i == 63) for i in bits)]])

    others = F.array(*[flips(c) for c in _narrowed(max_distance)])
    variants = long.select("fp", F.explode(F.get(others, F.col("choice"))).alias("flip")) \
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant")).distinct()
    head = F.min("fp") if max_distance == 2 else F.min(F.when(F.col("fp") == F.col("variant"), F.col("fp")))
    meeting = variants.groupBy("variant").agg(F.collect_list("fp").alias("fps"), head.alias("a"))
    heavy = meeting.filter("size(fps) > 1 and a is not null") \
        .select("a", F.explode("fps").alias("b")).filter("a <> b")
    return light.union(heavy)


def near_duplicates(documents: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id, root, key``, one row per row of ``documents``.

    Documents whose fingerprints differ in at most ``max_distance`` bits are linked;
    ``component_id`` is the smallest id that links reach. NULL and empty texts have fingerprint 0
    and are linked like any other; rows with a NULL id take part, and a component of only such rows
    has a NULL id. Repeated rows stay. Other columns are ignored. No documents, no rows.
    """
    own = staged(fingerprints(documents, shingle), "fingerprints")
    by_fp = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(link_fingerprints(by_fp.select("fp"), max_distance))
    placed = staged(
        by_fp.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    named = placed.join(
        placed.groupBy("root").agg(F.min("least").alias("component_id")), "root") \
        .select(F.col("fp").alias("at"), "root", "component_id")
    return own.join(named, F.col("fp") == F.col("at")).select(
        "doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id", "root", "key")


def keep_one(documents: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id
    (NULLs last) stays, of repeated rows one. Whole texts of any length count; all columns stay,
    whatever their names."""
    kept = staged(
        near_duplicates(documents, shingle, max_distance).groupBy("root").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("one"),
            F.count("*").alias("n"),
        ).select(F.col("one.doc_id").alias("kept_id"), F.col("one.key").alias("kept_key"), "n"),
        "kept")

    def those(which: DataFrame, *beside: Column) -> DataFrame:
        rows = carried(documents, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), *beside)
        return rows.join(which, F.col("_id").eqNullSafe(F.col("kept_id")) & (F.col("_key") == F.col("kept_key")), "left_semi")

    # only a component of several rows can hold a row twice
    alone = those(kept.filter("n = 1")).select("_row.*")
    several = those(kept.filter("n > 1"), F.col("text").alias("_text")).dropDuplicates(["_id", "_text"]).select("_row.*")
    return alone.unionByName(several)
