"""Benchmark decontamination by templates: typed placeholders, a hash join of windows, slot checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import is_small
from ..sources.staging import staged
from .columns import carried, whole

NUMBER, UNIT, NAME = "\ue001", "\ue002", "\ue003"  # private characters mark what was replaced
UNITS = ("km|cm|mm|kg|mg|ml|miles?|meters?|metres?|feet|foot|inch(?:es)?|pounds?|grams?|liters?|litres?|"
         "dollars?|euros?|cents?|percent|seconds?|minutes?|hours?|days?|weeks?|months?|years?|degrees?")
FIRST_NAMES = ("Tom|Ann|Anna|Mary|John|Jane|James|Peter|Paul|Sarah|Alice|Bob|Carol|David|Emma|Emily|Jack|"
               "Lucy|Maria|Mark|Mike|Sam|Susan|Tim|Kate|Ben|Lisa|Janet|Natalia|Weng")
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOKENS = r"[\uE001-\uE003][^ ]*|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\uE001-\uE003]+"
# a listed first name, or a capitalised word inside a sentence
NAMES = (r"(?<!\p{L})(?=\p{Lu})(?:(?:" + FIRST_NAMES + r")(?!\p{L})|\p{Lu}(?<=[\p{Ll},;] .)\p{Ll}++)")
FIGURE = r"([0-9](?:[0-9.,]*[0-9])?+)"  # without the point or comma after it
MEASURE = FIGURE + r"[.,]*+ ?((?i:" + UNITS + r"))(?!\p{L})"
PLAIN_NUMBER = r"(?<![0-9.,])" + FIGURE + r"[.,]*+"
LOOSE_TOKENS = 5  # shorter windows must hold the same values
BROADCAST_ROWS = 500_000
BROADCAST_SLOTS = 2_000_000  # characters of slot values in a broadcast table


def _typed(text: Column, keep: bool) -> Column:
    """Numbers, units and names as a placeholder each; with ``keep`` their text follows the mark."""
    marks = NUMBER + UNIT + NAME
    clean = F.when(text.rlike(f"[{marks}]"), F.translate(text, marks, "   ")).otherwise(text)

    def mark(kind: str, group: int) -> str:
        return f" {kind}${group}  " if keep else f" {kind}  "

    marked = F.regexp_replace(clean, MEASURE, mark(NUMBER, 1) + mark(UNIT, 2))
    marked = F.regexp_replace(marked, PLAIN_NUMBER, mark(NUMBER, 1))
    return F.lower(F.regexp_replace(marked, NAMES, mark(NAME, 0)))


def tokens(text: Column) -> Column:
    """Words in lower case and placeholders."""
    return F.array_remove(F.split(_typed(whole(text), False), SEPARATORS), "")


def kept_tokens(text: Column) -> Column:
    """The same tokens; a placeholder is followed by the text it stands for."""
    return F.regexp_extract_all(_typed(whole(text), True), F.lit(TOKENS), F.lit(0))


def _windows(canonical: Column, kept: Column, size: int) -> Column:
    """``size, pos, hash, slots`` for every run of ``size`` tokens. The hash of a short window, and of
    one with more placeholders than words, also holds the values of its slots."""
    def slotted(i: Column) -> Column:
        slots = F.filter(F.slice(kept, i, size), lambda t: t.between(NUMBER, NAME + "\uffff"))
        return F.struct(i.alias("pos"), F.when(F.size(kept) > 0, slots)
                        .otherwise(F.array().cast("array<string>")).alias("slots"))

    def window(w: Column) -> Column:
        template = F.slice(canonical, w["pos"], size)
        valued = F.xxhash64(template, w["slots"])
        hashed = valued if size < LOOSE_TOKENS else \
            F.when(2 * F.size(w["slots"]) > size, valued).otherwise(F.xxhash64(template))
        return F.struct(F.lit(size).alias("size"), w["pos"].alias("pos"), hashed.alias("hash"), w["slots"].alias("slots"))

    starts = F.when(F.size(canonical) >= size, F.sequence(F.lit(1), F.size(canonical) - (size - 1)))
    return F.transform(F.transform(F.coalesce(starts, F.array().cast("array<int>")), slotted), window)


def _tokenised(frame: DataFrame, *columns: Column) -> DataFrame:
    canonical = tokens(F.col("text"))
    # the kept form is needed only where there is something to keep
    kept = F.when(F.col("text").rlike(r"[0-9]|" + NAMES), kept_tokens(F.col("text"))) \
        .otherwise(F.array().cast("array<string>"))
    return frame.select(*columns, canonical.alias("canonical"), kept.alias("kept"))


def _hashes(canonical: Column) -> Column:
    """Every token's hash. To be a column of its own before :func:`_templates` cuts it into runs."""
    return F.transform(canonical, lambda t: F.xxhash64(t))


def _templates(hashes: Column, size: int) -> Column:
    """``size, plain`` for every run of ``size`` tokens: the hash of the template alone."""
    starts = F.when(F.size(hashes) >= size, F.sequence(F.lit(1), F.size(hashes) - (size - 1)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.struct(
        F.lit(size).alias("size"), F.xxhash64(F.slice(hashes, i, size)).alias("plain")))


def benchmark_items(benchmark: DataFrame, window: int) -> DataFrame:
    """``item_id, canonical, kept, n_item, size`` of all different items, each also as it reads inside
    a sentence, where a first word with a capital is a name."""
    listed = benchmark.select("item_id", "text").distinct()
    inside = _tokenised(listed.withColumn("text", F.concat(F.lit("x "), whole(F.col("text")))), F.col("item_id"))
    inside = inside.withColumns({c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))) for c in ("canonical", "kept")})
    return staged(_tokenised(listed, F.col("item_id")).union(inside).distinct()
                  .filter(F.size("canonical") > 0)
                  .withColumn("n_item", F.size("canonical"))
                  .withColumn("size", F.least("n_item", F.lit(window))), "benchmark")


def suspects(documents: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """``at_id, at_key`` of the documents that hold a run of template tokens of an item, whatever the
    slots: all windows of all documents are hashed and semi-joined with those of the items."""
    asked = staged(reduce(DataFrame.union, [
        items.filter(F.col("size") == size).select(_hashes(F.col("canonical")).alias("hashes"))
        .select(F.inline(_templates(F.col("hashes"), size))) for size in sizes])
        .select(F.col("size").alias("isize"), F.col("plain").alias("iplain")).distinct(), "templates")
    texts = documents.select(F.col("doc_id").alias("at_id"), F.xxhash64("text").alias("at_key"), _hashes(tokens(F.col("text"))).alias("hashes"))
    shown = texts.select("at_id", "at_key", F.inline(F.flatten(F.array(*[_templates(F.col("hashes"), s) for s in sizes]))))
    met = shown.join(F.broadcast(asked) if is_small(asked) else asked,
                     (F.col("plain") == F.col("iplain")) & (F.col("size") == F.col("isize")), "left_semi")
    return staged(met.select("at_id", "at_key").distinct(), "suspects")


def benchmark_windows(benchmark: DataFrame, window: int = 8) -> DataFrame:
    """``item_id, n_item, size, ipos, hash, islots, own``; items shorter than a window are one window.
    ``own``: no item of another template has this window.

    Windows with more placeholders than words and those of fewer than five tokens say little as
    templates; they are hashed with their values, so that only verbatim copies meet them. NULL texts
    count as empty, which have no windows; repeated rows of an item count once; items with a NULL id
    are kept under NULL.
    """
    items = benchmark_items(benchmark, window)
    return item_windows(items, window)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """The same of :func:`benchmark_items`."""
    # without its first token, which differs between an item's two forms
    template = F.xxhash64(F.slice("canonical", 2, F.size("canonical")))
    parts = [items.filter(F.col("size") == size).select(
        "item_id", "n_item", template.alias("template"), F.inline(_windows(F.col("canonical"), F.col("kept"), size)))
        for size in range(1, window + 1)]
    each = reduce(DataFrame.union, parts)
    owned = each.groupBy(F.col("size").alias("osize"), F.col("hash").alias("ohash")) \
        .agg((F.min("template") == F.max("template")).alias("own"))
    return each.join(owned, (F.col("size") == F.col("osize")) & (F.col("hash") == F.col("ohash"))) \
        .select("item_id", "n_item", "size", F.col("pos").alias("ipos"), "hash", F.col("slots").alias("islots"), "own")


def leaks(documents: DataFrame, benchmark: DataFrame, *, window: int = 8, min_tokens: int = 12) -> DataFrame:
    """Documents that hold benchmark items, also with other numbers, units or names.

    Texts become templates: numbers, units and names are typed placeholders. All windows of
    ``window`` template tokens of all documents are hash-joined with those of the items; the slots of
    the documents that meet one are then compared, window by window. Hits of a
    document and an item are grouped by their offset; a group counts if it covers ``min_tokens``
    tokens (or the whole of a shorter item) and its slots are consistent: a value of the item
    always stands for the same value of the document, and the other way round. Words that items of
    different templates share, such as a common question, are no leak of any of them: a group holds
    a window of its item's own, or the whole item.

    Result, one row per document and item: ``doc_id, item_id, n_tokens`` (covered), ``first_token``
    (from 0), ``n_slots``, ``exact`` (all slots keep their values), ``key`` (hash of the text).
    Rows repeated with id and text give one row. A NULL id stays NULL; NULL and empty texts and
    texts shorter than a window have no hits beyond short items. Other columns are ignored.
    """
    listed = benchmark_items(benchmark, window)
    items = staged(item_windows(listed, window), "benchmark-windows")
    size = items.agg(F.count("*"), F.sum(F.coalesce(F.length(F.concat_ws("", "islots")), F.lit(0)))).first()
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # window at most
    if not sizes:
        sizes = [window]
    small = size[0] <= BROADCAST_ROWS and (size[1] or 0) <= BROADCAST_SLOTS
    met = suspects(documents, listed, sizes)
    rows = documents.select("doc_id", "text").join(
        F.broadcast(met) if is_small(met) else met,
        F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.xxhash64("text") == F.col("at_key")), "left_semi")
    texts = _tokenised(rows, F.col("doc_id"), F.xxhash64("text").alias("key"))
    shown = texts.select("doc_id", "key", F.inline(F.flatten(F.array(*[
        _windows(F.col("canonical"), F.col("kept"), s) for s in sizes]))))
    other = items.withColumnRenamed("size", "isize").withColumnRenamed("hash", "ihash")
    hits = shown.join(F.broadcast(other) if small else other,
                      (F.col("hash") == F.col("ihash")) & (F.col("size") == F.col("isize"))) \
        .select("doc_id", "key", "item_id", "n_item", "size", "pos", "own", (F.col("pos") - F.col("ipos")).alias("offset"),
                F.arrays_zip(F.col("islots").alias("theirs"), F.col("slots").alias("ours")).alias("pairs"))
    runs = hits.groupBy("doc_id", "key", "item_id", "n_item", "size", "offset").agg(
        F.sort_array(F.collect_set("pos")).alias("at"), F.min("pos").alias("start"), F.max("own").alias("own"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    # tokens hit: a window adds what the next one doesn't
    covered = F.aggregate(F.transform("at", lambda p, i: F.least(
        F.col("size"), F.coalesce(F.get("at", i + 1) - p, F.col("size")))), F.lit(0), lambda a, n: a + n)
    same = F.col("pairs")
    distinct = [F.size(F.array_distinct(same[side])) for side in ("theirs", "ours")]
    agreed = runs.filter(
        (covered >= F.least(F.lit(min_tokens), F.col("n_item")))
        & (F.col("own") | (covered == F.col("n_item")))
        & (distinct[0] == F.size(same)) & (distinct[1] == F.size(same)))
    return agreed.groupBy("doc_id", "key", "item_id").agg(F.max(F.struct(
        covered.cast("long").alias("n_tokens"), (-F.col("start")).alias("minus"), F.size(same).alias("n_slots"),
        F.forall(same, lambda p: p["theirs"] == p["ours"]).alias("exact"))).alias("best")) \
        .select("doc_id", "item_id", "best.n_tokens", (-F.col("best.minus") - 1).cast("long").alias("first_token"),
                F.col("best.n_slots").cast("long").alias("n_slots"), "best.exact", "key")


def without_leaks(documents: DataFrame, benchmark: DataFrame, *, window: int = 8, min_tokens: int = 12) -> DataFrame:
    """The documents that hold no benchmark item, as they are: all columns stay, whatever their
    names. NULL and empty texts stay; of repeated rows all stay or all go. No documents, no rows."""
    found = leaks(documents, benchmark, window=window, min_tokens=min_tokens)
    leaked = staged(found.select(F.col("doc_id").alias("_at"), F.col("key").alias("_of")).distinct(), "leaks")
    rows = carried(documents, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"))
    return rows.join(leaked, F.col("_id").eqNullSafe(F.col("_at")) & (F.col("_key") == F.col("_of")), "left_anti").select("_row.*")
