"""License scans by diagonal voting: word grams joined to template positions, votes per offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import staged
from .columns import lowered, whole

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2

# label, text, base; a base phrase counts where its words stand consecutively
TEMPLATES = [
    ("cc-by", "cc by", True),
    ("gpl", "general public license", True),
    ("reserved", "all rights reserved", True),
    ("apache-2.0", "licensed under the apache license version 2 0", False),
    ("apache-2.0", "you may not use this file except in compliance with the license", False),
    ("mit", "released under the mit license", False),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", False),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", False),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", False),
    ("lgpl", "under the terms of the gnu lesser general public license", False),
    ("agpl", "under the terms of the gnu affero general public license", False),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", False),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", False),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", False),
    ("cc-by-nc", "creative commons attribution noncommercial", False),
    ("cc0", "to the extent possible under law the author has waived all copyright", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", False),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", False),
    ("unlicense", "this is free and unencumbered software released into the public domain", False),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", False),
]
NEIGHBOURS = 3  # words that an insertion or omission may shift the offset by
LEAST = 0.9  # share of a template's words that a span must hold
BROADCAST_GRAMS = 100_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(whole(text)), F.lit(WORDS), F.lit(0))


def grams(tokens: Column) -> Column:
    """Neighbouring words, joined."""
    return F.when(F.size(tokens) >= GRAM, F.zip_with(
        F.slice(tokens, 1, F.size(tokens) - 1), F.slice(tokens, 2, F.size(tokens) - 1),
        lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))


def template_grams(spark: SparkSession, templates: list[tuple[str, str, bool]]) -> DataFrame:
    """``template, label, base, n_template, at, tgram, thash``: a row per gram of a template.

    Templates need two words; NULL texts and shorter ones are left out."""
    rows = [(i, label, text, base) for i, (label, text, base) in enumerate(templates)]
    listed = spark.createDataFrame(rows, "template int, label string, text string, base boolean") \
        .withColumn("words", words(F.col("text"))).withColumn("n_template", F.size("words"))
    return listed.select("template", "label", "base", "n_template",
                         F.posexplode(grams(F.col("words"))).alias("at", "tgram")) \
        .withColumn("thash", F.xxhash64("tgram"))


def votes(documents: DataFrame, templates: list[tuple[str, str, bool]]) -> DataFrame:
    """``doc_id, key, template, label, base, n_template, offset, ats``: the template positions found
    at each offset between text and template.

    The grams of all texts are joined to all positions by hash, and the grams compared. ``key`` is a
    hash of the text; rows repeated with id and text vote once.
    """
    listed = template_grams(documents.sparkSession, templates)
    small = sum(len((t[1] or "").split()) for t in templates) <= BROADCAST_GRAMS
    shown = documents.select("doc_id", F.xxhash64("text").alias("key"), words(F.col("text")).alias("words")) \
        .select("doc_id", "key", F.posexplode(grams(F.col("words"))).alias("pos", "gram")) \
        .withColumn("hash", F.xxhash64("gram"))
    hits = shown.join(F.broadcast(listed) if small else listed,
                      (F.col("hash") == F.col("thash")) & (F.col("gram") == F.col("tgram")))
    return hits.groupBy("doc_id", "key", "template", "label", "base", "n_template",
                        (F.col("pos") - F.col("at")).cast("long").alias("offset")) \
        .agg(F.sort_array(F.collect_set("at")).alias("ats"))


def spans(votes: DataFrame) -> DataFrame:
    """``doc_id, key, label, base, start, end`` (words, end exclusive) ``, share``.

    A base phrase is every offset with all its votes. Other templates: offsets at most three
    words apart are one span with the share of the template's words it holds. If that is too long,
    each of its offsets starts a span: the one with the largest share, alone or with those that
    follow, of a length that fits.
    """
    exact = votes.filter(F.col("base") & (F.size("ats") == F.col("n_template") - 1)).select(
        "doc_id", "key", "label", "base", F.col("offset").alias("start"),
        (F.col("offset") + F.col("n_template")).alias("end"), F.lit(1.0).alias("share"))
    order = Window.partitionBy("doc_id", "key", "template").orderBy("offset")
    chained = votes.filter(~F.col("base")) \
        .withColumn("new", (F.col("offset") - F.lag("offset").over(order) > NEIGHBOURS).cast("int")) \
        .withColumn("chain", F.sum(F.coalesce("new", F.lit(0))).over(order))
    merged = chained.groupBy("doc_id", "key", "template", "label", "base", "n_template", "chain").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ats"))).alias("diagonals"))
    slack = F.floor(0.25 * F.col("n_template") + NEIGHBOURS).cast("int")

    def span(diagonals: Column) -> Column:
        ats = F.array_distinct(F.flatten(F.transform(diagonals, lambda d: d["ats"])))
        held = F.size(F.array_union(ats, F.transform(ats, lambda a: a + 1)))
        return F.struct((held / F.col("n_template")).alias("share"),
                        F.array_min(F.transform(diagonals, lambda d: d["offset"] + F.array_min(d["ats"]))).alias("start"),
                        F.array_max(F.transform(diagonals, lambda d: d["offset"] + F.array_max(d["ats"]) + GRAM)).alias("end"))

    def fits(s: Column) -> Column:
        return s["end"] - s["start"] <= F.col("n_template") + slack

    split = F.transform("diagonals", lambda d, i: F.array_max(F.filter(F.transform(
        F.sequence(F.lit(1), slack + 1), lambda n: span(F.slice("diagonals", i + 1, n))), fits)))
    placed = merged.withColumn("whole", span(F.col("diagonals"))).withColumn(
        "spans", F.when(fits(F.col("whole")), F.array("whole")).otherwise(F.array_distinct(split)))
    return exact.unionByName(placed.select("doc_id", "key", "label", "base", F.inline("spans"))
                             .select("doc_id", "key", "label", "base", "start", "end", "share"))


def licenses(documents: DataFrame, templates: list[tuple[str, str, bool]] | None = None,
             least: float = LEAST) -> DataFrame:
    """License labels of every row: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, key``.

    ``score`` is the largest share of a template that a span holds. NULL and empty texts have no
    words and score 0. Repeated rows stay and get the same result, a NULL id stays, other columns
    are ignored.
    """
    found = spans(staged(votes(documents, TEMPLATES if templates is None else templates), "votes"))
    told = found.groupBy(F.col("doc_id").alias("at"), F.col("key").alias("of")).agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("share") >= least, F.col("label")))), ",").alias("labels"),
        F.max("share").alias("score"))
    counted = documents.select("doc_id", F.xxhash64("text").alias("key"), F.coalesce(
        F.regexp_count(lowered(whole(F.col("text"))), F.lit(WORDS)), F.lit(0)).cast("long").alias("n_words"))
    return counted.join(told, F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("key") == F.col("of")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "key")
