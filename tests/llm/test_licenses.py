import re

from pyspark.sql import functions as F

from siltline.llm import licenses
from siltline.llm.workload import op5_license_scan

DOCS = "doc_id long, text string"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def told(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_table_against_plain_search(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op5_license_scan(spark, folder).collect()
    assert len(rows) == len(texts) and sum(r.n_base for r in rows) > 0
    assert all(told(r) == plain(texts[r.doc_id]) and 0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    texts = [None, "", "cc", "CC-BY cc by CC\nBY", "all all rights reserved rights reserved", "É cc é by", "x " * 30_000 + "cc by",
             "cc by " * 2000]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(None, "all rights reserved"), (3, texts[3])], DOCS) \
        .withColumn("label", F.lit("x")).withColumn("words", F.lit(2))
    rows = licenses.licenses(frame).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert told(r) == plain("all rights reserved" if r.doc_id is None else texts[r.doc_id])
    assert licenses.licenses(spark.createDataFrame([], DOCS)).count() == 0


def test_spans_with_changes(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    texts = [mit, mit.replace("hereby granted", "hereby kindly granted"), mit.replace("granted", "given"),
             "copy of a charge to granted person any free is this", " word ".join(mit.split())]
    rows = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert [rows[i].labels for i in range(5)] == ["mit", "mit", "mit", "", ""]
    assert rows[0].score == 1.0 and rows[2].score < 1.0


def test_template_among_its_own_words(spark):
    texts = ["released under the mit license mit license mit license mit license",
             "creative commons x creative commons x creative commons attribution noncommercial",
             "mit license mit license mit license mit license mit license mit license"]
    rows = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert [rows[i].labels for i in range(3)] == ["mit", "cc-by-nc", ""]
    assert rows[0].score == rows[1].score == 1.0 and rows[2].score < 0.9


def test_own_templates(spark):
    own = [("mine", "do not copy", True), ("short", "word", False), ("none", None, False)]
    row = licenses.licenses(spark.createDataFrame([(1, "Do not copy. Do not copy!")], DOCS), own).first()
    assert (row.n_base, row.first_word, row.last_word, row.labels) == (2, 0, 3, "mine")
