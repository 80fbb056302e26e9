"""Stages with extra columns that have every name the operators use themselves."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from siltline.llm import decontaminate, mixing, secrets, simhash

NAMES = ["_row", "_id", "_key", "_text", "_score", "_at", "_of", "_spans", "kept_id", "kept_key", "at", "of", "at_id", "at_key",
         "values", "value", "last", "cut", "whole", "rest", "draw", "bin", "key", "fp", "root", "canonical", "kept", "plain",
         "start", "end", "size", "target", "n_item", "item_id", "spans", "hash", "pos", "a.b"]
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 120")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_clashing_names(spark, docs, name, stage):
    wide = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in NAMES])
    plain, out = stage(spark, docs, FOLDER), stage(spark, wide, FOLDER)
    added = {"size", "target"} if name == "mixing" else set()
    carried = [n for n in NAMES if n not in added]
    assert set(out.columns) == set(plain.columns) | set(carried)
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect()) and rows
    assert all(r[n] == f"{n} {r.doc_id}" for r in rows for n in carried)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_table_and_odd_rows(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), FOLDER).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, "", "en", "web", 0), (900001, "", "en", "web", 0), (900002, "x", None, None, None)],
                                docs.schema)
    ids = [r.doc_id for r in stage(spark, odd.unionByName(docs), FOLDER).collect()]
    if name in ("toxicity", "secrets", "benchmark decontamination"):
        assert ids.count(900001) == 2 and 900002 in ids and None in ids


def test_text_ids(spark, docs):
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")))
    found = simhash.near_duplicates(named).select("doc_id", "component_id").collect()
    plain = simhash.near_duplicates(docs).select("doc_id", "component_id").collect()
    assert sorted((int(r[0][1:]), int(r[1][1:])) for r in found) == sorted((r[0], r[1]) for r in plain)
    assert simhash.keep_one(named).count() == simhash.keep_one(docs).count()


def test_marks_stand_where_secrets_were_found(spark, monkeypatch):
    text = "password=hunter2 and hunter2 again, token = abc"
    frame = spark.createDataFrame([(1, text, len(text)), (2, "nothing", 7)], "doc_id long, text string, n_chars long")
    found = [(1, 9, 16), (1, 12, 16), (1, 44, 47)]
    monkeypatch.setattr(secrets, "secrets", lambda d, labelled, threshold: d.filter("doc_id = 1").select(
        "doc_id", F.xxhash64("text").alias("key"), F.explode(F.array(*[F.struct(F.lit(s).alias("start"), F.lit(e).alias("end")) for _, s, e in found])).alias("p"))
        .select("doc_id", "key", "p.*"))
    out = {r.doc_id: r for r in secrets.redact(frame).collect()}
    assert out[1].text.startswith("password=[secret] and hunter2 again") and out[1].n_chars == len(out[1].text)
    assert (out[2].text, out[2].n_chars) == ("nothing", 7)


def test_no_document_exceeds_its_epochs(spark):
    rows = [(i, "" if i % 2 else "a b c", "s") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(frame, lambda s: s.withColumn("weight", F.lit(1.0)), max_epochs=3.0, share=3.0)
    assert out.agg(F.max("repeats")).first()[0] == 3


def test_suspects_hold_every_leak(spark, docs):
    """The semi join on templates alone loses no document that the whole comparison finds."""
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    listed = decontaminate.benchmark_items(bench, 8)
    sizes = sorted(r[0] for r in listed.select("size").distinct().collect())
    every = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = {r.at_id for r in decontaminate.suspects(every, listed, sizes).collect()}
    found = {r.doc_id for r in decontaminate.leaks(every, bench).collect()}
    assert found and found <= held and len(held) < every.count() / 2
