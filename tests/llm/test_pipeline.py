import corpus_pipeline
from pyspark.sql import functions as F

from .test_simhash import expected

FOLDER = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    """Every stage against a plain version over what the one before it kept."""
    import re
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near duplicates", "benchmark decontamination", "secrets", "mixing"]

    def kept(name, rows):
        out = corpus_pipeline.staged(stages[name](spark, rows, FOLDER), "test")
        if name != "mixing":
            assert out.columns == columns
        return out

    clean = kept("toxicity", docs)
    gone = {r.doc_id for r in docs.join(clean, "doc_id", "left_anti").collect()}
    assert gone and clean.exceptAll(docs).count() == 0

    alone = kept("near duplicates", clean)
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert sorted(r.doc_id for r in alone.collect()) == sorted({c for _, _, c in expected(rows)})

    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = kept("benchmark decontamination", alone)
    want = {r.doc_id for r in alone.collect() if not any(i in " ".join(re.findall(r"\w+", r.text.lower())) for i in items)}
    assert {r.doc_id for r in left.collect()} == want

    safe = kept("secrets", left)
    before, after = ({r.doc_id: r for r in f.collect()} for f in (left, safe))
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.text == re.sub(r"(?i)(?<=token = \")[0-9a-f]{40}|(?<=password=)[0-9a-f]{18}|AKIA[0-9A-Z]{16}", "[secret]", before[i].text)
        assert r.n_chars == (len(r.text) if "[secret]" in r.text else before[i].n_chars)

    mixed = kept("mixing", safe)
    for r in mixed.groupBy("source").agg(F.max("target").alias("goal"), F.sum("taken").alias("taken"), F.max("size").alias("most"),
                                         F.max("source_size").alias("size")).collect():
        assert abs(r.goal - r.taken) <= max(r.most, r.size * 0.5)
    assert mixed.filter("repeats < 1 or repeats > 3").count() == 0
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()) == sorted(r.doc_id for r in mixed.collect())
