"""Documents to a training mix, in stages; each stage's result is written and read again.

A stage takes the session, the documents its predecessor kept and the folder of the tables, and
returns documents; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltline.llm import decontaminate, mixing, secrets, simhash, toxicity
from siltline.llm.workload import weights_in_turn
from siltline.sources.staging import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rejected as toxic go; the others stay as they are."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=3, max_distance=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that enter the mix, with how often they do."""
    return mixing.mixed(docs, weights_in_turn, max_epochs=3.0)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# the first stage is a trained model, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
