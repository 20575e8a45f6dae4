"""From documents to token files: each stage works on all that the one before it kept.

1. toxicity: documents that the classifier scores 0.3 or more go;
2. simhash: of each group of near-duplicates the document with the least doc_id stays;
3. decontamination: documents with a twentieth or more of their words in benchmark windows go;
4. mixing: documents come as often as the mix of sources takes them, or not at all;
5. token_files: the rest is written as token files; the result is what reading them gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import saved
from tessera.llm.decontamination import contamination, is_contaminated
from tessera.llm.mixing import mixed
from tessera.llm.queries import held_out, table, tokenizer
from tessera.llm.simhash import classes, keep_one
from tessera.llm.token_files import round_trip
from tessera.llm.toxicity import score, train
from tessera.session import ship


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return docs.where(score(model, docs) < 0.3)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, classes(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contamination(docs, table(spark, sf_dir, "benchmark"), into="__contamination")
    return found.where(~is_contaminated("__contamination")).drop("__contamination")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs, tokenizer(), end_id=2)


STAGES = [("toxicity", toxicity), ("simhash", simhash), ("decontamination", decontamination), ("mixing", mixing), ("token_files", token_files)]

#: Hashes, a trained classifier and a tokenizer have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
