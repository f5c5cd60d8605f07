"""From raw documents to token files: toxicity, near duplicates, decontamination, mixing, token codes.

Each stage takes all that the one before kept, written as Parquet and read again; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallywork.llm.decontaminate import decontaminated
from tallywork.llm.mixing import remixed
from tallywork.llm.ngram_join import one_of_each
from tallywork.llm.shared import ship, written
from tallywork.llm.tokens import token_report
from tallywork.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return without_toxic(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    ship(spark)
    return one_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminated(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"), n=4, similarity=0.6)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are read at their target weights: every document once at least, those of small sources up to twice."""
    return remixed(docs, repetition=2.0)


def token_codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what they hold of each document, in file order."""
    return token_report(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1).drop("file", "at")


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_codes),
]

#: A fitted classifier and a tokenizer have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
