"""One query per operation, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.chat import rotate
from tallywork.llm.decontaminate import contamination
from tallywork.llm.hard_negatives import hard_negatives
from tallywork.llm.mixing import mixed
from tallywork.llm.multi_index import nearest
from tallywork.llm.ngram_join import jaccard_components
from tallywork.llm.secret_scan import BASE, findings, scan
from tallywork.llm.shared import ship
from tallywork.llm.spelling import spelling_variants
from tallywork.llm.suffix_repeats import without_repeats
from tallywork.llm.tokens import token_report
from tallywork.llm.toxicity import toxicity
from tallywork.llm.url_lists import host, judge, keys
from tallywork.llm.word_lm import word_cross_entropy_difference

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(ship(spark), lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    QUERIES[function.__name__] = call
    return function


@_query
def op4_ngram_jaccard_join(spark, table):
    return jaccard_components(table("documents"), k=3, percent=90)


@_query
def op10_token_codes(spark, table):
    return token_report(table("documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1).drop("file", "at")


@_query
def op9_toxicity(spark, table):
    return toxicity(table("documents"), table("labels"), threshold=0.7)


@_query
def op1_benchmark_decontamination(spark, table):
    return contamination(table("documents"), table("benchmark"), n=4, similarity=0.6)


@_query
def op7_temperature_mixing(spark, table):
    return mixed(table("documents"), repetition=2.0)


@_query
def op5_perspective_rotation(spark, table):
    return rotate(table("conversations"))


def _number(*parts: Column | str) -> Column:
    """32 bits of an MD5 over the parts, for attributes that the tables lack."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _day(*parts: Column | str) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (_number(*parts) % 366).cast("int"))


def _action(*parts: Column | str) -> Column:
    return F.element_at(F.array(F.lit("block"), F.lit("allow"), F.lit("drop"), F.lit(None).cast("string")), (_number(*parts) % 4 + 1).cast("int"))


@_query
def op6_temporal_list_join(spark, table):
    """The pages have neither fetch days nor lists, so both are derived from them: three dated entries for the site of each
    host, and one for each page's own address."""
    pages = table("pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", _day("fetch", F.col("page_id")))
    hosts = pages.select(host(F.col("url")).alias("host")).where("host <> ''").distinct().withColumn("i", F.explode(F.array(*map(F.lit, range(3)))))
    sites = hosts.select(
        F.regexp_replace("host", r"^(www|m|blog)\.", "").alias("key"), _action("action", F.col("host"), F.col("i")).alias("action"), _day("day", F.col("host"), F.col("i")).alias("listed_on"),
    )
    own = pages.select(F.get(keys(F.col("url")), 0).alias("key"), _action("page", F.col("page_id")).alias("action"), _day("listed", F.col("page_id")).alias("listed_on"))
    return judge(captures, sites.unionByName(own))


@_query
def op8_secret_ledger(spark, table):
    """The added kinds come to a ledger that has the base kinds already, so the second scan runs only them."""
    docs = table("documents")
    return findings(docs, scan(docs, scan(docs, rules=BASE)))


@_query
def op2_inverted_multi_index(spark, table):
    return nearest(table("embeddings"), lambda i: i % 100 == 0, k=10)


@_query
def op3_cross_entropy_difference(spark, table):
    return word_cross_entropy_difference(table("documents"), table("labels").where("quality = 1"))


@_query
def op11_rotated_codes(spark, table):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table("embeddings"), lambda i: i % 50 == 0, n_positives=5, n_negatives=3, low_percent=50, high_percent=95, label=label)


@_query
def op12_spelling_variants(spark, table):
    return spelling_variants(table("documents"), least_letters=7, least_n=2, ratio=10, one_in=31)


@_query
def op13_suffix_repeats(spark, table):
    return without_repeats(table("documents"), length=200)
