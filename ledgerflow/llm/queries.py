"""Registered queries of the training-data operators: thin wrappers that read
a whole table, call one operator and keep the digest columns."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bestfit, bottomk, collocations, divergence, gru, guesscost, hilbert, lexicon, licences, pivotal, pstable, simhash, turnrepair
from .common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op4_licences": licences.oracle_sql(), "op13_collocations": collocations.oracle_sql()}


def register(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return fn


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register
def op1_guesscost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guesscost.scan(table(spark, sf_dir, "documents"))


@register
def op2_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru.score_documents(table(spark, sf_dir, "documents"))


@register
def op3_bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.compare_with_next(table(spark, sf_dir, "documents"))


@register
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@register
def op5_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op6_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@register
def op7_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(table(spark, sf_dir, "documents"))


@register
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op9_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # The mix needs sizes, not texts; the text column goes before any shuffle.
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", pivotal.word_count().alias("size"))
    x = pivotal.mix_sized(sized, "size")
    return x.select("doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                    (F.col("_copies") * F.col("size")).alias("taken"))


@register
def op10_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge_documents(table(spark, sf_dir, "documents"))


@register
def op12_turnrepair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turnrepair.report(table(spark, sf_dir, "conversations"))


@register
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
