"""Corpus pipeline: five stages over ``documents``, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next one's docs. All but the last return
the columns of their input, in order, whatever other columns it has.

1. toxicity: rows scored 0.5 or more go. Learnt from ``labels`` (rows whose
   crc32(doc_id) mod 5 is not 0). A row without text stays.
2. near-dedup: of each SimHash group (three-word shingles, two bits) one row
   stays, the one with the smallest doc_id; rows without an id come last, and
   of rows that repeat an id the first in the file stays.
3. secrets: secret spans of the text are masked; n_chars, where there is such
   a column, follows the new text.
4. mix: each row is repeated, or left out, so that sources come near their
   target words.
5. pack: one row per piece of at most 2048 tokens, placed in a sequence.

SQL can't express them (learning, fingerprint groups, random rounding, BPE
ids), so ``ORACLE_SQL`` is None and the tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import bestfit, guesscost, lexicon, pivotal, simhash
from ledgerflow.llm.common import prepare, stored, table, unused
from ledgerflow.llm.queries import tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = lexicon.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = unused(docs, "_score")
    return docs.withColumn(score, lexicon.score_column(model)).filter(F.col(score) < 0.5).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    # Rows get a number of their own, fixed by writing it: ids may repeat or be missing.
    (row,) = unused(docs, "_row")
    x = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = simhash.near_duplicates(x, id_col=row).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    lead = x.select("doc_id", F.col(row).alias("row")).join(groups, "row").groupBy("group").agg(F.min(rank)["row"].alias("lead"))
    return x.join(lead, x[row] == lead["lead"], "left_semi").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = docs.withColumn("text", guesscost.redacted_column(words=guesscost.learn_words(docs)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    copies, copy = unused(docs, "_copies", "_copy")
    x = pivotal.mix(docs, copies_col=copies).filter(F.col(copies) > 0)
    return x.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bestfit.pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("secrets", secrets), ("mix", mix), ("pack", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
