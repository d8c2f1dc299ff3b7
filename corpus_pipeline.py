"""The corpus pipeline: five stages over ``documents``, each written as Parquet before the next reads it.

Defined cases: text that is null or has no letters goes in the first stage; rows of one doc_id are told apart
by their text, and equal ones are mixed as one document with the copies of all; a null doc_id stays null,
and such rows are told apart by their text; ids are integers; a null source is a source of its own; columns
beside those of documents go in the first stage; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm import decontamination, language_id, mixing, ngram_jaccard, substring_dedup
from tallyforge.llm.exchange import by_ids
from tallyforge.llm.queries import WEIGHTS
from tallyforge.llm.shared import doc_key, held_out, saved, shared_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.5


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` except those whose ``doc_key`` is one of ``keys`` (column doc)."""
    key, keys = doc_key(docs), saved(keys.distinct())
    some, none = by_ids(docs, keys, key)
    return some.join(keys, key == F.col("doc"), "left_anti").unionByName(none)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; text without letters or with an unsure verdict goes."""
    docs = docs.select(COLUMNS)
    model = language_id.train(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return language_id.identify(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    docs = docs.select(COLUMNS)
    return without(docs, ngram_jaccard.near_keys(docs).where("comp <> key").select(F.col("key").alias("doc")))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut; a document that is nothing else goes."""
    cut = substring_dedup.remove_repeats(docs.select(COLUMNS))
    changed = F.col("n_removed") > 0
    kept = cut.where(~(changed & (F.col("n_removed") == F.col("n_words"))))
    return kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    docs = docs.select(COLUMNS)
    keyed = docs.select(doc_key(docs).alias("doc_id"), "text")
    return without(docs, decontamination.leaks(keyed, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("doc")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy of a document that the mix takes."""
    docs = docs.select(COLUMNS)
    docs = docs.withColumns({"_key": doc_key(docs), "_same": F.xxhash64("source", "text")})
    # Equal rows of one id are one document here: it gets the copies that the mix takes of all of them.
    rows = docs.select(F.col("_key").alias("doc_id"), "_same", "source", "text")
    taken = mixing.mix(rows, WEIGHTS, ties=("_same",)).groupBy(F.col("doc_id").alias("_key"), "_same").agg(F.sum("copies").alias("copies")).where("copies > 0")
    one = Window.partitionBy("_key", "_same").orderBy("lang", "n_chars")
    docs = docs.withColumn("_n", F.row_number().over(one)).where("_n = 1").join(taken, ["_key", "_same"])
    return docs.select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_copies),
    ("substring_dedup", remove_repeated_passages),
    ("decontamination", remove_benchmark_leaks),
    ("mixing", mix_sources),
]

#: Similarity groups and language models are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    home = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{home}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
