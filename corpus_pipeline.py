"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage returns
as Parquet below the shared checkpoint folder and reads it again as the next one's input, so that a
lost executor repeats one stage at most.

Defined results: nulls, empty texts, repeated rows and empty tables are handled as the operators
say; null texts pass every stage as such; columns beside doc_id, text, lang, source and n_chars are
carried by every stage but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe_queries, mixing, mixing_queries, ngram_join, suffix_dedup, toxicity, toxicity_queries
from tessera.session import checkpoint_dir, ship_package

#: No SQL: learnt scores, hashed signatures and ranks of a vocabulary decide.
ORACLE_SQL = None


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    model = toxicity_queries.model(spark, docs, sf_dir)
    scored = toxicity.score(docs, model, out="toxicity__", keep_text=True)
    return scored.filter(F.col("toxicity__") < 0.5).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the document of least id stays."""
    return ngram_join.one_of_each(docs)


def no_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 100 that start earlier too leave the texts; n_chars follows."""
    cleaned = suffix_dedup.clean(docs, whole=True).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each time that the mix takes a document."""
    return mixing.mix(docs, mixing_queries.WEIGHTS, shard="shard__").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, as digests; decoding gives the texts back."""
    return bpe_queries.digests(docs)


STAGES = [("toxicity", not_toxic), ("near_copies", one_of_near_copies), ("repeated_strings", no_repeated_strings),
          ("mixing", mixed), ("byte_bpe", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
