"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ngram_join
from tessera.llm.common import read


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ngram_join.grouped(read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(F.col("key").alias("doc_id"), "class_id", "n_links", "group_id")


QUERIES = {"op7_ngram_join": op7_ngram_join}
