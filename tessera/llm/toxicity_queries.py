"""Query of toxicity scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import toxicity
from tessera.llm.common import held_out, read


def model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learnt from the labelled rows that aren't held out."""
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic").filter(~held_out(F.col("doc_id")))
    return toxicity.fit(labels, docs)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity.score(docs, model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
