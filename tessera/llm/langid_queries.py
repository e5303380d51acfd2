"""Query of language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid
from tessera.llm.common import held_out, read


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit(docs.filter(~held_out(F.col("doc_id"))))
    return langid.predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)


QUERIES = {"op10_language_id": op10_language_id}
