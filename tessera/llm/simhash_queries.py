"""Query of SimHash near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.common import read


def components(docs: DataFrame) -> DataFrame:
    rows = simhash.grouped(docs)
    return rows.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op13_simhash": op13_simhash}
