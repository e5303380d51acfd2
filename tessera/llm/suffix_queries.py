"""Query of suffix-array deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import suffix_dedup
from tessera.llm.common import read


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.clean(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op4_suffix_dedup": op4_suffix_dedup}
