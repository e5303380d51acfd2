"""Query of the document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import winnow
from tessera.llm.common import read


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = winnow.edited(read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(F.col("key").alias("doc_id"), "n_chars", "edited_sha256",
                       winnow.printed(F.col("kept")).alias("fingerprint"),
                       winnow.printed(F.col("edited_kept")).alias("edited_fingerprint"), "near_edited", "near_next")


QUERIES = {"op9_winnowing": op9_winnowing}
