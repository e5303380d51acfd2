"""Query of the URL filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import url_rules
from tessera.llm.common import read
from tessera.operators.lookup import lookup

#: Fixed values of the data contract: host, path, verdict.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def shown(url: Column) -> Column:
    """The doc_id of the document that a page shows: the number after the language in its path; else null."""
    return F.regexp_extract(url_rules.parts(url)[1], r"^/[^/]*/([0-9]{1,18})(?:[./]|$)", 1).try_cast("long")


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, verdict of the pages that show a labelled document; of several labels block wins."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    verdicts = labels.groupBy("doc_id").agg(F.max(F.when(bad, url_rules.BLOCK).otherwise(url_rules.ALLOW)).alias("verdict"))
    numbered = pages.select("page_id", shown(F.col("url")).alias("doc_id")).filter(F.col("doc_id").isNotNull())
    return lookup(numbered, verdicts, "doc_id", numbered.count()).select("page_id", "verdict")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    labels = page_labels(pages, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    judged = url_rules.judge(pages, labels, RULES)
    return judged.select(F.col("key").alias("page_id"), "host", "path", "rule", "verdict")


QUERIES = {"op6_url_rules": op6_url_rules}
