"""Query of periodic runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import periodic
from tessera.llm.common import read

SPACES = r"[\x20\x09-\x0D]+"


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where each document whose crc32 h ends in 0 repeats p of its words from word a to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    parts = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, F.filter(F.split("text", SPACES), lambda w: w != "")).alias("words"))
    n, a = F.size("words"), F.col("a")
    parts = parts.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    parts = parts.withColumn("p", (F.floor((n - a) / (F.col("g") % 8 + 3)) + 1).cast("int"))
    block = F.slice("words", a + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / F.col("p")).cast("int"))), F.lit(1), n - a)
    made = F.array_join(F.concat(F.slice("words", F.lit(1), a), again), " ")
    return parts.select("doc_id", F.when(F.coalesce(n, F.lit(0)) > 0, made).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    rows = periodic.collapse(docs)
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = F.col("strongest")
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
                       best["period"].alias("period"), F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
                       F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(planted(read(spark, sf_dir, "documents", "doc_id", "text")))


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
