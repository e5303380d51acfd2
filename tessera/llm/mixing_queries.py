"""Query of mixing sources to target weights, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing
from tessera.llm.common import read

WEIGHTS = [1, 2, 3]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.plan(read(spark, sf_dir, "documents", "doc_id", "source", "text"), WEIGHTS)
    return drawn.select(F.col("key").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), "taken")


QUERIES = {"op1_mix_sources": op1_mix_sources}

#: The level of the capped shares is found in closed form: sources by 3 * words / weight, the
#: first prefix of capped sources whose level doesn't exceed the next one's bound.
ORACLE = {"op1_mix_sources": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w
      FROM d GROUP BY source),
r AS (SELECT *, 3.0 * words / w AS bound, sum(words) OVER () AS total FROM s),
p AS (SELECT *, coalesce(sum(3 * words) OVER (ORDER BY bound, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
             sum(w) OVER (ORDER BY bound DESC, w DESC, source DESC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS free FROM r),
l AS (SELECT max(CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE)) FILTER (CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE) <= bound) AS level FROM p),
t AS (SELECT source, words, CASE WHEN w * level > 3 * words THEN CAST(3 * words AS DOUBLE) ELSE level * w END AS target FROM r, l),
o AS (SELECT d.*, t.words AS source_size, t.target, CASE WHEN t.words > 0 THEN floor(t.target / t.words) ELSE 0 END AS passes,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ord, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
       CAST(size * (passes + CASE WHEN size > 0 AND before + size / 2.0 <= target - passes * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o"""}
