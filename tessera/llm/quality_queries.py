"""Query of the quality rules, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import quality
from tessera.llm.common import read


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read(spark, sf_dir, "documents", "doc_id", "lang", "source", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


QUERIES = {"op3_quality_rules": op3_quality_rules}


def _fences(keys: str) -> str:
    group = f"{keys}, rate" if keys else "rate"
    lead = f"{keys}, " if keys else ""
    return f"""
  SELECT {lead}max(total) AS documents, max(CASE WHEN rate = 'symbols' THEN q50 + 4 * spread END) AS max_symbols,
         max(CASE WHEN rate = 'length' THEN q50 - 4 * spread END) AS min_length,
         max(CASE WHEN rate = 'length' THEN q50 + 4 * spread END) AS max_length,
         max(CASE WHEN rate = 'lines' THEN q50 + 4 * spread END) AS max_lines
  FROM (SELECT {group}, max(total) AS total, min(bin) FILTER (100 * cum >= 50 * total) AS q50,
               greatest(min(bin) FILTER (100 * cum >= 75 * total) - min(bin) FILTER (100 * cum >= 25 * total),
                        min(bin) FILTER (100 * cum >= 90 * total) - min(bin) FILTER (100 * cum >= 50 * total),
                        CASE rate WHEN 'lines' THEN 100 ELSE 50 END) AS spread
        FROM (SELECT {group}, bin, sum(count(*)) OVER (PARTITION BY {group} ORDER BY bin) AS cum,
                     sum(count(*)) OVER (PARTITION BY {group}) AS total
              FROM bins GROUP BY {group}, bin) GROUP BY {group})""" + (f" GROUP BY {keys}" if keys else "")


ORACLE = {"op3_quality_rules": r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER () AS row_no FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT row_no, i, array_to_string(words[i:i + 4], ' ') AS gram
      FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
c AS (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, gram) AS n FROM g),
a AS (SELECT row_no, least(5, coalesce(lead(i) OVER (PARTITION BY row_no ORDER BY i) - i, 5)) AS k FROM c WHERE n > 1),
r AS (SELECT row_no, sum(k)::BIGINT AS k FROM a GROUP BY row_no),
m AS (SELECT doc_id, lang, source, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
             len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(k, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r USING (row_no)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
v AS (SELECT lang, source, 'symbols' AS rate, 1000 * n_symbols // n_words AS v FROM b WHERE NOT base_failed
      UNION ALL SELECT lang, source, 'length', 100 * word_chars // n_words FROM b WHERE NOT base_failed
      UNION ALL SELECT lang, source, 'lines', coalesce(1000 * n_dup_lines // n_lines, 0) FROM b WHERE NOT base_failed),
bins AS (SELECT lang, source, rate, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bin FROM v),
own AS (""" + _fences("lang, source") + r"""), of_lang AS (""" + _fences("lang") + r"""), of_all AS (""" + _fences("") + r"""),
f AS (SELECT own.lang, own.source,
        CASE WHEN own.documents >= 200 THEN own.max_symbols WHEN of_lang.documents >= 200 THEN of_lang.max_symbols ELSE of_all.max_symbols END AS max_symbols,
        CASE WHEN own.documents >= 200 THEN own.min_length WHEN of_lang.documents >= 200 THEN of_lang.min_length ELSE of_all.min_length END AS min_length,
        CASE WHEN own.documents >= 200 THEN own.max_length WHEN of_lang.documents >= 200 THEN of_lang.max_length ELSE of_all.max_length END AS max_length,
        CASE WHEN own.documents >= 200 THEN own.max_lines WHEN of_lang.documents >= 200 THEN of_lang.max_lines ELSE of_all.max_lines END AS max_lines
      FROM own JOIN of_lang ON own.lang IS NOT DISTINCT FROM of_lang.lang, of_all)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(1000 * n_symbols <= max_symbols * (n_words + 20) AND 100 * word_chars <= max_length * (n_words + 20)
           AND 100 * word_chars >= min_length * (n_words - 20) AND 1000 * n_dup_lines <= max_lines * (n_lines + 2), true) AS kept
FROM b LEFT JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source"""}
