"""URL filters: association rules over URL tokens, in DataFrame operations only.

1. ``parts``: host (lower case) and path of a url.
2. ``explicit``: the given (host, path, verdict) rules; the longest one that fits wins.
3. ``mine``: Spark's FP-growth finds the token combinations that labelled urls share;
   rules ``tokens -> block`` stay if their support (a share of the labelled urls, ``MIN_ROWS`` of
   them at least) and confidence reach the bounds and no more general rule is as confident.
4. ``matches``: an inverted index holds every rule under its rarest token, so that a url is
   only held against rules whose rarest token it has, and frequent tokens (``com``) match nothing.
   Urls with equal tokens are matched once.  The index is broadcast up to ``BROADCAST_RULES``
   rules and shuffled beyond.

Defined results: a null url, or one without ``://``, has empty host and path and no tokens, fits no
rule and is allowed; repeated rows get equal results; without labels nothing is mined and what
no given rule decides is allowed.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

MIN_SUPPORT = 0.001
MIN_ROWS = 20
MIN_CONFIDENCE = 0.6
BROADCAST_RULES = 10_000
BLOCK, ALLOW = "block", "allow"
LABEL = "label="


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def explicit(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(size, rule, verdict) of the longest of ``rules`` that fits, or null."""
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    return F.array_max(F.array(*fits))


def tokens(url: Column) -> Column:
    """Distinct tokens: host labels, registered domain, path segments (digits as N), query keys."""
    host, path = parts(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "N"), "/"), lambda x: x != "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1)), lambda x: x != "")
    named = lambda mark, values: F.transform(values, lambda x: F.concat(F.lit(mark), x))
    domain = F.filter(F.array(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)), lambda x: x != "")
    return F.array_sort(F.array_distinct(F.concat(named("h:", labels), named("d:", domain), named("p:", segments), named("q:", keys))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """antecedent, rarest, confidence, support: the rules that block, from (tokens, verdict) rows."""
    known = cut_lineage(labelled.filter(F.col("verdict").isNotNull() & (F.size("tokens") > 0)).select(
        F.array_append("tokens", F.concat(F.lit(LABEL), "verdict")).alias("items")))
    count = known.count()
    if count < MIN_ROWS:
        return labelled.sparkSession.createDataFrame([], "antecedent array<string>, rarest string, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, MIN_ROWS / count), minConfidence=min_confidence).fit(known)
    block = F.lit(LABEL + BLOCK)
    rules = (model.associationRules.filter(F.element_at("consequent", 1) == block)
             .filter(~F.exists("antecedent", lambda x: F.startswith(x, F.lit(LABEL))))
             .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"))
    rules = cut_lineage(rules.withColumn("id", F.array_join("antecedent", " ")))
    # a rule goes if the rule without one of its tokens is as confident
    wider = rules.select("id", "confidence", "antecedent", F.explode("antecedent").alias("without")).select(
        "id", "confidence", F.array_join(F.array_remove("antecedent", F.col("without")), " ").alias("wider"))
    general = rules.select(F.col("id").alias("wider"), F.col("confidence").alias("wider_confidence"))
    idle = wider.join(general, "wider").filter(F.col("wider_confidence") >= F.col("confidence")).select("id").distinct()
    rules = rules.join(idle, "id", "left_anti")
    freq = model.freqItemsets.filter(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), "freq")
    rarest = (rules.select("id", F.explode("antecedent").alias("token")).join(freq, "token").groupBy("id")
              .agg(F.min_by("token", F.struct("freq", "token")).alias("rarest")))
    return cut_lineage(rules.join(rarest, "id").select("antecedent", "rarest", "confidence", "support"))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """tokens, matched (the antecedent of the most confident rule that matches) of the distinct
    ``tokens`` of ``urls`` that a rule matches."""
    index = rules.select(F.col("rarest").alias("token"), "antecedent", "confidence")
    if rules.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    sets = urls.select("tokens").distinct()
    found = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token").filter(
        F.forall("antecedent", lambda x: F.array_contains(F.col("tokens"), x)))
    return found.groupBy("tokens").agg(F.max(F.struct("confidence", F.negative(F.size("antecedent")).alias("less"), "antecedent")).alias("best")).select(
        "tokens", F.col("best.antecedent").alias("matched"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict, matched of every page.

    ``labels`` (key, verdict) says block or allow for some pages; a page with both is to block.
    """
    host, path = parts(F.col(url))
    judged = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), tokens(F.col(url)).alias("tokens"))
    judged = cut_lineage(judged.withColumn("given", explicit(F.col("host"), F.col("path"), rules)))
    named = labels.select(F.col(key).alias("key"), F.col("verdict").alias("labelled")).groupBy("key").agg(F.max("labelled").alias("labelled"))
    known = judged.join(named, "key").select("tokens", F.col("labelled").alias("verdict"))
    found = matches(judged.filter("given is null"), mine(known))
    out = judged.join(found, "tokens", "left")
    return out.select("key", "host", "path", F.col("given.rule").alias("rule"),
                      F.coalesce(F.col("given.verdict"), F.when(F.col("matched").isNotNull(), BLOCK).otherwise(ALLOW)).alias("verdict"),
                      F.when(F.col("given").isNull(), F.array_join("matched", " ")).alias("matched"))
