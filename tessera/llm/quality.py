"""Quality rules with adaptive thresholds, in DataFrame operations only.

``measure`` takes counts of each whole text.  ``sketches`` turns the rates of all documents that
pass the base rules into log-linear histograms per language and source: integer bins that keep
the leading ``SKETCH_BITS`` bits of a value (relative error 2**-6), so sketches merge by adding
counts, in any order, with one result.  ``thresholds`` reads quantiles off the sketch of the
(language, source), or, below ``MIN_DOCUMENTS`` documents, off the merged sketch of the language
or of everything, and sets fences around the median:

    median +- FENCE * max(q75 - q25, q90 - median, STEP[rate])

``judge`` joins the fences to the documents.  A short text gets an allowance of
``ALLOWANCE_WORDS`` words (``ALLOWANCE_LINES`` lines), as its rates are noisy.

Defined results: a null or empty text has no words and fails the base rules; null languages and
sources are groups of their own; repeated rows are judged alike; an empty table gives no rows;
other columns of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Fixed values of the data contract.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
SKETCH_BITS = 7
MIN_DOCUMENTS = 200
FENCE = 4
#: Least spread of each rate: symbols per 1000 words, characters per 100 words, repeated lines per 1000.
STEP = {"symbols": 50, "length": 50, "lines": 100}
ALLOWANCE_WORDS = 20
ALLOWANCE_LINES = 2


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` (and without columns of the names that follow), with n_words, word_chars, n_symbols, n_lines (with a word),
    n_dup_lines, n_repeat_words and base_failed."""
    rest = [c for c in docs.columns if c != text and c.lower() not in MEASURES]
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(whole, F.lit(SPACE))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    df = docs.select(
        *rest, F.when(F.length(bare) > 0, F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")).alias("__words"),
        F.length(F.translate(whole, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("__lines"))
    df = df.select(
        *rest, "word_chars", "n_symbols", F.size("__words").cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"))
    at = F.col("__hashes")
    df = df.withColumn("__grams", F.slice(F.transform(at, lambda h, i: F.xxhash64(
        h, *[F.get(at, i + j) for j in range(1, WINDOW)])), 1, F.greatest(F.size(at) - (WINDOW - 1), F.lit(0))))
    # only texts with a repeated window pay for finding its places
    again = F.size(F.array_distinct("__grams")) < F.size("__grams")
    df = df.withColumn("__sorted", F.when(again, F.sort_array(F.transform("__grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("__sorted")
    df = df.withColumn("__at", F.sort_array(F.transform(F.filter(
        s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))),
        lambda x: x["i"])))
    p = F.col("__at")
    covered = F.aggregate(F.transform(p, lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.select(*rest, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                     failed.alias("base_failed"))


def sketch_bin(value: Column) -> Column:
    """The value with all but its leading SKETCH_BITS bits cleared."""
    low = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, rate, bin, n: the mergeable histograms of all documents that pass the base rules."""
    good = measured.filter(~F.col("base_failed"))
    rates = F.explode(F.map_from_arrays(
        F.array(*[F.lit(k) for k in STEP]),
        F.array(F.expr("1000 * n_symbols div n_words"), F.expr("100 * word_chars div n_words"),
                F.expr("coalesce(1000 * n_dup_lines div n_lines, 0)"))))
    return (good.select(F.col(lang).alias("lang"), F.col(source).alias("source"), rates.alias("rate", "value"))
            .groupBy("lang", "source", "rate", sketch_bin(F.col("value")).alias("bin")).agg(F.count("*").alias("n")))


def _fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """One row per group: documents, and the lower and upper fence of each rate."""
    merged = sketch.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rate")  # at most a few thousand bins
    cum = merged.withColumns({"cum": F.sum("n").over(group.orderBy("bin")), "total": F.sum("n").over(group)})
    q = {p: F.min(F.when(100 * F.col("cum") >= p * F.col("total"), F.col("bin"))) for p in (25, 50, 75, 90)}
    wide = cum.groupBy(*keys, "rate").agg(F.first("total").alias("total"), *[v.alias(f"q{p}") for p, v in q.items()])
    step = F.create_map(*[F.lit(x) for kv in STEP.items() for x in kv])
    spread = F.greatest(F.col("q75") - F.col("q25"), F.col("q90") - F.col("q50"), step[F.col("rate")])
    of = lambda rate, x: F.max(F.when(F.col("rate") == rate, x))
    low, high = F.col("q50") - FENCE * spread, F.col("q50") + FENCE * spread
    return wide.groupBy(*keys).agg(F.max("total").alias("documents"), of("symbols", high).alias("max_symbols"),
                                   of("length", low).alias("min_length"), of("length", high).alias("max_length"),
                                   of("lines", high).alias("max_lines"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and the fences that hold for them."""
    names = ["max_symbols", "min_length", "max_length", "max_lines"]
    own, by_lang = _fences(sketch, "lang", "source"), _fences(sketch, "lang")
    every = _fences(sketch).select(*names).first()  # four numbers
    of_all = F.struct(*[F.lit(every[n] if every else None).cast("long").alias(n) for n in names])
    packed = F.struct(*[F.col(n).cast("long").alias(n) for n in names])
    own = own.select("lang", "source", "documents", packed.alias("own"))
    by_lang = by_lang.select(F.col("lang").alias("__lang"), F.col("documents").alias("lang_documents"), packed.alias("of_lang"))
    both = own.join(by_lang, own["lang"].eqNullSafe(by_lang["__lang"]))
    chosen = (F.when(F.col("documents") >= MIN_DOCUMENTS, F.col("own"))
              .when(F.col("lang_documents") >= MIN_DOCUMENTS, F.col("of_lang")).otherwise(of_all))
    return both.select("lang", "source", chosen.alias("f")).select("lang", "source", "f.*")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The measures of every document and ``kept``."""
    measured = cut_lineage(measure(docs, text))  # narrow: whole texts are measured once
    fences = thresholds(sketches(measured, lang, source))
    fences = fences.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    joined = measured.join(fences, measured[lang].eqNullSafe(fences["__lang"])
                           & measured[source].eqNullSafe(fences["__source"]), "left")
    words, lines = F.col("n_words"), F.col("n_lines")
    fits = ((1000 * F.col("n_symbols") <= F.col("max_symbols") * (words + ALLOWANCE_WORDS))
            & (100 * F.col("word_chars") <= F.col("max_length") * (words + ALLOWANCE_WORDS))
            & (100 * F.col("word_chars") >= F.col("min_length") * (words - ALLOWANCE_WORDS))
            & (1000 * F.col("n_dup_lines") <= F.col("max_lines") * (lines + ALLOWANCE_LINES)))
    return joined.select(*measured.columns, (~F.col("base_failed") & F.coalesce(fits, F.lit(True))).alias("kept"))
