"""Document fingerprints by winnowing, in DataFrame operations only.

``fingerprints``: a text's tokens are its words, and of unbroken runs of over ``LONG`` characters (a script
without blanks, one long string) every single character.  Tokens are hashed, every ``K`` neighbours give a k-gram
hash that slides along the text, and every window of ``W`` neighbouring k-grams keeps its minimum,
the rightmost one of equals.  A kept k-gram is one long: the hash's upper 40 bits and, below,
the position counted down (so that the least value is the rightmost minimum; positions run
modulo 2**24 tokens).  Guarantee: two texts that share ``K + W - 1`` neighbouring tokens share a
k-gram; a text with fewer k-grams than ``W`` is one window, one with fewer tokens than ``K`` is
one k-gram.

``with_next`` gives each row its successor by key (after the last: the first) without a global
window: cuts at quantiles of the key deal the rows into blocks, and the rows at a cut go to the
block before it as well, so that each text is shuffled once.  Only the cuts (``MAX_BLOCKS`` at
most) leave Spark.

Defined results: a null text is an empty one, with an empty fingerprint; the likeness of two
empty fingerprints is 1, of an empty and another one 0; null keys come first; rows of one key
follow each other by text; a table of one row is its own successor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
W = 8  # a power of two
SPACE = " \t\n\x0b\x0c\r"
ROWS_PER_BLOCK = 1024
MAX_BLOCKS = 4096
FAN = 64
LONG = 16
POSITIONS = 1 << 24


def fingerprints(df: DataFrame, text: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with ``out``: the kept k-grams of ``text`` as an array of longs, in order of position."""
    assert w & (w - 1) == 0
    names = [c for c in df.columns if c != out]
    bare = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE))
    words = F.when(F.length(bare) > 0, F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))
    parts = F.flatten(F.transform(words, lambda x: F.when(F.length(x) > LONG, F.split(x, "")).otherwise(F.array(x))))
    # only texts with such a run pay for taking it apart
    found = F.when(F.col(text).rlike(rf"[^\x20\x09-\x0D]{{{LONG + 1}}}"), parts).otherwise(words)
    df = df.select(*names, F.transform(found, lambda x: F.xxhash64(x)).alias("__h"))
    h = F.col("__h")
    grams = F.transform(h, lambda x, i: F.call_function(
        "shiftleft", F.call_function("shiftright", F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]), F.lit(24)), F.lit(24))
        + (F.lit(POSITIONS - 1) - i % POSITIONS))
    df = df.select(*names, F.slice(grams, 1, F.greatest(F.size(h) - (k - 1), F.least(F.size(h), F.lit(1)))).alias("__m"))
    df, span = df.withColumn("__n", F.size("__m")), 1
    while span < w:  # minima over 2, 4, ... neighbours
        df = df.select(*names, "__n", _nearest_least(F.col("__m"), span).alias("__m"))
        span *= 2
    kept = F.array_distinct(F.slice("__m", 1, F.greatest(F.col("__n") - (w - 1), F.least(F.col("__n"), F.lit(1)))))
    return df.select(*names, kept.alias(out))


def _nearest_least(values: Column, step: int) -> Column:
    return F.transform(values, lambda x, i: F.least(x, F.get(values, i + step)))


def printed(kept: Column) -> Column:
    """hash@position of each kept k-gram, blank between."""
    return F.array_join(F.transform(kept, lambda x: F.concat(
        F.lower(F.hex(F.call_function("shiftrightunsigned", x, F.lit(24)))), F.lit("@"),
        (F.lit(POSITIONS - 1) - x.bitwiseAND(F.lit(POSITIONS - 1))).cast("string"))), " ")


def hashes(kept: Column) -> Column:
    """The distinct hashes, without positions."""
    return F.array_distinct(F.transform(kept, lambda x: F.call_function("shiftright", x, F.lit(24))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def blocks(df: DataFrame, key: str) -> tuple[list, bool]:
    """Cuts of the key (the least value first) and whether it has nulls."""
    stats = df.agg(F.count("*").alias("n"), F.count(key).alias("known"), F.min(key).alias("least")).first()
    if not stats["known"]:
        return [], stats["n"] > 0
    count = max(1, min(MAX_BLOCKS, -(-stats["n"] // ROWS_PER_BLOCK)))
    cuts = {stats["least"]}
    if count > 1:
        cuts |= set(df.agg(F.percentile_approx(key, [i / count for i in range(1, count)], 10 * count)).first()[0])
    return sorted(cuts), stats["known"] < stats["n"]


def with_next(df: DataFrame, key: str, columns: dict[str, str]) -> tuple[DataFrame, Window]:
    """``df`` in blocks, with the next row's ``columns`` (old name -> new name), and the window.

    The rows whose ``__extra`` isn't 0 are copies from the block after; drop them in the end.
    """
    cuts, nulls = blocks(df.select(key), key)
    at = F.col(key)
    number = F.lit(0)
    first = at.isNull() if nulls else at == F.lit(cuts[0]) if cuts else F.lit(False)
    copies = [F.when(first, F.struct(F.lit(max(0, len(cuts) - 1)).alias("block"), F.lit(2).alias("extra")))]
    if len(cuts) > 1:
        rows = [cuts[i:i + FAN] for i in range(0, len(cuts), FAN)]
        table = F.array(*[F.array(*map(F.lit, row)) for row in rows])
        heads = F.array(*[F.lit(row[0]) for row in rows])
        coarse = F.greatest(F.size(F.filter(heads, lambda c: c <= at)), F.lit(1))
        here = F.element_at(table, coarse)
        number = F.when(at.isNull(), 0).otherwise((coarse - 1) * FAN + F.greatest(F.size(F.filter(here, lambda c: c <= at)), F.lit(1)) - 1)
        copies.append(F.when(F.array_contains(here, at) & (F.col("__block") > 0),
                             F.struct((F.col("__block") - 1).alias("block"), F.lit(1).alias("extra"))))
    names = df.columns
    dealt = df.withColumn("__block", number)
    places = F.array_compact(F.array(F.struct(F.col("__block").alias("block"), F.lit(0).alias("extra")), *copies))
    dealt = dealt.select(*names, F.explode(places).alias("__place")).select(
        *names, F.col("__place.block").alias("__block"), F.col("__place.extra").alias("__extra"))
    window = Window.partitionBy("__block").orderBy("__extra", F.col(key).asc_nulls_first(), *columns)
    return dealt.withColumns({new: F.lead(old).over(window) for old, new in columns.items()}), window


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_chars, edited_sha256, and the kept k-grams of the text, of the text whose second half
    gave way to the next document's beginning, and the likeness to that and to the next text."""
    whole = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, window = with_next(whole, "key", {"text": "next_text"})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("key", "__block", "__extra", "text", n.cast("long").alias("n_chars"), F.concat(
        F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)).alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    rows = fingerprints(rows, "text", "kept")
    rows = fingerprints(rows, "edited", "edited_kept")
    rows = rows.withColumn("own", hashes(F.col("kept")))
    rows = rows.withColumn("next_own", F.lead("own").over(window)).filter(F.col("__extra") == 0)
    return rows.select("key", "n_chars", "edited_sha256", "kept", "edited_kept",
                       likeness(F.col("own"), hashes(F.col("edited_kept"))).alias("near_edited"),
                       likeness(F.col("own"), F.coalesce("next_own", "own")).alias("near_next"))
