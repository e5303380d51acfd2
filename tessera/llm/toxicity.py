"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

``fit`` learns from labelled rows only, at most about ``SAMPLE_ROWS`` of them (a uniform sample by
hash of the key; the one bound of this module), parted by hash into three folds:

* lexicon fold: words and word stems (prefixes of 4 to 6 bytes) whose share of toxic documents is
  clearly above the base rate (Wilson lower bound; near copies count once);
* tree fold: Spark ML's gradient-boosted trees over the features below;
* calibration fold: isotonic regression of the label on the trees' margin.

Features of a whole text: lexicon densities (words, stems, weights), proximity of lexicon words
to a second person, capitals of any script, shouted words, punctuation, obfuscation (letters spelt with
digits or signs or masked by ``*``, stretched letters) and length.  Nothing but the text enters a score.

Defined results: null and empty texts have zero features and get the score of those; repeated
rows get equal scores; with no labelled row of either class every score is 0; repeated labels
of one key count as toxic if any is; other columns of the input are carried along.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import hash_order, short_batches, then_give_back

if TYPE_CHECKING:  # workers import this module for the features: they need no learners
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import IsotonicRegressionModel

SAMPLE_ROWS = 12_000
MAX_LEXICON = 4_096
LIFT = 3.0
FEATURES = ["word_density", "stem_density", "weight_density", "max_weight", "log_hits", "near_second_person",
            "capitals", "shouted_words", "punctuation", "exclamations", "obfuscation", "stretched", "log_words"]
#: Second-person pronouns of the four languages.
SECOND_PERSON = frozenset(w.encode() for w in (
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros").split())
NEAR = 5

_PUNCTUATION = bytes(range(33, 48)) + b":;<=>?[\\]^_`{|}~"
_SPACED = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_MASKS = _PUNCTUATION.translate(None, b"$!*")
_KEPT_SIGNS = bytes.maketrans(_MASKS, b" " * len(_MASKS))
_PLAIN = bytes.maketrans(b"013457@$!", b"oieastasi")
#: A sign or digit between letters, or a sign in place of the first letter.
_ODD = re.compile(rb"[a-z][0-9@$!*]+[a-z]|(?<![^\s])[@$][a-z]")
_STRETCHED = re.compile(rb"([a-z])\1{3,}")


@dataclass
class Model:
    lexicon: dict[bytes, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None


def tokens(text: str) -> list[bytes]:
    """Lower-case words, without ASCII punctuation."""
    return text.lower().encode().translate(_SPACED).split()


def stems(word: bytes) -> list[bytes]:
    return [word[:n] + b"*" for n in (4, 5, 6) if len(word) > n]


def family(words: list[bytes]) -> int:
    """The least hash of the three-word shingles: near copies mostly share it."""
    grams = zip(words, words[1:], words[2:], strict=False)
    return min((zlib.crc32(b" ".join(g)) for g in grams), default=zlib.crc32(b" ".join(words)))


def by_length(lexicon: dict[bytes, float]) -> dict[int, list[bytes]]:
    """The whole words of the lexicon, heaviest first, for masked letters."""
    found: dict[int, list[bytes]] = {}
    for w in sorted(lexicon, key=lambda x: (-lexicon[x], x)):
        if not w.endswith(b"*"):
            found.setdefault(len(w), []).append(w)
    return found


def undisguised(word: bytes, lexicon: dict[bytes, float], lengths: dict[int, list[bytes]]) -> bytes | None:
    """The lexicon's word that ``word`` spells with digits, signs or masked letters (``*``), or None."""
    for bare in dict.fromkeys((word.rstrip(b"!$*"), word.strip(b"!$*"))):
        plain = bare.translate(_PLAIN)
        if plain in lexicon:
            return plain
        if 0 < plain.count(b"*") < len(plain):
            spelt = re.compile(b"[a-z]".join(map(re.escape, plain.split(b"*"))))
            if found := next(filter(spelt.fullmatch, lengths.get(len(plain), ())), None):
                return found
    return None


def capitals(text: str) -> int:
    """Characters that lower-casing changes, of any script."""
    if text.isascii():
        return sum(map(text.count, string.ascii_uppercase))
    lower = text.lower()
    if len(lower) != len(text):  # a letter of two in lower case
        return sum(map(str.isupper, text))
    return int(np.count_nonzero(np.frombuffer(text.encode("utf-32-le"), "u4") != np.frombuffer(lower.encode("utf-32-le"), "u4")))


def features(text: str | None, lexicon: dict[bytes, float], lengths: dict[int, list[bytes]] | None = None) -> list[float]:
    """The features of a whole text; ``lengths`` is ``by_length`` of the lexicon, made here if not given."""
    if not text:
        return [0.0] * len(FEATURES)
    if lengths is None:
        lengths = by_length(lexicon)
    words = tokens(text)
    n = max(1, len(words))
    raw = text.encode()
    weight: dict[bytes, float] = {}
    kinds = {b"": 0}
    for w in set(words):
        if w in lexicon:
            weight[w], kinds[w] = lexicon[w], 1
        else:
            best = max((lexicon.get(s, 0.0) for s in (w[:4] + b"*", w[:5] + b"*", w[:6] + b"*")), default=0.0) if len(w) > 4 else 0.0
            if best:
                weight[w], kinds[w] = best, 2
    # words spelt with digits or signs instead of letters, or with masked letters
    disguised = 0
    lower = raw.lower()
    if _ODD.search(lower):
        spelt: dict[bytes, bytes | None] = {}
        for w in lower.translate(_KEPT_SIGNS).split():
            if _ODD.search(w):
                disguised += 1
                if w not in spelt:
                    spelt[w] = undisguised(w, lexicon, lengths)
                if plain := spelt[w]:
                    weight[w], kinds[w] = lexicon[plain], 1
                    words.append(w)
    hits = [(i, w) for i, w in enumerate(words) if w in weight] if weight else []
    near = 0
    if hits and not SECOND_PERSON.isdisjoint(words):
        at = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
        near = sum(int(np.abs(at - i).min()) <= NEAR for i, _ in hits)
    letters = max(1, len(text))
    upper = capitals(text)
    shouted = sum(1 for w in text.split() if len(w) > 1 and w.isupper()) if upper > 1 else 0
    signs = len(raw) - len(raw.translate(None, _PUNCTUATION))
    return [sum(kinds[w] == 1 for _, w in hits) / n, sum(kinds[w] == 2 for _, w in hits) / n,
            sum(weight[w] for _, w in hits) / n, max(weight.values(), default=0.0), math.log1p(len(hits)), near / n,
            upper / letters, shouted / n, signs / letters, text.count("!") / letters, disguised / n,
            len(_STRETCHED.findall(lower)) / n, math.log1p(len(words))]


def with_features(docs: DataFrame, lexicon: dict[bytes, float], text: str = "text", keep_text: bool = False,
                  out: str = "features") -> DataFrame:
    """``docs`` with the feature array; its text only if asked for."""
    keep = [f for f in docs.schema.fields if f.name != out and (keep_text or f.name != text)]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = by_length(lexicon)
        for batch in batches:
            made = pa.array([features(t.as_py(), lexicon, lengths) for t in batch.column(text)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], made], [*names, out])

    return short_batches(docs).mapInArrow(then_give_back(run), T.StructType([*keep, T.StructField(out, T.ArrayType(T.DoubleType()))]))


def learn_lexicon(rows: DataFrame) -> dict[bytes, float]:
    """Words and stems (``stem*``) with their log-odds, from (text, label) rows."""
    def families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [family(tokens(t.as_py() or "")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.int64()), batch.column("label"), batch.column("text")],
                                             ["family", "label", "text"])

    once = (rows.select("label", "text").mapInArrow(families, "family long, label int, text string")
            .groupBy("family").agg(F.max_by(F.struct("label", "text"), F.struct("label", F.xxhash64("text"))).alias("x")).select("x.*"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        bad: Counter = Counter()
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text"), strict=True):
                units = {b""}
                for w in set(tokens(text.as_py() or "")):
                    if len(w) > 2:
                        units.add(w)
                        units.update(stems(w))
                seen.update(units)
                if label:
                    bad.update(units)
        if seen:
            unit = list(seen)
            yield pa.RecordBatch.from_pydict({"unit": pa.array(unit, pa.binary()), "n": [seen[u] for u in unit],
                                              "toxic": [bad[u] for u in unit]})

    units = (short_batches(once).mapInArrow(then_give_back(counts), "unit binary, n long, toxic long").groupBy("unit")
             .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).persist())
    total = units.filter(F.length("unit") == 0).first()  # the empty unit stands for every document
    if total is None or not total["toxic"]:
        units.unpersist()
        return {}
    base, z2 = total["toxic"] / total["n"], 2 * math.log(max(total["n"], 2))
    n, p = F.col("n"), F.col("toxic") / F.col("n")
    low = (p + z2 / (2 * n) - F.sqrt(z2 * (p * (1 - p) / n + z2 / (4 * n * n)))) / (1 + z2 / n)
    found = (units.filter((F.length("unit") > 0) & (F.col("toxic") >= 3)).withColumn("low", low)
             .filter(F.col("low") > min(LIFT * base, (1 + base) / 2))
             .orderBy(F.desc("low"), "unit").limit(MAX_LEXICON).collect())
    units.unpersist()
    return {bytes(r["unit"]): math.log((r["toxic"] + 0.5) / (r["n"] - r["toxic"] + 0.5) * (1 - base) / base) for r in found}


def fit(labelled: DataFrame, docs: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """Learn from ``labelled`` (key, label); their texts are found in ``docs`` by key."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    rows = (labelled.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key"))
            .agg(F.max(F.col(label).cast("int")).alias("label")))
    total = rows.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    at = F.conv(F.substring(hash_order(F.lit("toxicity"), F.col("key")), 1, 8), 16, 10).cast("double") / 4294967296.0
    fold = F.conv(F.substring(hash_order(F.lit("fold"), F.col("key")), 1, 7), 16, 10).cast("long") % 5
    rows = rows.filter(at < share).withColumn("fold", fold)
    # at most about SAMPLE_ROWS narrow rows: no text is shuffled to find the sample's texts
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(rows), "key").persist()
    lexicon = learn_lexicon(sample.filter("fold < 2"))
    made = with_features(sample.filter("fold >= 2").repartition(6), lexicon, "text").select(
        "fold", F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features")).persist()
    kinds = {(r["fold"] < 4, r["label"]) for r in made.select("fold", "label").distinct().collect()}
    trees = calibration = None
    if {(True, 0.0), (True, 1.0)} <= kinds:
        trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=20, maxDepth=3, stepSize=0.3,
                              minInstancesPerNode=2, seed=7).fit(made.filter("fold < 4").coalesce(2).sortWithinPartitions("features"))
        apart = made.filter("fold = 4") if (False, 1.0) in kinds else made
        margins = _margin(trees, apart).select("__margin", "label").coalesce(1)
        calibration = IsotonicRegression(labelCol="label", featuresCol="__margin", isotonic=True).fit(margins)
    made.unpersist()
    sample.unpersist()
    return Model(lexicon, trees, calibration)


def _margin(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return (trees.setPredictionCol("").setProbabilityCol("").setRawPredictionCol("__raw").transform(df)
            .withColumn("__margin", vector_to_array("__raw")[1]))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``out``, the calibrated probability that a text is toxic."""
    from pyspark.ml.functions import array_to_vector

    names = [c for c in docs.columns if c != out and (keep_text or c != text)]
    if model.trees is None or model.calibration is None:
        return docs.select(*names, F.lit(0.0).alias(out))
    df = with_features(docs, model.lexicon, text, keep_text, "__features")
    df = df.withColumn("__vector", array_to_vector("__features"))
    trees = model.trees.copy().setFeaturesCol("__vector")
    calibration = model.calibration.setFeaturesCol("__margin").setPredictionCol("__score")
    df = calibration.transform(_margin(trees, df))
    return df.select(*names, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("__score", F.lit(0.0)))).alias(out))
