"""Language identification by blended-spectrum string kernels.

Two texts are as alike as the sets of character n-grams (n = 1 to ``ORDERS``) of their
lower-cased letters have n-grams in common: K(x, y) = |x & y| / sqrt(|x| |y|).  n-grams are
counted as present or absent, over those of the landmarks (the vocabulary).

``fit`` takes, by hash of the key, about ``PER_LANGUAGE`` documents of each language (a uniform
sample; the one bound of this module), of these about ``LANDMARKS`` as Nystrom landmarks, and
solves one-versus-rest kernel ridge regression on the landmarks' features.  ``predict`` scores
batches: a matrix of presence bits times the landmarks', then times the folded weights.

Defined results: a null text, or one without a letter, is ``und`` with score 0; repeated rows
get equal results; with nothing learnt every text is ``und``; very long texts are read whole;
other columns of the input are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import hash_order, short_batches, then_give_back

ORDERS = 3
PER_LANGUAGE = 400
LANDMARKS = 96
VOCABULARY = 4_096
RIDGE = 1e-2
SLOTS_BITS = 18
UNDETERMINED = "und"
BATCH = 512
SLICE = 1 << 20


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # by slot: the vocabulary's n-gram, 0 for none
    index: np.ndarray  # by slot: its column
    landmarks: np.ndarray  # columns x landmarks
    lengths: np.ndarray  # square roots of the landmarks' n-gram counts
    weights: np.ndarray  # landmarks x languages


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, runs of anything but letters as one 32."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    kinds, back = np.unique(points, return_inverse=True) if len(points) > 64 else (points, np.arange(len(points)))
    plain = np.where([chr(c).isalpha() for c in kinds.tolist()], kinds, 32).astype("u8")[back]
    blank = plain == 32
    return plain[~(blank & np.concatenate(([True], blank[:-1])))] if len(plain) else plain


def grams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Codes of all n-grams: 21 bits a character."""
    code = points
    for n in range(1, ORDERS + 1):
        if n > 1:
            if len(points) < n:
                return
            code = (code[:-1] << np.uint64(21)) | points[n - 1:]
        yield code


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS_BITS)).astype("i8")


def presence(text: str, model: Model, out: np.ndarray) -> bool:
    """Mark the columns of the n-grams of ``text`` in ``out``; False if it has no letter."""
    seen = False
    for at in range(0, len(text), SLICE):  # slices share the characters that an n-gram spans
        points = letters(text[at:at + SLICE + ORDERS - 1])
        seen = seen or bool((points != 32).any())
        for code in grams(points):
            slot = _slot(code)
            slot = slot[model.codes[slot] == code]
            out[model.index[slot]] = 1
    return seen


def kernel(rows: np.ndarray, model: Model) -> np.ndarray:
    """Kernel values of the rows' presence bits with the landmarks."""
    own = np.sqrt(np.maximum(rows.sum(axis=1, dtype="f8"), 1.0))
    return (rows @ model.landmarks) / own[:, None] / np.maximum(model.lengths, 1.0)[None, :]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model | None:
    """Learn from the rows of ``docs`` that have a language."""
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    at = F.conv(F.substring(hash_order(F.lit("langid"), F.col("key")), 1, 8), 16, 10).cast("double") / 4294967296.0
    # a share of each language, so that neither the sample nor a task of it grows with the input
    share = {x: min(1.0, PER_LANGUAGE / n) for x, n in counts.items()}
    table = docs.sparkSession.createDataFrame(list(share.items()), "lang string, share double")
    sample = rows.join(F.broadcast(table), "lang").filter(at < F.col("share")).withColumn("at", at / F.col("share"))

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for t in batch.column("text"):
                found = [np.unique(g) for s in [t.as_py() or ""] for a in range(0, len(s), SLICE)
                         for g in grams(letters(s[a:a + SLICE + ORDERS - 1]))]
                made.append(np.unique(np.concatenate(found)).astype("i8") if found else np.zeros(0, "i8"))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("at"), pa.array(made, pa.list_(pa.int64()))],
                                             ["lang", "at", "codes"])

    sample = sample.select("lang", "at", "text").mapInArrow(vocabulary, "lang string, at double, codes array<long>").persist()
    per_language = max(1, LANDMARKS // len(counts))
    few = {x: per_language / max(1.0, n * share[x]) for x, n in counts.items()}
    chosen = sample.join(F.broadcast(docs.sparkSession.createDataFrame(list(few.items()), "lang string, few double")), "lang").filter("at < few")
    common = [r["code"] for r in chosen.select(F.explode("codes").alias("code")).groupBy("code")
              .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code").limit(VOCABULARY).collect()]
    if not common:
        sample.unpersist()
        return None
    codes, index = np.zeros(1 << SLOTS_BITS, "u8"), np.zeros(1 << SLOTS_BITS, "i4")
    for i, code in enumerate(np.array(common, "i8").astype("u8").tolist()):  # on a clash of slots the more common one stays
        slot = int(_slot(np.array([code], "u8"))[0])
        if not codes[slot]:
            codes[slot], index[slot] = code, i
    width = len(common)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for found in batch.column("codes"):
                row, code = np.zeros(width, "u1"), np.asarray(found.values, "i8").astype("u8")
                slot = _slot(code)
                row[index[slot[codes[slot] == code]]] = 1
                made.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("at"), pa.array(made, pa.binary())], ["lang", "at", "bits"])

    # about PER_LANGUAGE rows of VOCABULARY bits a language
    got = sample.mapInArrow(bits, "lang string, at double, bits binary").collect()
    sample.unpersist()
    got.sort(key=lambda r: (r["lang"], r["at"], bytes(r["bits"])))
    matrix = np.unpackbits(np.array([np.frombuffer(r["bits"], "u1") for r in got]), axis=1)[:, :width].astype("f4")
    languages = sorted(counts)
    marks = matrix[[r["at"] < few[r["lang"]] for r in got]]
    marks = np.unique(marks, axis=0)
    model = Model(languages, codes, index, np.ascontiguousarray(marks.T), np.sqrt(marks.sum(axis=1, dtype="f8")), np.zeros((0, 0)))
    values, vectors = np.linalg.eigh(kernel(marks, model))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])  # Nystrom: the inverse root of the landmarks' kernel
    features = kernel(matrix, model) @ whiten
    wanted = np.where(np.array([r["lang"] for r in got])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # every language weighs the same
    weigh = np.array([1.0 / max(1, sum(x["lang"] == r["lang"] for x in got)) for r in got])
    gram = features.T @ (features * weigh[:, None]) + RIDGE / len(got) * np.eye(features.shape[1])
    model.weights = whiten @ np.linalg.solve(gram, features.T @ (wanted * weigh[:, None]))
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` without ``text``, with the predicted language and its score (0 to 1)."""
    keep = [f for f in docs.schema.fields if f.name not in (text, out, score)]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, BATCH):
                batch = big.slice(start, BATCH)
                languages, scores = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
                if model is not None:
                    rows = np.zeros((batch.num_rows, model.landmarks.shape[0]), "f4")
                    known = np.array([bool(t.is_valid and presence(t.as_py(), model, rows[i])) for i, t in enumerate(batch.column(text))], bool)
                    values = kernel(rows, model) @ model.weights
                    # one-versus-rest values of -1 to 1, as shares
                    share = np.exp(4.0 * (values - values.max(axis=1, keepdims=True)))
                    share /= share.sum(axis=1, keepdims=True)
                    best = share.argmax(axis=1)
                    for i in np.flatnonzero(known).tolist():
                        languages[i], scores[i] = model.languages[best[i]], share[i, best[i]]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(languages, pa.string()), pa.array(scores)],
                                                 [*names, out, score])

    return short_batches(docs).mapInArrow(then_give_back(run), T.StructType([*keep, T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())]))
