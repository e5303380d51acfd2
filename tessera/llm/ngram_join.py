"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

1. ``signatures``: each text's set of word n-grams (``N`` words; a shorter text with words is one
   gram) gives ``bands`` hashes of ``rows`` minima each; ``choose_bands`` picks both for the target recall.
   Equal texts are one class: copies never meet as pairs.
2. Classes are shuffled by (band, hash).  A bucket goes if all its members already share an
   earlier bucket.  Its members are dealt by hash into tiles of about ``TILE`` rows, and every pair of
   tiles is a task of its own: no bucket is ever one group, and no pair of a bucket is a row.
3. A task verifies its pairs on the full sets (a blocked product of presence matrices over the
   grams that at least two members have).  A pair counts in the first band that it shares only.
   It returns each class's number of links, and the links themselves (``links``) or edges that
   span the linked groups (``grouped``).
4. ``graph.components`` contracts those edges by alternating large and small stars.

Keys that many rows share (a bucket of near copies, the class of many exact ones, a large group) get their
values by ``lookup``, so no join brings their rows together.

Defined results: texts without a word (null, empty, blank) have no grams and no links, and each
such document is a class and a group of its own; repeated rows are copies; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, short_batches, small, then_give_back
from tessera.llm.graph import components
from tessera.llm.rolling import Ranges, mixed
from tessera.operators.lookup import lookup
from tessera.session import cut_lineage

N = 5
THRESHOLD = 0.8
RECALL = 0.9995
MAX_HASHES = 128
TILE = 512
COLUMNS = 4_096
SEED = 11

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands reach ``recall`` at ``threshold`` within ``most`` hashes."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def grams(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text."""
    data = np.frombuffer((text or "").encode(), "u1")
    blank = np.concatenate(([True], _SPACE[data], [True]))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, "u8")
    words = Ranges(data).of(starts, ends)
    span = min(n, len(words))
    made = np.zeros(len(words) - span + 1, "u8")
    for j in range(span):
        made = mixed(made * np.uint64(3) + words[j:len(words) - span + 1 + j])
    return np.unique(made)


def band_hashes(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, bands * rows, dtype="u8") * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, dtype="u8")
    least = np.full(bands * rows, np.iinfo("u8").max, "u8")
    for start in range(0, len(found), 2_048):
        np.minimum(least, (found[start:start + 2_048, None] * a + b).min(axis=0), out=least)
    out = np.zeros(bands, "u8")
    for part in mixed(least).reshape(bands, rows).T:
        out = mixed(out * np.uint64(3) + part)
    return out.view("i8")


def class_key(text: str) -> bytes:
    return hashlib.md5(text.encode(), usedforsecurity=False).digest()


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD,
               recall: float = RECALL) -> DataFrame:
    """key, ck (the class: a digest of the text, null without words), bands of every document."""
    bands, rows = choose_bands(threshold, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            keys, made = [], []
            for value in batch.column("text"):
                whole = value.as_py()
                found = grams(whole, n)
                keys.append(class_key(whole) if len(found) else None)
                made.append(band_hashes(found, bands, rows) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(keys, pa.binary()), pa.array(made, pa.list_(pa.int64()))],
                                             ["key", "ck", "bands"])

    return short_batches(docs).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(then_give_back(run), "key long, ck binary, bands array<long>")


def buckets(classes: DataFrame, bands: int) -> DataFrame:
    """band, hash, ck, bands, tiles of the members of the buckets that hold pairs of their own."""
    every = classes.select("ck", F.posexplode("bands").alias("band", "hash")).select("ck", F.struct("band", "hash").alias("bucket"))
    full = cut_lineage(every.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"))
    count = classes.count() * bands
    held = lookup(every, full, "bucket", count)
    held = cut_lineage(held.join(classes.select("ck", "bands"), "ck"))
    # a bucket whose members all agree in an earlier band has no pair of its own
    same = F.lit(False)
    for u in range(bands):
        same = same | ((F.col("bucket.band") > u) & (F.col(f"lo{u}") == F.col(f"hi{u}")))
    idle = held.groupBy("bucket").agg(*[F.min(F.get("bands", F.lit(u))).alias(f"lo{u}") for u in range(bands)],
                                      *[F.max(F.get("bands", F.lit(u))).alias(f"hi{u}") for u in range(bands)])
    idle = cut_lineage(idle.filter(same).select("bucket", F.lit(True).alias("idle")))
    left = lookup(held, idle, "bucket", count, "left").filter("idle is null")
    return left.select(F.col("bucket.band").alias("band"), F.col("bucket.hash").alias("hash"), "ck", "bands",
                       F.ceil(F.col("members") / TILE).cast("int").alias("tiles"))


def _shared(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, column) of every gram that at least two sets have, and the number of columns."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    renumber = np.cumsum(often) - 1
    keep = often[column]
    return rows[keep], renumber[column[keep]], int(often.sum())


def verified(band: int, bands: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix left x right: pairs at the threshold that meet in ``band`` first."""
    row, column, width = _shared(sets)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(left), len(right)), "f4")
    for start in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, width - start)), "f4")
        part[row[lo:hi], column[lo:hi] - start] = 1
        common += part[left] @ part[right].T
    size = np.array([len(s) for s in sets], "f8")
    union = size[left][:, None] + size[right][None, :] - common
    good = common >= threshold * union - 1e-9
    for u in range(band):
        good &= bands[left, u][:, None] != bands[right, u][None, :]
    return good


def _tile(table: pa.Table, threshold: float, want_links: bool) -> list[tuple]:
    band, a, b = (table[c][0].as_py() for c in ("band", "a", "b"))
    keys = [bytes(x) for x in table["ck"].to_pylist()]
    tile = np.asarray(table["tile"])
    order = np.lexsort((np.array(keys, "S16"), tile))  # any order will do, as long as reruns agree
    keys, tile = [keys[i] for i in order], tile[order]
    bands = np.array(table["bands"].to_pylist(), "i8")[order]
    raw = table["grams"].to_pylist()
    sets = [np.frombuffer(raw[i], "u8") for i in order]
    left, right = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
    if not len(left) or not len(right):
        return []
    good = verified(band, bands, sets, left, right, threshold)
    if a == b:
        np.fill_diagonal(good, False)
    linked = np.zeros(len(keys), "i8")
    np.add.at(linked, left, good.sum(axis=1))
    if a != b:
        np.add.at(linked, right, good.sum(axis=0))
    out = [(keys[i], None, int(linked[i])) for i in np.flatnonzero(linked).tolist()]
    if want_links:
        i, j = np.nonzero(good)
        pairs = {(min(keys[left[x]], keys[right[y]]), max(keys[left[x]], keys[right[y]])) for x, y in zip(i.tolist(), j.tolist(), strict=True)}
        return out + [(x, y, 0) for x, y in pairs]
    # least labels along the links: edges that span each linked group of the tile
    label = np.arange(len(keys))
    while True:
        before = label.copy()
        high = len(keys)
        np.minimum.at(label, left, np.where(good, label[right][None, :], high).min(axis=1))
        np.minimum.at(label, right, np.where(good, label[left][:, None], high).min(axis=0))
        label = np.minimum(label, label[label])
        if (label == before).all():
            break
    return out + [(keys[i], keys[label[i]], 0) for i in np.flatnonzero(label != np.arange(len(keys))).tolist()]


def tiles(docs: DataFrame, rows: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD,
          recall: float = RECALL, want_links: bool = False) -> tuple[DataFrame, DataFrame]:
    """(classes: ck, rep; found: ck, other, n): n links of a class where ``other`` is null, else an edge."""
    bands, _ = choose_bands(threshold, recall)
    classes = rows.filter("ck is not null").groupBy("ck").agg(F.min("key").alias("rep"), F.first("bands").alias("bands"))
    classes = cut_lineage(classes)
    held = cut_lineage(buckets(classes, bands))
    # the full sets of one document a class, for the classes that are in a bucket
    wanted = held.select("ck").distinct().join(classes.select("ck", "rep"), "ck")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = pa.array([grams(t.as_py(), n).tobytes() for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("ck"), made], ["ck", "grams"])

    whole = docs.select(F.col(key).cast("long").alias("rep"), F.unhex(F.md5(F.col(text))).alias("own"), F.col(text).alias("text"))
    found = (whole.join(wanted.withColumnRenamed("rep", "wanted"), F.col("rep").eqNullSafe(F.col("wanted")) & (F.col("own") == F.col("ck")))
             .select("ck", "text").mapInArrow(full, "ck binary, grams binary").groupBy("ck").agg(F.first("grams").alias("grams")))
    tile = F.pmod(F.xxhash64("ck"), F.col("tiles")).cast("int")
    dealt = held.join(found, "ck").withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("band", "hash", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "ck", "bands", "grams")

    def run(table: pa.Table) -> pa.Table:
        made = _tile(table, threshold, want_links)
        ck, other, count = zip(*made, strict=True) if made else ((), (), ())
        if table.nbytes > 4 << 20:
            give_back()
        return pa.table({"ck": pa.array(ck, pa.binary()), "other": pa.array(other, pa.binary()), "n": pa.array(count, pa.int64())})

    result = dealt.groupBy("band", "hash", "a", "b").applyInArrow(run, "ck binary, other binary, n long")
    return classes.select("ck", "rep"), cut_lineage(result)


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """a, b: the representatives (least keys) of every two different texts at the threshold."""
    rows = cut_lineage(signatures(docs, key, text, n, threshold))
    classes, found = tiles(docs, rows, key, text, n, threshold, want_links=True)
    a, b = (classes.select(F.col("ck").alias(c), F.col("rep").alias(name)) for c, name in (("ck", "x"), ("other", "y")))
    return found.filter("other is not null").join(a, "ck").join(b, "other").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """key, ck, class_id (least key of the copies), n_links (different texts at the threshold) and
    group_id (least key of the linked texts, their links' and so on) of every document."""
    rows = cut_lineage(signatures(docs, key, text, n, threshold))
    classes, found = tiles(docs, rows, key, text, n, threshold)
    counts = found.filter("other is null").groupBy("ck").agg(F.sum("n").alias("n_links"))
    roots = components(found.filter("other is not null"))
    joined = cut_lineage(classes.join(counts, "ck", "left").join(roots, "ck", "left").withColumn("root", F.coalesce("root", "ck")))
    total = rows.count()
    least = joined.groupBy("root").agg(F.min("rep").alias("group_id"))
    joined = lookup(joined, least, "root", total).select("ck", F.col("rep").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "group_id")
    own = F.col("ck").isNull()
    return lookup(rows.select("key", "ck"), cut_lineage(joined), "ck", total, "left").select(
        "key", "ck", F.when(own, F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.when(own, F.col("key")).otherwise(F.col("group_id")).alias("group_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document, the least key, of each group; documents without words all stay."""
    rows = grouped(docs, key, text, n, threshold)
    kept = (rows.filter("ck is not null and key <=> group_id").groupBy("ck", "key").agg(F.count("*").alias("copies")))
    marked = docs.withColumn("__ck", F.when(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(F.col(text)))))
    kept = kept.withColumnsRenamed({"ck": "__kept", "key": "__key", "copies": "__copies"})
    stay = marked.join(kept, (F.col("__ck") == F.col("__kept")) & F.col(key).cast("long").eqNullSafe(F.col("__key")))
    alone = stay.filter("__copies = 1").select(*docs.columns)
    # of repeated rows under one key the one whose other columns have the least digest: reruns agree
    row = F.struct(*docs.columns)
    again = stay.filter("__copies > 1").groupBy("__ck").agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("__row")).select("__row.*")
    return alone.unionByName(again).unionByName(marked.filter("__ck is null").select(*docs.columns))
