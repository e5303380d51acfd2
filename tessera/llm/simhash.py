"""SimHash fingerprints of whole texts, and their near-duplicate groups by multi-index hashing.

``fingerprints``: each bit is the majority of that bit in the 64-bit hashes of all word shingles.

``grouped`` links fingerprints that differ in DISTANCE = 2 bits at most:

1. documents with one fingerprint are one class from the start;
2. each class enters the table under the small balls of its SEGMENTS: its fingerprint, and the fingerprint with
   one bit of one segment changed (32 entries for each of the two segments).  Two fingerprints one bit
   apart meet where one of them stands; two that differ in two bits meet halfway, with one bit changed in the
   one and the other bit in the other, be it in one segment or in both.  So no link is missed;
3. an entry is a whole fingerprint, so it holds at most the 65 fingerprints of the ball around it: no
   entry is ever large, whatever the share of near copies.  Each class of an entry is verified against the entry's
   least class over the complete fingerprints and linked to it: all of an entry's classes
   are within two bits of each other, so these links span it, and no pairs are emitted;
4. ``graph.components`` joins the links to groups.

Nothing but (key, fingerprint) rows is shuffled.

Defined results: words are the parts between ASCII white space, A-Z in lower case; below SHINGLE words the whole
sequence is the only shingle; a null, empty or blank text has fingerprint zero, which is linked like any
other; repeated rows are copies; null keys get the least key of their group, and null if that has none; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import short_batches, small, then_give_back
from tessera.llm.graph import components
from tessera.operators.lookup import lookup
from tessera.session import cut_lineage

SHINGLE = 3
SEED = 42
DISTANCE = 2
SEGMENTS = ((0, 32), (32, 64))  # bits from, to
BLOCK = 1 << 15  # shingles whose bits are counted at a time


def hashes(text: str | None, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The hashes of all shingles of a text, repeats included, BLOCK at a time."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    span = min(shingle, len(words))
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - span + 1]
    ends, of = ends[span - 1:], xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist(), strict=True)
        yield np.fromiter((of(joined[s:e], SEED) for s, e in pairs), "u8", min(BLOCK, len(starts) - at))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half the hashes, as a signed 64-bit integer."""
    count, ones = 0, np.zeros(64, "i8")
    for part in hashes(text, shingle):
        count += len(part)
        ones += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """key, fingerprint (a long) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), made], ["key", "fingerprint"])

    given = short_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return given.mapInArrow(then_give_back(run), f"key {docs.schema[key].dataType.simpleString()}, fingerprint long")


def links(classes: DataFrame) -> DataFrame:
    """ck, other: links that span the near-duplicate groups of ``classes`` (fingerprint, all different)."""
    own = F.col("fingerprint")
    ball = [own] + [own.bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for low, high in SEGMENTS for b in range(low, high)]
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # 65 rows a class: not left to a few small partitions
    entries = classes.select(own).repartition(tasks, own).select(own, F.explode(F.array(*ball)).alias("entry"))
    held = entries.groupBy("entry").agg(F.collect_set("fingerprint").alias("members")).filter(F.size("members") > 1)
    met = held.select(F.array_min("members").alias("other"), F.explode("members").alias("ck"))
    return met.filter((F.col("ck") != F.col("other")) & (F.bit_count(F.col("ck").bitwiseXOR(F.col("other"))) <= DISTANCE)).select("ck", "other")


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """key, fingerprint, component_id (the least key of the group) of every document."""
    rows = cut_lineage(fingerprints(docs, key, text, shingle))
    classes = cut_lineage(rows.groupBy("fingerprint").agg(F.min("key").alias("rep"), F.count("*").alias("copies")))
    found = classes.agg(F.count("*").alias("classes"), F.sum("copies").alias("rows")).first()
    roots = components(links(classes.select("fingerprint")))
    held = cut_lineage(classes.select(F.col("fingerprint").alias("ck"), "rep").join(roots, "ck", "left").withColumn("root", F.coalesce("root", "ck")))
    least = held.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = lookup(held.select("ck", "root"), least, "root", found["classes"]).select(F.col("ck").alias("fingerprint"), "component_id")
    return lookup(rows, cut_lineage(of_class), "fingerprint", found["rows"] or 0).select("key", "fingerprint", "component_id")
