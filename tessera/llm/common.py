"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the data contract.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One of the given tables, pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (compared without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(key) -> F.Column:
    """True for the rows that no model may learn labels from (null keys are never held out)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hash_order(*parts) -> F.Column:
    """A uniform, partition-independent order: md5 of the parts joined by '|' (nulls as empty)."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


BATCH_ROWS = 1_024
BATCH_BYTES = 4 << 20


def short_batches(df: DataFrame) -> DataFrame:
    """``df``; its session hands whole texts to Python ``BATCH_ROWS`` and ``BATCH_BYTES`` at a time at most
    (or one longer text), which bounds the buffers on both sides.

    The bounds are settings that a lazy plan reads when it runs, so they stay with the session; they are
    only ever lowered, and other results don't depend on them.
    """
    spark = df.sparkSession
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < size(spark.conf.get(name)) <= most:
            spark.conf.set(name, str(most))
    return df


def give_back() -> None:
    """Return this worker's freed memory to the system: workers live on for other tasks and stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU C library
        trim(0)


def then_give_back(run):
    """``run`` (batches to batches) that gives its memory back at the end of the task."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a worker holds the results of a few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
