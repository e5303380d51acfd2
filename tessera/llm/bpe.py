"""Byte-level BPE encoding and decoding of whole texts.

Texts of up to ``chunk_chars`` code points are encoded where they are.  Longer ones are cut
into chunks that overlap, and the chunks are handled in parallel:

1. every chunk is pre-tokenised from its own first character; its boundaries in the zone that
   it shares with a neighbour are kept (``overlap`` code points, without the last places, which
   more text could move);
2. per text, neighbours are stitched at the first boundary that both parses have.  A match of
   the pattern depends only on the text from its start on, so two parses that share a boundary
   agree from there on: the first chunk's parse is the true one, and by induction so is every
   parse from its stitch on.  Where two chunks never resynchronise (one endless run of
   letters), everything from the last stitch to the end of the text becomes one piece;
3. the pieces are encoded, and the ids joined in order.

Copies of a long text are encoded once.  Decoding concatenates the raw bytes of the ids.

Defined results: a null or empty text has no ids; repeated rows come out as often as they come
in; other columns of the input are carried along untouched.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fresh, short_batches, small, then_give_back
from tessera.session import cut_lineage

CHUNK_CHARS = 32_768
OVERLAP = 2_048
AHEAD = 2  # code points behind a token that can change it: the longest contraction less one


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str):
    """(tiktoken encoding, bytes by id) of a rank file; loaded once per worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    raw = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        raw[rank] = token
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), raw


def encode(text: str | None, path: str, pattern: str) -> np.ndarray:
    """Ids of one text as unsigned 32-bit integers."""
    if not text:
        return np.zeros(0, "<u4")
    encoding, _ = vocabulary(path, pattern)
    return np.asarray(encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), "<u4")


def decode(ids: bytes, path: str, pattern: str) -> bytes:
    """The raw bytes of little-endian unsigned 32-bit ids."""
    _, raw = vocabulary(path, pattern)
    return b"".join(map(raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def boundaries(chunk: str, pattern: str) -> list[int]:
    """Starts of the pattern's matches in ``chunk``, parsed from its first character."""
    import regex

    return [m.start() for m in regex.finditer(pattern, chunk)]


def stitch(rows: list[tuple[int, int, list[int], list[int]]]) -> list[tuple[int, int, int, int]]:
    """(index, piece, from, to) of each chunk from (index, start, head, tail) in order.

    ``head`` and ``tail`` are absolute boundaries in the zones shared with the chunk before and
    after.  ``to`` is -1 for "up to the chunk's own end"; the chunks of one piece are joined.
    """
    out, begin, piece = [], 0, 0
    for k, (index, start, _, tail) in enumerate(rows):
        if k + 1 == len(rows):
            out.append((index, piece, begin, -1))
            break
        common = sorted({b for b in tail if b >= begin}.intersection(rows[k + 1][2]))
        if not common:  # never in step again: one piece up to the end
            out.append((index, piece, begin, rows[k + 1][1]))
            for j in range(k + 1, len(rows)):
                out.append((rows[j][0], piece, rows[j][1], rows[j + 1][1] if j + 1 < len(rows) else -1))
            break
        out.append((index, piece, begin, common[0]))
        begin, piece = common[0], piece + 1
    return out


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
                     chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` without ``text`` and with ``ids``: the text's ids as little-endian unsigned 32-bit
    integers (binary)."""
    rest = [f for f in short_batches(docs).schema.fields if f.name not in (text, ids)]
    schema = T.StructType([*rest, T.StructField(ids, T.BinaryType())])
    names = [f.name for f in rest]
    size = F.coalesce(F.length(text), F.lit(0))

    def short_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = [encode(t.as_py(), path, pattern).tobytes() for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(made, pa.binary())],
                                             [*names, ids])

    short = docs.filter(size <= chunk_chars).select(*names, text).mapInArrow(then_give_back(short_texts), schema)
    key = fresh(docs, "text_key")
    long_docs = docs.filter(size > chunk_chars).withColumn(key, F.sha2(text, 256))
    long_ids = _encode_long(long_docs.select(F.col(key).alias("text_key"), F.col(text).alias("text")),
                            path, pattern, chunk_chars, overlap)
    long_ids = long_ids.select(F.col("text_key").alias(key), F.col("ids").alias(ids))
    return short.unionByName(long_docs.select(*names, key).join(long_ids, key).select(*names, ids))


def _encode_long(texts: DataFrame, path: str, pattern: str, chunk_chars: int, overlap: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, value in zip(batch.column("text_key"), batch.column("text"), strict=True):
                whole = value.as_py()
                starts = range(0, len(whole), chunk_chars)
                yield pa.RecordBatch.from_pydict({
                    "text_key": [key.as_py()] * len(starts), "chunk_no": np.arange(len(starts), dtype="i8"),
                    "chunk": [whole[s:s + chunk_chars + overlap] for s in starts]})

    # dealt out by (text, chunk), which also drops the chunks of copies
    chunks = (texts.mapInArrow(cut, "text_key string, chunk_no long, chunk string")
              .groupBy("text_key", "chunk_no").agg(F.first("chunk").alias("chunk")))
    chunks = cut_lineage(chunks)  # read twice: for the boundaries and for the pieces

    def zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, tail = [], []
            for number, value in zip(batch.column("chunk_no").to_pylist(), batch.column("chunk"), strict=True):
                chunk = value.as_py()
                at = boundaries(chunk, pattern)
                start = number * chunk_chars
                head.append([start + b for b in at if b < overlap])
                # a token that ends AHEAD before the chunk does is final, and so is the boundary there; later ones
                # could move with more text (a cut run, or "'l" of "'ll")
                tail.append([start + b for b in at if chunk_chars <= b <= len(chunk) - AHEAD])
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), batch.column("chunk_no"), pa.array(head, pa.list_(pa.int64())),
                 pa.array(tail, pa.list_(pa.int64()))], ["text_key", "chunk_no", "head", "tail"])

    def plan(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["chunk_no"].to_pylist(), table["head"].to_pylist(), table["tail"].to_pylist(),
                          strict=True))
        made = stitch([(n, n * chunk_chars, head, tail) for n, head, tail in rows])
        index, piece, begin, end = zip(*made, strict=True)
        return pa.table({"text_key": [table["text_key"][0].as_py()] * len(made), "chunk_no": pa.array(index, "i8"),
                         "piece": pa.array(piece, "i8"), "begin": pa.array(begin, "i8"),
                         "until": pa.array(end, "i8")})

    pieces = (chunks.mapInArrow(zones, "text_key string, chunk_no long, head array<long>, tail array<long>")
              .groupBy("text_key").applyInArrow(plan, "text_key string, chunk_no long, piece long, begin long, until long"))

    def encode_piece(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table[c].to_pylist() for c in ("chunk_no", "begin", "until", "chunk")), strict=True))
        text = "".join(chunk[begin - n * chunk_chars:(until - n * chunk_chars) if until >= 0 else None]
                       for n, begin, until, chunk in rows)
        return pa.table({"text_key": [table["text_key"][0].as_py()], "piece": [table["piece"][0].as_py()],
                         "ids": pa.array([encode(text, path, pattern).tobytes()], pa.binary())})

    def join_ids(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["piece"].to_pylist(), table["ids"].to_pylist(), strict=True))
        return pa.table({"text_key": [table["text_key"][0].as_py()],
                         "ids": pa.array([b"".join(x for _, x in rows)], pa.binary())})

    return (chunks.join(pieces, ["text_key", "chunk_no"]).groupBy("text_key", "piece")
            .applyInArrow(encode_piece, "text_key string, piece long, ids binary")
            .groupBy("text_key").applyInArrow(join_ids, "text_key string, ids binary"))


def decode_documents(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with ``out``: the raw bytes of its ids (null ids: no bytes)."""
    keep = [f for f in encoded.schema.fields if f.name != out]
    names = [f.name for f in keep]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = [decode(x.as_py() or b"", path, pattern) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(made, pa.binary())],
                                             [*names, out])

    return short_batches(encoded).select(*names).mapInArrow(then_give_back(decoded), T.StructType([*keep, T.StructField(out, T.BinaryType())]))
