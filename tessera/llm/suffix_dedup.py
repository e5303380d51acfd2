"""Removal of repeated byte strings by sorted suffixes, over all documents at once.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a smaller
document, or earlier in the same one).  Strings never cross documents and are judged on the input.

1. Anchors.  Each string's anchor is its ``GRAM``-byte gram of least hash (the rightmost of equals).
   Neighbouring strings with one anchor form a segment; equal strings have equal anchors, so they
   meet under the anchor's hash.  Within a batch, then under the anchor, segments equal as a
   whole keep their earliest place; every other place's bytes go at once.
2. Suffixes.  Where different segments share an anchor, their bytes (below 2 * ``length`` each) are
   dealt to shards by anchor; a shard's suffixes are sorted by recursive induction
   (``induced.py``: bucket queues, on disk if large), and neighbours with a common prefix of
   ``length`` bytes are equal strings, of which the earliest place stays.
3. Frequent anchors.  An anchor with over SHARD_BYTES of differing segments would fill a shard by
   itself (the rim of a passage that many copy, always in another context).  Its strings are dealt
   one by one by their own 128-bit hash, after each STRINGS of them have kept their earliest places.
   The bytes are counted over all rows, where an anchor's segments meet.  Anchors that a hundredth
   of a sample of the documents hold don't even meet there: their segments are dealt by (anchor,
   content) and take this route at once.  Both routes are exact for all rows.

Shuffled rows carry packed arrays.  Places are (document's order, byte), the order being the
key's; rows that share a key come one after another, by the first HEAD characters and
the digests of their texts, and null keys first.

Defined results: a null or empty text has no bytes; texts shorter than ``length`` lose nothing;
repeated rows lose what an earlier copy holds; an empty table gives no rows; other columns are
carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import induced
from tessera.llm.common import fresh, give_back, hash_order, short_batches, then_give_back
from tessera.llm.rolling import Ranges, mixed
from tessera.operators import prefix
from tessera.session import cut_lineage

RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
LENGTH = 100
GRAM = 32
PIECE = 1 << 18  # bytes handled at a time; fits the position bits below
POSITION_BITS = 24
BUCKET_BYTES = 8 << 20  # input bytes by bucket of anchors
SHARD_BYTES = 1 << 19
SAMPLE_DOCS = 4_000
FREQUENT = 0.01
HEAD = 64  # code points by which rows of one key are ordered before their digests
STRINGS = 1 << 17  # places of single strings held by a task at a time


def _pieces(docs: list[tuple[int, bytes]], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, valid starts, their document's order, their byte in it) of joined documents, up to PIECE
    bytes or one document; longer ones in overlapping parts."""
    held, total = [], 0
    for order, data in docs:
        for at in range(0, max(1, len(data) - length + 1), PIECE):
            part = data[at:at + PIECE + length - 1]
            if len(part) < length:
                continue
            held.append((order, at, part))
            total += len(part)
            if total >= PIECE:
                yield _joined(held, length)
                held, total = [], 0
    if held:
        yield _joined(held, length)


def _joined(held, length):
    sizes = np.array([len(p) for _, _, p in held])
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    count = sizes - length + 1
    inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return (np.frombuffer(b"".join(p for _, _, p in held), "u1"), np.repeat(begin, count) + inside,
            np.repeat(np.array([o for o, _, _ in held], "i8"), count), np.repeat(np.array([a for _, a, _ in held], "i8"), count) + inside)


def segments(docs: list[tuple[int, bytes]], length: int = LENGTH) -> dict[str, np.ndarray]:
    """anchor, content (hashes), order, start, size (bytes) of all segments of some documents, in order."""
    out = {k: [] for k in ("anchor", "content", "order", "start", "size")}
    window = length - GRAM + 1
    for data, starts, order, at in _pieces(docs, length):
        ranges = Ranges(data)
        gram = ranges.all(GRAM)
        low = np.uint64((1 << POSITION_BITS) - 1)
        least = (gram & ~low) | (low - np.arange(len(gram), dtype="u8"))
        span = 1
        while 2 * span <= window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < window:
            least = np.minimum(least[:len(least) - (window - span)], least[window - span:])
        place = (low - (least[starts] & low)).astype("i8")
        fresh_one = np.concatenate(([True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)))
        first = np.flatnonzero(fresh_one)
        last = np.concatenate((first[1:], [len(starts)])) - 1
        begin, end = starts[first], starts[last] + length
        content = ranges.of(begin, end)
        out["anchor"].append(gram[place[first]])
        out["content"].append(mixed(content + (place[first] - begin).astype("u8")))
        out["order"].append(order[first])
        out["start"].append(at[first])
        out["size"].append(end - begin)
    kinds = {"anchor": "u8", "content": "u8"}
    return {k: np.concatenate(v).astype(kinds.get(k, "i8")) if v else np.zeros(0, kinds.get(k, "i8")) for k, v in out.items()}


def earliest(*keys: np.ndarray, order: np.ndarray, start: np.ndarray) -> np.ndarray:
    """True at the earliest place of each combination of keys."""
    if not len(order):
        return np.zeros(0, bool)
    ranked = np.lexsort((start, order, *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[ranked][1:] != k[ranked][:-1]
    first = np.zeros(len(order), bool)
    first[ranked[new]] = True
    return first


def spans(order: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of the ranges, by document."""
    if not len(order):
        return order, start, end
    ranked = np.lexsort((start, order))
    order, start, end = order[ranked], start[ranked], end[ranked]
    new = np.concatenate(([True], order[1:] != order[:-1]))
    # a running maximum of the ends that begins anew with each document
    group = np.cumsum(new) - 1
    lift = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * lift) - group * lift
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return order[first], start[first], reach[np.concatenate((first[1:], [len(order)])) - 1]


_PACKED = ["anchor", "content", "order", "start", "size"]
_KINDS = {"anchor": "u8", "content": "u8", "order": "i8", "start": "i8", "size": "i8", "second": "u8"}


def _pack(columns: dict[str, np.ndarray], names: list[str], bucket: np.ndarray, count: int) -> Iterator[tuple[int, list[bytes]]]:
    ranked = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[ranked], np.arange(count + 1))
    for b in np.flatnonzero(np.diff(cut)).tolist():
        rows = ranked[cut[b]:cut[b + 1]]
        yield b, [columns[n][rows].tobytes() for n in names]


def _unpack(table: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
    return {n: np.frombuffer(b"".join(table[n].to_pylist()), _KINDS[n]) for n in names}


def _ranges_table(order, start, end) -> dict[str, pa.Array]:
    return {"order": pa.array(order, pa.int64()), "start": pa.array(start, pa.int64()), "until": pa.array(end, pa.int64())}


def ordered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int, int, str]:
    """(docs with a column that orders the rows, rows, bytes, its name).

    Integer keys that differ are their own order.  Otherwise (repeated, null or other keys) the rows are
    numbered by key and text, cut by ranges: many rows of one key are never one task's, and no number
    depends on the size of a key.
    """
    found = docs.agg(F.count("*").alias("rows"), F.count(key).alias("known"), F.sum(F.coalesce(F.octet_length(text), F.lit(0))).alias("bytes")).first()
    name = fresh(docs, "order")
    plain = isinstance(docs.schema[key].dataType, T.IntegralType) and found["known"] == found["rows"]
    if plain and (docs.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1) == 1:
        return docs.withColumn(name, F.col(key).cast("long")), found["rows"], found["bytes"] or 0, name
    tie = fresh(docs, "tie")  # tells equal rows apart; ``running`` writes it down before it is used
    numbered = prefix.row_number(docs.withColumn(tie, F.monotonically_increasing_id()), [],
                                 [F.col(key).asc_nulls_first(), F.substring(text, 1, HEAD).asc_nulls_first(), F.sha2(text, 256).asc(),
                                  F.col(tie).asc()], name)
    return numbered.drop(tie), found["rows"], found["bytes"] or 0, name


def routes(anchor: np.ndarray, size: np.ndarray, frequent: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(may hold equal strings, its strings go one by one) of each of the differing segments that met."""
    _, back, count = np.unique(anchor, return_inverse=True, return_counts=True)
    whole = np.zeros(len(count), "i8")
    np.add.at(whole, back, size)
    known = np.isin(anchor, frequent)
    meets = (count[back] > 1) | known
    return meets, known | (meets & (whole[back] > limit))


def removed(docs: DataFrame, order: str, text: str, rows: int, size: int, length: int = LENGTH) -> DataFrame:
    """order, start, until: byte ranges to remove (they may touch or overlap)."""
    buckets = max(1, -(-size // BUCKET_BYTES))
    frequent = _frequent(docs, order, text, rows, length)
    limit = SHARD_BYTES
    whole = docs.filter(F.octet_length(text) >= length).select(F.col(order).alias("order"), F.col(text).alias("text"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs_part in _documents(batches):
            found = segments(docs_part, length)
            first = earliest(found["anchor"], found["content"], order=found["order"], start=found["start"])
            o, s, e = spans(*(found[n][~first] for n in ("order", "start")), (found["start"] + found["size"])[~first])
            left = {n: found[n][first] for n in _PACKED}
            hot = np.isin(left["anchor"], frequent)
            bucket = (mixed(left["anchor"] ^ np.where(hot, left["content"], np.uint64(0))) % np.uint64(buckets)).astype("i8")
            packed = list(_pack(left, _PACKED, bucket, buckets))
            empty = [b""] * len(packed)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([b for b, _ in packed], pa.int64()),
                **{n: pa.array([x[i] for _, x in packed], pa.binary()) for i, n in enumerate(_PACKED)},
                **{n: pa.array(empty, pa.binary()) for n in ("gone_order", "gone_start", "gone_until")}})
            # what goes already travels along to any bucket
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([int(o[0]) % buckets if len(o) else 0], pa.int64()), **{n: pa.array([b""], pa.binary()) for n in _PACKED},
                "gone_order": pa.array([o.tobytes()], pa.binary()), "gone_start": pa.array([s.tobytes()], pa.binary()),
                "gone_until": pa.array([e.tobytes()], pa.binary())})

    def meet(table: pa.Table) -> pa.Table:
        found = _unpack(table, _PACKED)
        gone = [np.frombuffer(b"".join(table[n].to_pylist()), "i8") for n in ("gone_order", "gone_start", "gone_until")]
        first = earliest(found["anchor"], found["content"], order=found["order"], start=found["start"])
        end = found["start"] + found["size"]
        o, s, e = spans(*(np.concatenate(x) for x in zip(gone, (found["order"][~first], found["start"][~first], end[~first]), strict=True)))
        left = {n: found[n][first] for n in _PACKED}
        meets, hot = routes(left["anchor"], left["size"], frequent, limit)
        left = {n: v[meets] for n, v in left.items()}
        hot = hot[meets]
        del found, first, end
        give_back()
        return pa.table({"order": pa.array(np.concatenate((o, left["order"]))), "start": pa.array(np.concatenate((s, left["start"]))),
                         "until": pa.array(np.concatenate((e, left["start"] + left["size"]))),
                         "anchor": pa.array(np.concatenate((np.zeros(len(o), "i8"), left["anchor"].view("i8")))),
                         "kind": pa.array(np.concatenate((np.zeros(len(o), "i4"), np.where(hot, 2, 1).astype("i4"))))})

    packed = ", ".join(f"{n} binary" for n in [*_PACKED, "gone_order", "gone_start", "gone_until"])
    met = cut_lineage(whole.mapInArrow(then_give_back(anchors), f"bucket long, {packed}").groupBy("bucket").applyInArrow(
        meet, "order long, start long, until long, anchor long, kind int"))
    gone = met.filter("kind = 0").select("order", "start", "until")
    open_ones = met.filter("kind > 0")
    total = open_ones.agg(F.sum(F.col("until") - F.col("start"))).first()[0] or 0
    if not total:
        return gone
    shards = max(1, -(-int(total) // SHARD_BYTES))
    wanted = open_ones.groupBy("order").agg(F.collect_list(F.struct("start", "until", "anchor", "kind")).alias("parts"))
    snippets = cut_lineage(_with_bytes(docs.select(F.col(order).alias("order"), F.col(text).alias("text")), wanted).mapInArrow(
        then_give_back(_cut(length, shards, STRINGS)), "kind int, shard long, order binary, start binary, size binary, anchor binary, second binary, bytes binary"))

    def suffixes(table: pa.Table) -> pa.Table:
        made = _sorted_shard(table, length)
        give_back()
        return pa.table(_ranges_table(*made))

    def strings(table: pa.Table) -> pa.Table:
        found = _unpack(table, ["anchor", "second", "order", "start"])
        first = earliest(found["anchor"], found["second"], order=found["order"], start=found["start"])
        start = found["start"][~first]
        return pa.table(_ranges_table(*spans(found["order"][~first], start, start + length)))

    def cut_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o, s, n = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "i8") for c in ("order", "start", "size"))
            yield pa.RecordBatch.from_pydict(_ranges_table(o, s, s + n))

    out = "order long, start long, until long"
    at_once = snippets.filter("kind = 0").select("order", "start", "size").mapInArrow(cut_off, out)
    by_suffix = snippets.filter("kind = 1").groupBy("shard").applyInArrow(suffixes, out)
    by_string = snippets.filter("kind = 2").groupBy("shard").applyInArrow(strings, out)
    return gone.unionByName(at_once).unionByName(by_suffix).unionByName(by_string)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    """Documents of (order, text) batches, 8 PIECE bytes at a time."""
    held, total = [], 0
    for batch in batches:
        for order, text in zip(batch.column("order").to_pylist(), batch.column("text"), strict=True):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            held.append((order, data))
            total += len(data)
            if total >= 8 * PIECE:
                yield held
                held, total = [], 0
    if held:
        yield held


def _frequent(docs: DataFrame, order: str, text: str, rows: int, length: int) -> np.ndarray:
    """Hashes of the anchors that at least FREQUENT of a sample of the documents hold: below
    (anchors of a document) / FREQUENT of them."""
    share = min(1.0, SAMPLE_DOCS / max(rows, 1))
    at = F.conv(F.substring(hash_order(F.lit("anchors"), F.col(order)), 1, 8), 16, 10).cast("double") / 4294967296.0
    sample = docs.filter((at < share) & (F.octet_length(text) >= length)).select(F.col(order).alias("order"), F.col(text).alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _documents(batches):
            seen = segments(part, length)
            both = np.unique(np.stack([seen["order"].view("u8"), seen["anchor"]]), axis=1)
            anchor, count = np.unique(both[1], return_counts=True)
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor.view("i8")), "n": pa.array(count)})

    least = max(20, int(FREQUENT * min(rows, SAMPLE_DOCS)))
    often = sample.mapInArrow(found, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return np.sort(np.array([r["anchor"] for r in often.select("anchor").collect()], "i8").view("u8"))


def _with_bytes(docs: DataFrame, wanted: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` (order, text, ...) joined to ``wanted`` by order; texts are shuffled compressed, as ``z``."""
    keep = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in keep]

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            made = [squeeze.compress(t.as_buffer().to_pybytes()) if t.is_valid else None for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(made, pa.binary())], [*names, "z"])

    return docs.mapInArrow(press, T.StructType([*keep, T.StructField("z", T.BinaryType())])).join(wanted, "order", how)


def _cut(length: int, shards: int, most: int):
    names = ["order", "start", "size", "anchor", "second", "bytes"]

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        kind, shard, *rest = zip(*rows, strict=True)
        return pa.RecordBatch.from_pydict({"kind": pa.array(kind, pa.int32()), "shard": pa.array(shard, pa.int64()),
                                           **{n: pa.array(x, pa.binary()) for n, x in zip(names, rest, strict=True)}})

    def one_by_one(strings: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        """Of equal strings the earliest place goes on to its shard; the other places go at once."""
        joined = {n: np.concatenate([x[n] for x in strings]) for n in ("anchor", "second", "order", "start")}
        first = earliest(joined["anchor"], joined["second"], order=joined["order"], start=joined["start"])
        late = joined["start"][~first]
        o, s, e = spans(joined["order"][~first], late, late + length)
        rows = [(0, 0, *(x.tobytes() for x in (o, s, e - s)), b"", b"", b"")] if len(o) else []
        joined = {n: v[first] for n, v in joined.items()}
        bucket = (mixed(joined["anchor"]) % np.uint64(shards)).astype("i8")
        for b, (a, second, o, s) in _pack(joined, ["anchor", "second", "order", "start"], bucket, shards):
            rows.append((2, b, o, s, b"", a, second, b""))
        return rows_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_up = zstandard.ZstdDecompressor()
        strings: list[dict[str, np.ndarray]] = []
        places = 0
        for batch in batches:
            held: dict[tuple[int, int], list[list]] = {}
            for order, z, parts in zip(batch.column("order").to_pylist(), batch.column("z"), batch.column("parts").to_pylist(), strict=True):
                data = open_up.decompress(z.as_buffer().to_pybytes())
                for p in parts:
                    piece = data[p["start"]:p["until"]]
                    if p["kind"] == 1:
                        shard = int(mixed(np.array([p["anchor"]], "i8").view("u8"))[0] % np.uint64(shards))
                        held.setdefault((1, shard), []).append((order, p["start"], len(piece), p["anchor"], piece))
                        continue
                    raw = np.frombuffer(piece, "u1")
                    count = len(raw) - length + 1
                    strings.append({"anchor": Ranges(raw).all(length), "second": Ranges(raw[::-1]).all(length)[::-1],
                                    "order": np.full(count, order), "start": np.arange(p["start"], p["start"] + count)})
                    places += count
                    if places >= most:
                        yield one_by_one(strings)
                        strings, places = [], 0
            rows = []
            for (kind, shard), found in held.items():
                o, s, n, a, b = zip(*found, strict=True)
                rows.append((kind, shard, *(np.array(x, "i8").tobytes() for x in (o, s, n, a)), b"", b"".join(b)))
            if rows:
                yield rows_of(rows)
        if strings:
            yield one_by_one(strings)

    return run


def _sorted_shard(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges to remove among the strings of a shard's segments: a group of equal strings is a run of
    neighbouring suffixes, and its earliest place stays."""
    order, start, size = (np.frombuffer(b"".join(table[n].to_pylist()), "i8") for n in ("order", "start", "size"))
    data = np.frombuffer(b"".join(table["bytes"].to_pylist()), "u1")
    begin = np.cumsum(size) - size
    # a separator below every byte stands after each segment
    text = np.zeros(len(data) + len(size), "i8")
    inside = np.arange(len(data)) + np.repeat(np.arange(len(size)), size)
    text[inside] = data.astype("i8") + 1
    owner = np.repeat(np.arange(len(size)), size + 1)
    offset = np.arange(len(text)) - np.repeat(begin + np.arange(len(size)), size + 1)
    valid = offset + length <= size[owner]
    places, group = induced.grouped(*induced.sort_common(text, length), valid, length)
    o, s = order[owner[places]], start[owner[places]] + offset[places]
    later = ~earliest(group, order=o, start=s)
    return spans(o[later], s[later], s[later] + length)


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, whole: bool = False) -> DataFrame:
    """The columns of ``docs`` but ``text`` (and RESULTS), and n_bytes, n_removed, n_spans, kept_sha256; with ``whole``
    also the remaining text (of characters that lost a byte nothing stays)."""
    docs, rows, size, order = ordered(short_batches(docs), key, text)
    found = removed(docs, order, text, rows, size, length)
    gone = found.groupBy("order").agg(F.collect_list(F.struct("start", "until")).alias("gone"))
    rest = [f for f in docs.schema.fields if f.name not in (text, order) and f.name.lower() not in RESULTS]
    # own names for the carried columns: any may clash with the ones added here
    renamed = docs.select(F.col(order).alias("order"), F.col(text).alias("text"), *[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rest)])
    both = _with_bytes(renamed, gone, "left")
    added = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
             T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType())]
    carried = [f"c{i}" for i in range(len(rest))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_up = zstandard.ZstdDecompressor()
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for z, parts in zip(batch.column("z"), batch.column("gone"), strict=True):
                data = open_up.decompress(z.as_buffer().to_pybytes()) if z.is_valid else b""
                kept, runs, lost = data, 0, 0
                if parts.is_valid:
                    found = parts.values
                    start, end = (np.asarray(found.field(i), "i8") for i in (0, 1))
                    _, start, end = spans(np.zeros(len(start), "i8"), start, end)
                    edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    runs, lost = len(start), int((end - start).sum())
                values = (len(data), lost, runs, hashlib.sha256(kept).hexdigest(), _text(kept) if whole and z.is_valid else None)
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], *[pa.array(c, k) for c, k in zip(
                columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]], [*carried, *[f.name for f in added]])

    schema = T.StructType([*[T.StructField(c, f.dataType) for c, f in zip(carried, rest, strict=True)], *added])
    made = both.mapInArrow(then_give_back(cut), schema)
    final = made.select(*[F.col(c).alias(f.name) for c, f in zip(carried, rest, strict=True)], *[f.name for f in added][:4],
                        *([F.col("kept_text").alias(text)] if whole else []))
    return final


def _text(kept: bytes) -> str:
    return kept.decode("utf-8", "ignore")
