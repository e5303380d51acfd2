import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tessera.llm import induced, suffix_dedup as sd
from tests.llm.conftest import prose


def brute(docs, length=100):
    """(n_bytes, n_removed, n_spans, sha256) of each text, in the order of ``docs``."""
    seen, out = set(), []
    for text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if (string := data[s:s + length]) in seen:
                gone[s:s + length] = b"\1" * length
            else:
                seen.add(string)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((len(data), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("block", [1, 3, 1 << 18])
def test_suffix_order(block, monkeypatch):
    monkeypatch.setattr(induced, "BLOCK", block)
    monkeypatch.setattr(induced, "MEMORY_BYTES", 100)  # the queue is a file for all but tiny texts
    rng = random.Random(block)
    for _ in range(150):
        text = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 50))]
        assert induced.sort(np.array(text, "i8")).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("block", [1, 5, 1 << 18])
def test_common_prefixes_are_carried(block, monkeypatch):
    monkeypatch.setattr(induced, "BLOCK", block)
    rng = random.Random(10 + block)
    for _ in range(150):
        kinds, limit = rng.choice([1, 2, 3, 9]), rng.choice([1, 3, 100])
        text = [rng.randrange(kinds) for _ in range(rng.randint(1, 50))]
        order = sorted(range(len(text)), key=lambda i: text[i:])
        want = [0]
        for a, b in zip(order, order[1:], strict=False):
            same = 0
            while same < limit and max(a, b) + same < len(text) and text[a + same] == text[b + same]:
                same += 1
            want.append(same)
        got = induced.sort_common(np.array(text, "i8"), limit)
        assert got[0].tolist() == order and np.asarray(got[1]).tolist() == want


def test_repeats():
    data = b"0123456789abc" + b"xyz" + b"0123456789ab" + b"!" + b"123456789"
    places, group = induced.repeats(data, 9)
    found = {}
    for p, g in zip(places.tolist(), group.tolist(), strict=True):
        found.setdefault(g, set()).add(p)
    want = {}
    for i in range(len(data) - 8):
        want.setdefault(data[i:i + 9], set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def ordered(rows):
    return sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))


@pytest.mark.parametrize("piece,frequent", [(4 << 20, 0.01), (700, 0.01), (4 << 20, 0.0)])
def test_odd_rows(spark, odd, piece, frequent, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", piece)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 30_000)
    monkeypatch.setattr(sd, "SHARD_BYTES", 2_000)
    short = odd.filter("length(text) < 100000 or text is null")
    rows = ordered(short.collect())
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.clean(short).collect())
    assert got == sorted((str(r.doc_id), *x) for r, x in zip(rows, brute([r.text for r in rows]), strict=True))


def test_passages_with_other_contexts_and_frequent_anchors(spark, monkeypatch):
    monkeypatch.setattr(sd, "SHARD_BYTES", 3_000)
    passage = prose(3, 60)
    texts = [prose(i, 15) + passage[i % 7:] + prose(1000 + i, 12) for i in range(60)] + [passage, "ab" * 400, "ab" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = [(i, *x) for i, x in enumerate(brute(texts))]
    take = lambda: sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.clean(df).collect())
    assert take() == want  # 60 of 63 documents hold the passage: its anchors are frequent
    monkeypatch.setattr(sd, "FREQUENT", 10.0)  # none is: all go to the suffix shards
    assert take() == want


def test_whole_texts_and_carried_columns(odd, none):
    rows = sd.clean(odd, whole=True).collect()
    assert set(rows[0].asDict()) == {*odd.columns, "n_bytes", "n_removed", "n_spans", "kept_sha256"}
    assert all((r.text is None) or len(r.text.encode()) <= r.n_bytes - r.n_removed for r in rows)
    assert sum(r.text is None for r in rows) == odd.filter("text is null").count()
    assert sd.clean(none).collect() == []


def test_spans():
    o, s, e = sd.spans(np.array([1, 0, 0, 0, 1]), np.array([5, 0, 50, 8, 0]), np.array([9, 10, 60, 20, 5]))
    assert list(zip(o.tolist(), s.tolist(), e.tolist(), strict=True)) == [(0, 0, 20), (0, 50, 60), (1, 0, 9)]


def test_an_anchor_that_fills_a_shard_goes_by_strings():
    # 40 differing segments of 150 bytes below one anchor that no sample found, 2 below another, 1 alone
    anchor, size = np.array([7] * 40 + [8] * 2 + [9], "u8"), np.full(43, 150, "i8")
    meets, hot = sd.routes(anchor, size, np.zeros(0, "u8"), 3_000)
    assert meets.tolist() == [True] * 42 + [False] and hot.tolist() == [True] * 40 + [False] * 3
    meets, hot = sd.routes(anchor, size, np.array([9], "u8"), 1 << 19)
    assert meets.all() and hot.tolist() == [False] * 42 + [True]


@pytest.mark.parametrize("most,times", [(1 << 17, 1), (102, 50)])
def test_a_common_string_leaves_a_task_once(most, times):
    # 100 documents with one text of 150 bytes, in 10 batches; a task that holds 102 places sees 2 copies together
    data = prose(1, 60).encode()[:150]
    z = zstandard.ZstdCompressor().compress(data)
    part = [{"start": 0, "until": 150, "anchor": 5, "kind": 2}]
    batches = [pa.RecordBatch.from_pydict({"order": [10 * b + i for i in range(10)], "z": [z] * 10, "parts": [part] * 10}) for b in range(10)]
    sent, gone = [], []
    for made in sd._cut(100, 4, most)(iter(batches)):
        for r in made.to_pylist():
            o, s, n = (np.frombuffer(r[c], "i8").tolist() for c in ("order", "start", "size"))
            if r["kind"] == 2:
                sent += zip(o, s, strict=True)
            else:
                gone += zip(o, s, n, strict=True)
    firsts = range(0, 100, 100 // times)
    assert sorted(sent) == [(o, s) for o in firsts for s in range(51)]
    assert sorted(gone) == [(o, 0, 150) for o in range(100) if o not in firsts]


def test_ids_at_the_ends_of_the_range_and_repeated(spark):
    shared, top, low = prose(1, 40), 2**63 - 1, -(2**63)
    for rows in ([(top, "a " + shared), (top, "b " + shared), (low, shared)], [(2**62 + 1, "a " + shared), (2**62 + 1, "b " + shared), (None, shared), (low, shared)],
                 [(low, shared), (top, shared + " z"), (0, "q " + shared)]):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        got = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans, r.kept_sha256) for r in sd.clean(df).collect()}
        ranked = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert got == {(k, n): tuple(rest) for (k, _), (n, *rest) in zip(ranked, brute([t for _, t in ranked]), strict=True)}


def test_text_keys_are_ordered_too(spark):
    shared = prose(1, 40)
    got = {r.doc_id: r.n_removed for r in sd.clean(spark.createDataFrame([("b", shared), ("a", shared)], "doc_id string, text string")).collect()}
    assert got == {"a": 0, "b": len(shared)}
