import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from tessera.llm import periodic, periodic_queries
from tests.llm.conftest import SCHEMA, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every stretch that no neighbour extends, at every lag, with the smallest period tested directly."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= max(24, 3 * q) and not any(all(words[x] == words[x + p] for x in range(start, end - p)) for p in range(1, q)):
                out.append((start, end - start, q))
            i = j
    return sorted(out)


def brute(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def rank(rows):
    return sorted(rows, key=str)


def test_runs_equal_brute_force_on_random_words():
    rng = random.Random(5)
    for case in range(400):
        kinds = rng.choice([1, 2, 3, 6])
        words = [bytes([97 + rng.randrange(kinds)]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            block = [bytes([97 + rng.randrange(kinds)]) for _ in range(rng.randint(1, 14))]
            length = rng.randint(20, 70)
            at = rng.randint(0, len(words))
            words[at:at] = (block * (length // len(block) + 1))[:length]
            if rng.random() < 0.4:
                words[rng.randrange(len(words))] = b"odd"
        assert periodic.runs(words) == brute_runs(words), (case, words)


def test_overlapping_and_nested_runs():
    # a run within each period of a greater one, runs that share words, a run broken once
    a, b = [b"x"] * 24, [b"%d" % i for i in range(6)]
    for words in ((a + b) * 3, b * 5 + [b"0"] + b * 5, a + b * 4 + a[:8] * 3, b * 4 + [b"5", b"4"] * 12, (b * 4 + [b"y"]) * 4):
        assert periodic.runs(words) == brute_runs(words) != []


def test_splitting_keeps_every_run_and_is_stable():
    rng = np.random.default_rng(1)
    for _ in range(50):
        ids = rng.integers(0, 400, 300)
        block = rng.integers(400, 500, 9)
        ids[100:140] = np.tile(block, 5)[:40]
        left = periodic.surviving(ids)
        assert any(s <= 100 and e >= 140 for s, e in left)
        for s, e in left:
            assert e - s >= 24 and np.unique(ids[s:e], return_counts=True)[1].min() >= 3


def test_digests_equal_brute_force(spark, odd):
    got = [tuple(r) for r in periodic_queries.digests(periodic_queries.planted(odd)).collect()]
    small = [r for r in odd.collect() if len(r.text or "") < 60_000]
    want = [brute(r.doc_id, r.text) for r in small]
    big = [r.doc_id for r in odd.collect() if len(r.text or "") >= 60_000]
    assert rank(r for r in got if r[0] not in big) == rank(want) and len(got) == odd.count()


def test_planted_documents(spark):
    ids = [i for i in range(200_000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rows = [(i, prose(i, 20 + 9 * k), "en", "a", 1, 1, "x", "y") for k, i in enumerate(ids)]
    got = [tuple(r) for r in periodic_queries.digests(periodic_queries.planted(spark.createDataFrame(rows, SCHEMA))).collect()]
    want = [brute(r[0], r[1]) for r in rows]
    assert rank(got) == rank(want) and sum(w[1] > 0 for w in want) > 20


def test_long_periodic_text(spark):
    rng = random.Random(2)
    block = [f"w{rng.randrange(5000)}" for _ in range(70_000)]
    text = "head " + " ".join(block * 4) + " tail"
    row = periodic.collapse(spark.createDataFrame([(1, text, "mine")], "doc_id long, text string, runs string")).first()
    assert row.asDict(True) == {"doc_id": 1, "n_words": 280_002, "runs": [{"start": 1, "length": 280_000, "period": 70_000}],
                                "strongest": {"start": 1, "length": 280_000, "period": 70_000}, "collapsed": "head " + " ".join(block) + " tail"}


def test_one_word_many_times(spark):
    row = periodic.collapse(spark.createDataFrame([(1, "ab " * 500_000)], "doc_id long, text string")).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (500_000, [(0, 500_000, 1)], "ab")


def test_empty_table(none):
    assert periodic_queries.digests(periodic_queries.planted(none)).collect() == []
