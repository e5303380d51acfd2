import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import graph, simhash, simhash_queries
from tessera.operators import lookup
from tests.llm.conftest import SCHEMA, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_fingerprint(text):
    words = WORD.findall(lower(text))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    found = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def least_reachable(values):
    """{i: least connected i} of fingerprints by all pairs."""
    root = {i: i for i in values}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    items = sorted(values.items())
    for n, (i, a) in enumerate(items):
        for j, b in items[n + 1:]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i in values}


def test_hash_is_the_engines_own(spark):
    texts = ["a b c", "ß é x", "x", "one two three four"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert [h % (1 << 64) for h in got] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


def test_documents_equal_brute_force(spark, odd):
    rows = odd.collect()
    known = {}
    for r in rows:
        if r.doc_id is not None:
            known.setdefault(r.doc_id, []).append(brute_fingerprint(r.text))
    got = simhash_queries.components(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in got) == sorted(
        (r.doc_id is None, r.doc_id or 0, f"{brute_fingerprint(r.text):016x}") for r in rows)
    prints = {int(r.fingerprint, 16) for r in got}
    of = least_reachable(dict(enumerate(sorted(prints))))
    at = {f: i for i, f in enumerate(sorted(prints))}
    members = defaultdict(list)
    for r in rows:
        if r.doc_id is not None:
            members[of[at[brute_fingerprint(r.text)]]].append(r.doc_id)
    for r in got:
        assert r.component_id == min(members[of[at[int(r.fingerprint, 16)]]], default=None)


@pytest.mark.parametrize("kinds", [3, 9, 20])
def test_links_at_every_distance(spark, kinds):
    rng = random.Random(kinds)
    values = set()
    for _ in range(40):  # clusters and chains of a few changed bits, in one segment or across both
        f = rng.getrandbits(64)
        values.add(f)
        for _ in range(rng.randint(0, 12)):
            f = f ^ (1 << rng.randrange(64)) if rng.random() < 0.5 else f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            if rng.random() < 0.3:
                f ^= rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)
            values.add(f)
    values |= {0, 1, 1 << 63, 3 << 62, 7, (1 << 64) - 1} | {1 << 20 | 1 << 40 | 1 << b for b in range(kinds)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    rows = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = {r.ck: r.root for r in graph.components(simhash.links(rows)).collect()}
    want = least_reachable({i: v % (1 << 64) for i, v in enumerate(signed)})
    assert {v: got.get(v, v) for v in signed} == {v: signed[want[i]] for i, v in enumerate(signed)}


def test_a_crowd_of_near_copies_is_one_group(spark):
    base = prose(1, 900).split()
    rows = []
    for i in range(400):
        words = list(base)
        if i % 3:
            words[i % len(words)] = f"w{i}"
        rows.append((1000 - i, " ".join(words), None, None, None, None, None, None))
    got = simhash_queries.components(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    assert {r.doc_id: r.component_id for r in got} == least_reachable(prints)


def test_components_with_frequent_nodes(spark, monkeypatch):
    monkeypatch.setattr(lookup, "FEW_ROWS", 5)
    monkeypatch.setattr(lookup, "FREQUENT_KEYS", 8)
    rng = random.Random(3)
    edges = [(7, 100 + i) for i in range(60)] + [(500, 100 + i) for i in range(0, 60, 7)] + [(900 + i, 901 + i) for i in range(40)]
    edges += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)]
    got = {r.ck: r.root for r in graph.components(spark.createDataFrame(edges, "ck long, other long")).collect()}
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    assert got == {n: r for n, r in root.items() if n != r}


def test_empty_table(none):
    assert simhash_queries.components(none).collect() == []
