import itertools
import random

import pytest

from tessera.llm import ngram_join as nj
from tests.llm.conftest import prose


def gram_set(text):
    words = (text or "").encode().split()
    return {tuple(words[i:i + nj.N]) for i in range(max(1, len(words) - nj.N + 1))} if words else set()


def brute(rows):
    """doc -> (class, links, group) by all pairs."""
    texts = {}
    for key, text in rows:
        if gram_set(text):
            texts.setdefault(text, []).append(key)
    least = lambda keys: min((k for k in keys if k is not None), default=None)
    names, sets = list(texts), {t: gram_set(t) for t in texts}
    links = [(a, b) for a, b in itertools.combinations(names, 2) if len(sets[a] & sets[b]) >= nj.THRESHOLD * len(sets[a] | sets[b]) - 1e-9]
    group = {t: {t} for t in names}
    for a, b in links:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for t in group[b]:
                group[t] = group[a]
    out = []
    for key, text in rows:
        if text in texts:
            out.append((key, least(texts[text]), sum(text in p for p in links), least([k for t in group[text] for k in texts[t]])))
        else:
            out.append((key, key, 0, key))
    return out


def got(df, **more):
    return sorted(map(str, ((r.key, r.class_id, r.n_links, r.group_id) for r in nj.grouped(df, **more).collect())))


def test_bands_reach_the_recall():
    bands, rows = nj.choose_bands()
    assert bands * rows <= nj.MAX_HASHES and 1 - (1 - 0.8 ** rows) ** bands >= nj.RECALL


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("tile", [4, 512])
def test_groups_of_near_copies(spark, tile, monkeypatch):
    monkeypatch.setattr(nj, "TILE", tile)
    rng, rows = random.Random(1), []
    for g in range(4):
        base = prose(100 + g, 150).split()
        for i in range(18):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, prose(500 + i, 60)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df) == sorted(map(str, brute(rows)))
    if tile == 4:
        sets = {k: gram_set(t) for k, t in rows}
        least = {k: c for k, c, _, _ in brute(rows)}
        want = {(a, b) for a, b in itertools.combinations(sorted({least[k] for k, _ in rows}), 2)
                if sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9}
        assert {(r.a, r.b) for r in nj.links(df).collect()} == want


def test_one_of_each(odd, none):
    left = nj.one_of_each(odd).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    # two groups may have the same least key, as one key has two texts
    want = {(str(k), t) for (k, t), (_, _, _, g) in zip(rows, brute(rows), strict=True) if gram_set(t) and k == g}
    assert sorted((str(r.doc_id), r.text) for r in left if gram_set(r.text)) == sorted(want)
    assert sum(not gram_set(r.text) for r in left) == sum(not gram_set(r.text) for r in odd.collect())
    assert set(left[0].asDict()) == set(odd.columns)
    assert nj.one_of_each(none).collect() == [] and nj.grouped(none).collect() == []


def test_components_of_a_long_chain(spark):
    key = lambda i: i.to_bytes(4, "big")
    edges = spark.createDataFrame([(bytearray(key(i)), bytearray(key(i + 1))) for i in range(1, 40)] + [(bytearray(key(90)), bytearray(key(91)))], "ck binary, other binary")
    found = {bytes(r.ck): bytes(r.root) for r in nj.components(edges).collect()}
    assert found == {**{key(i): key(1) for i in range(2, 41)}, key(91): key(90)}
