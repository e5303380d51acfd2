"""The metric tree: exact neighbours at several levels, bounds that prune, equal vectors."""
import numpy as np
import pytest

from tessera.operators import metric_tree as MT
from tessera.operators import neighbours as NB


def frame(spark, x, name, by=None):
    rows = [(i, [float(v) for v in r], (by[i] if by is not None else "a")) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, f"{name} long, vec array<double>, kind string").repartition(3)


def brute(q, r, k, qby=None, rby=None, own=False):
    out = set()
    for i, a in enumerate(q):
        d = []
        for j, b in enumerate(r):
            if (qby is None or qby[i] == rby[j]) and not (own and i == j):
                d.append((round(float(sum((a[t] - b[t]) ** 2 for t in range(len(a)))), 9), j))
        out |= {(i, j, n + 1) for n, (_, j) in enumerate(sorted(d)[:k])}
    return out


def clustered(n, wide, seed, centres=9):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(centres, wide)) * 20)[rng.integers(0, centres, n)] + rng.normal(size=(n, wide))


@pytest.mark.parametrize("fanout,cell", [(2, 5), (4, 8), (64, 40)])
def test_neighbours_are_exact_at_every_depth(spark, monkeypatch, fanout, cell):
    monkeypatch.setattr(MT, "FANOUT", fanout)
    real = MT.build
    monkeypatch.setattr(MT, "build", lambda ref, rid, vec, group, size=None: real(ref, rid, vec, group, cell, fanout))
    monkeypatch.setattr(NB, "QUERY_BLOCK", 16)
    monkeypatch.setattr(NB, "REF_BLOCK", 6)
    r, q = clustered(220, 3, 1), clustered(60, 3, 1)
    r[50:90] = r[50]  # many equal vectors, and ties between them
    q[:3] = r[50]
    got = {(x.qid, x.rid, x.rank) for x in NB.nearest(frame(spark, q, "qid"), frame(spark, r, "rid"), 4).collect()}
    assert got == brute(q, r, 4)


def test_groups_and_self(spark, monkeypatch):
    real = MT.build
    monkeypatch.setattr(MT, "build", lambda ref, rid, vec, group, size=None: real(ref, rid, vec, group, 10, 3))
    x = clustered(150, 2, 2)
    by = ["a" if i % 3 else ("b" if i % 2 else "only") for i in range(150)]
    df = frame(spark, x, "id", by)
    q, r = df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "rid")
    got = {(t.qid, t.rid, t.rank) for t in NB.nearest(q, r, 3, by=["kind"], exclude_self=True).collect()}
    assert got == brute(x, x, 3, by, by, own=True)
    lonely = NB.nearest(q, r.where("kind = 'a'"), 2, by=["kind"])
    assert {t.kind for t in lonely.collect()} == {"a"}


def test_radii_hold_and_the_tree_prunes(spark):
    x = clustered(600, 2, 3, centres=30)
    df = frame(spark, x, "rid")
    tree = MT.build(df, "rid", "vec", "kind", cell=12, fanout=4)
    leaf, away = MT.leaves(tree, np.array(["a"] * 600), x)
    depth = 0
    below = {n: set(range(600)) for n in tree.roots.values()}
    todo = [(n, 0) for n in tree.roots.values()]
    rows_of = {n: np.flatnonzero(leaf == n) for n in set(leaf.tolist())}

    def rows(n):
        return rows_of.get(n, np.zeros(0, "i8")) if not tree.children[n] else np.concatenate([rows(c) for c in tree.children[n]])

    while todo:
        n, d = todo.pop()
        depth = max(depth, d)
        mine = rows(n)
        assert len(mine) == tree.count[n]
        if tree.pivots[n] is not None:
            assert MT.distances(x[mine], np.array([tree.pivots[n]])).max() <= tree.radius[n] + 1e-12
        todo += [(c, d + 1) for c in tree.children[n]]
    assert depth >= 2 and len(below) == 1
    needed = [len(MT.candidates(tree, "a", x[i:i + 1], 3)) for i in range(0, 600, 10)]
    assert np.mean(needed) < 0.2 * len(rows_of)


def test_equal_vectors_and_empty_tables_end(spark):
    same = frame(spark, np.ones((90, 2)), "rid")
    tree = MT.build(same, "rid", "vec", "kind", cell=10, fanout=4)
    assert sum(tree.count[c] for c in tree.children[tree.roots["a"]]) == 90
    empty = same.where("rid < 0")
    assert NB.nearest(same.withColumnRenamed("rid", "qid"), empty, 2).collect() == []
    assert NB.nearest(empty.withColumnRenamed("rid", "qid"), same, 2).collect() == []


def test_the_tree_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(MT, "TREE_BYTES", 20_000)
    monkeypatch.setattr(MT, "CELL", 1)
    tree = MT.build(frame(spark, clustered(500, 4, 5), "rid"), "rid", "vec", "kind", fanout=8)
    assert len(tree.pivots) * (8 * 4 + 64) < 20_000


def slow_best(q, r, q_ids, r_ids, k, own=False):
    out = set()
    for i, a in enumerate(q):
        with np.errstate(over="ignore", invalid="ignore"):
            d = [(float(np.round(sum((a[t] - b[t]) ** 2 for t in range(len(a))), 9)), r_ids[j], j) for j, b in enumerate(r)
                 if not own or q_ids[i] != r_ids[j]]
        out |= {(i, j, x) for x, _, j in sorted(t for t in d if np.isfinite(t[0]))[:k]}
    return out


@pytest.mark.parametrize("own", [False, True])
def test_k_best_equals_every_pair(monkeypatch, own):
    monkeypatch.setattr(NB, "AT_ONCE", 2_000)
    rng = np.random.default_rng(4)
    r, q = rng.integers(0, 3, (700, 4)).astype("f8"), rng.integers(0, 3, (40, 4)).astype("f8")  # many ties
    r[::7] += 1e-6 * rng.normal(size=(100, 4))
    r[5, 2], q[3, 1], r[6, 0], q[4] = np.nan, np.nan, np.inf, 1e9
    q_ids, r_ids = np.arange(40), rng.permutation(700)
    r_ids[:9] = 2  # one id on several rows
    for refs in (r, r[:3], r[:0], np.where(r == 2, 1e200, r)):
        got = NB.k_best(q, refs, q_ids, r_ids[:len(refs)], 5, own)
        want = slow_best(q, refs, q_ids, r_ids, 5, own)
        ids = lambda found: sorted((i, r_ids[j], x) for i, j, x in found)
        assert ids(zip(*(c.tolist() for c in got), strict=True)) == ids(want)


def test_blocks_grow_with_rows_not_with_leaves():
    order = [("a", i) for i in range(4_000)] + [("b", i) for i in range(4_000, 4_003)]
    at = MT.packed(order, {i: 20 for i in range(4_000)} | {4_000: 900, 4_001: 5}, 400)
    assert len({b for b, _ in at.values()}) == 202  # 200 of a, the first of three for the full leaf of b, one more
    assert at[4_000] == (200, 3) and at[4_001] == (203, 1) and 4_002 not in at
    assert NB.block_rows(82_000, 4_096) < 6_000 and NB.block_rows(10 ** 9, 4_096) == NB.LARGEST * 4_096
