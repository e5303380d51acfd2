import numpy as np

from tessera.llm import mixing


def test_targets_stop_and_reshare():
    assert mixing.targets([10, 1000, 10], [1, 2, 3], 1020) == [30.0, 960.0, 30.0]
    assert mixing.targets([0, 0], [1, 2], 0.0) == [0.0, 0.0]


def test_tree_parts_quotas_exactly():
    quotas = np.array([5, 0, 17, 2, 40], "i8")
    walks = [mixing.split_quotas(quotas, 7, s) for s in range(7)]
    assert (sum(h for _, h in walks) == quotas).all()
    for before, (b, h) in zip(np.cumsum([h for _, h in walks], axis=0)[:-1], walks[1:], strict=True):
        assert (before == b).all()
    sizes = [int(h.sum()) for _, h in walks]
    assert max(sizes) - min(sizes) <= 3


def test_permutation():
    for n in (1, 2, 7, 100, 1025):
        assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))


def test_odd_rows(odd):
    rows = mixing.plan(odd, [1, 2, 3], block_words=50).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert r.taken == r["size"] * len(r.draws) and len(r.draws) <= 3
        assert len({d["pass"] for d in r.draws}) == len(r.draws)
    assert abs(sum(b[0].target for b in by.values()) - sum(r["size"] for r in rows)) < 1e-6
    for members in by.values():
        largest = max(r["size"] for r in members)
        assert abs(sum(r.taken for r in members) - members[0].target) <= largest / 2 + 1
        assert members[0].source_size == sum(r["size"] for r in members)


def test_mix_takes_what_the_plan_says(odd):
    mixed = mixing.mix(odd, [1, 2, 3], block_words=50).collect()
    planned = mixing.plan(odd, [1, 2, 3], block_words=50).collect()
    assert len(mixed) == sum(len(r.draws) for r in planned)
    assert set(mixed[0].asDict()) == {*odd.columns, "shard"}
    for source in {r.source for r in planned}:
        words = sum(len((r.text or "").encode().split()) for r in mixed if r.source == source)
        assert words == sum(r.taken for r in planned if r.source == source)


def test_reruns_agree(odd):
    draw = lambda n: sorted(map(str, mixing.plan(odd.repartition(n), [1, 2, 3], block_words=50).collect()))
    assert draw(2) == draw(5)


def test_empty_table(none):
    assert mixing.plan(none, [1, 2, 3]).collect() == [] and mixing.mix(none, [1, 2, 3]).collect() == []
