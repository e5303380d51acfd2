"""Histogram boosting, trials in one job, proposals, refit, and exact tree Shapley values."""
import hashlib
import itertools
import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import boosting as B
from tessera.operators import models as MD
from tessera.operators import tree_shapley as TS
from tessera.operators import tuning

PARAMS = dict(n_trees=20, max_depth=3, learning_rate=0.3, subsample=1.0, colsample=1.0, min_child=1, gamma=0.0, reg_alpha=0.0, reg_lambda=1.0)


def made(n=400, wide=5, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, wide)).round(2)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype("i8")
    edges = np.quantile(x, np.arange(1, 64) / 64, axis=0).T
    return x, y, edges


def frame(spark, x, y):
    return spark.createDataFrame([([float(v) for v in r], int(t)) for r, t in zip(x, y, strict=True)], "features array<double>, label int").repartition(3)


def brute_split(x, g, h, p):
    """Best (gain, feature, threshold) by trying every value of every feature."""
    best = (max(p["gamma"], 1e-12), None, None)
    moved = lambda s: math.copysign(max(abs(s) - p["reg_alpha"], 0), s)
    score = lambda s, t: moved(s) ** 2 / (t + p["reg_lambda"])
    for j in range(x.shape[1]):
        for cut in np.unique(x[:, j])[:-1]:
            low = x[:, j] <= cut
            if min(h[low].sum(), h[~low].sum()) < p["min_child"]:
                continue
            gain = score(g[low].sum(), h[low].sum()) + score(g[~low].sum(), h[~low].sum()) - score(g.sum(), h.sum())
            if gain > best[0] + 1e-12:
                best = (gain, j, cut)
    return best


@pytest.mark.parametrize("change", [{}, {"reg_alpha": 3.0}, {"min_child": 9, "reg_lambda": 20.0}, {"gamma": 4.0}])
def test_first_split_and_leaves_equal_brute_force(change):
    p = PARAMS | change | {"n_trees": 1, "max_depth": 1}
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (200, 4)).astype("f8")
    y = (x[:, 2] + rng.normal(size=200) > 6).astype("i8")
    edges = np.tile(np.concatenate((np.arange(12.0), np.full(51, 50.0))), (4, 1))
    forest = B.boost(B.codes(x, edges), y, edges, p)
    prior = np.full(200, y.mean())
    g, h = prior - y, prior * (1 - prior)
    gain, j, cut = brute_split(x, g, h, p)
    assert (forest.feature[0], edges[j][forest.cut[0]] if j is not None else None) == (j, cut)
    leaf = lambda m: -math.copysign(max(abs(g[m].sum()) - p["reg_alpha"], 0), g[m].sum()) / (h[m].sum() + p["reg_lambda"]) * 0.3
    low = x[:, j] <= cut
    assert forest.value[1:] == pytest.approx([leaf(low), leaf(~low)]) and forest.cover[1:] == pytest.approx([h[low].sum(), h[~low].sum()])


def test_constraints_hold_in_every_node():
    x, y, edges = made()
    forest = B.boost(B.codes(x, edges), y, edges, PARAMS | {"min_child": 5.0, "gamma": 0.5, "max_depth": 6, "colsample": 0.5, "subsample": 0.7})
    inner = forest.feature >= 0
    assert inner.any() and (forest.cover[forest.left[inner]] >= 5).all() and (forest.cover[forest.right[inner]] >= 5).all()
    assert np.allclose(forest.cover[forest.left[inner]] + forest.cover[forest.right[inner]], forest.cover[inner])
    huge = B.boost(B.codes(x, edges), y, edges, PARAMS | {"gamma": 1e9})
    assert (huge.feature < 0).all()


def test_learns_and_scores_through_spark(spark):
    x, y, _ = made()
    df = frame(spark, x, y)
    forest = B.fit_boosted(df, 5, PARAMS)
    got = forest.transform(df).select("label", "prediction", "score").collect()
    assert np.mean([r.label == r.prediction for r in got]) > 0.95
    again = B.fit_boosted(df.repartition(5), 5, PARAMS)
    assert (again.value == forest.value).all() and (again.cut == forest.cut).all()


def test_codes_and_edges(spark):
    edges = np.array([[1.0, 2.0, 2.0, 3.0]])
    assert B.codes(np.array([[0.5], [1.0], [1.5], [2.0], [2.5], [9.0], [np.nan]]), edges).ravel().tolist() == [0, 0, 1, 1, 3, 4, 0]
    df = spark.createDataFrame([([float(i), float("nan") if i % 2 else 1.0],) for i in range(1000)], "features array<double>")
    found = B.bin_edges(df, 2, bins=4)
    assert found[0] == pytest.approx([249, 499, 749], abs=2) and found[1].tolist() == [1.0] * 3


def test_odd_tables_give_trees_without_splits(spark):
    empty = spark.createDataFrame([], "features array<double>, label int")
    one = spark.createDataFrame([([1.0, 2.0], 1)] * 9, "features array<double>, label int")
    for df in (empty, one):
        forest = B.fit_boosted(df, 2, PARAMS)
        assert (forest.feature < 0).all()
        assert all(0 <= r.score <= 1 for r in forest.transform(one).collect())


def test_all_trials_in_one_job_equal_single_fits(spark):
    x, y, edges = made(300)
    df = frame(spark, x, y)
    trials = tuning.search_space(spark, 6).withColumn("n_trees", F.lit(5))
    rows = B.fit_trials(trials, df, df, 5, edges=edges).collect()
    cx, cy = B.coded_sample(df, edges, "label", "features")
    for t in trials.collect():
        want = B.probability(B.boost(cx, cy, edges, t.asDict(), B.SEED + t.trial).margin(cx))
        assert sorted(r.score for r in rows if r.trial == t.trial) == pytest.approx(sorted(want))


def test_tuning_ranks_proposes_and_refits(spark, monkeypatch):
    monkeypatch.setattr(tuning, "TREES_CHOICES", [5, 10])
    x, y, _ = made(500)
    df = frame(spark, x, y)
    trials = tuning.tune_gbt(df, df, 5, n_trials=9, batch=4)
    rows = sorted(trials.collect(), key=lambda r: r.trial)
    assert [r.trial for r in rows] == list(range(9)) and set(tuning.PARAMS) | set(tuning.TRIAL_METRICS) <= set(trials.columns)
    assert all(r.loss == pytest.approx(1 - r.auc) for r in rows)
    first = tuning.search_space(spark, 4).drop("uniforms").collect()
    assert [tuple(r[p] for p in tuning.PARAMS) for r in rows[:4]] == [tuple(r[p] for p in tuning.PARAMS) for r in first]
    best = tuning.refit_best(df, trials, 5)
    least = min(rows, key=lambda r: (r.loss, r.trial))
    assert best.params == {p: float(least[p]) for p in tuning.PARAMS}


def test_search_space_equals_its_hashes(spark):
    def u(trial, tag):
        return int(hashlib.md5(f"42|{tag}|{trial}".encode()).hexdigest()[:8], 16) / 2 ** 32

    logs = lambda v, low, high: math.exp(math.log(low) + v * (math.log(high) - math.log(low)))
    half_up = lambda v: math.floor(v + 0.5)
    for r in tuning.search_space(spark, 50).collect():
        t = r.trial
        assert r.n_trees == [100, 150, 200, 300, 400, 500][int(u(t, "trees") * 6)]
        assert (r.max_depth, r.min_child) == (half_up(3 + u(t, "depth") * 9), half_up(1 + u(t, "child") * 19))
        want = [logs(u(t, "rate"), 0.005, 0.3), 0.5 + u(t, "subsample") / 2, 0.5 + u(t, "colsample") / 2, 5 * u(t, "gamma"),
                logs(u(t, "alpha"), 1e-8, 10), logs(u(t, "lambda"), 1e-8, 10)]
        assert [r.learning_rate, r.subsample, r.colsample, r.gamma, r.reg_alpha, r.reg_lambda] == pytest.approx(want)


def test_proposals_beat_uniform_draws_on_a_fixed_function():
    centre = np.array([0.2, 0.7, 0.5, 0.9, 0.3, 0.6])
    loss = lambda p: ((p - centre) ** 2).sum(axis=1)
    better = 0
    for seed in range(20):
        uniform = np.random.default_rng(seed).random((50, 6))
        points = uniform[:10]
        while len(points) < 50:
            points = np.vstack([points, tuning.propose(points, loss(points), 5, 1_000 * seed + len(points))])  # a seed a batch, as in the search
        assert points.min() >= 0 and points.max() <= 1
        better += loss(points).min() < loss(uniform).min()
    assert better >= 16


def enumerated(trees, row):
    """Shapley values by all subsets, from the expected prediction with a subset known."""
    def value(node, known):
        f = int(trees.feature[node])
        if f < 0:
            return trees.value[node]
        left, right = int(trees.left[node]), int(trees.right[node])
        if f in known:
            return value(left if row[f] <= trees.threshold[node] else right, known)
        return (trees.cover[left] * value(left, known) + trees.cover[right] * value(right, known)) / trees.cover[node]

    d = trees.width
    total = {s: sum(value(int(r), s) for r in trees.roots) for k in range(d + 1) for s in map(frozenset, itertools.combinations(range(d), k))}
    out = []
    for j in range(d):
        rest = [s for s in total if j not in s]
        out.append(sum(math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d) * (total[s | {j}] - total[s]) for s in rest))
    return out, total[frozenset()]


def test_tree_shapley_equals_all_subsets():
    x, y, edges = made(300, 8, 5)
    forest = B.boost(B.codes(x, edges), y, edges, PARAMS | {"n_trees": 6, "max_depth": 7})
    trees = TS.of_forest(forest)
    rows = B.codes(x[:12], edges).astype("f8")
    got = TS.shapley(trees, rows)
    for r, phi in zip(rows, got, strict=True):
        want, base = enumerated(trees, r)
        assert phi == pytest.approx(want, abs=1e-10) and TS.expected(trees) == pytest.approx(base + trees.base)
    assert got.sum(axis=1) + TS.expected(trees) == pytest.approx(forest.margin(B.codes(x[:12], edges)))


def test_shapley_of_a_spark_tree_adds_up(spark):
    x, y, _ = made(400)
    df = frame(spark, x, y).withColumn("id", F.monotonically_increasing_id()).withColumnRenamed("features", "raw").cache()
    vectors = MD.features_vector(df, "raw")
    fit = MD.fit_tree(vectors)
    phi = TS.shapley_trees(TS.of_spark_tree(fit.model, 5), df, "id", "raw")
    total = {r.id: r.p for r in phi.groupBy("id").agg((F.sum("phi") + F.first("base")).alias("p")).collect()}
    for r in fit.transform(vectors).select("id", "score").collect():
        assert total[r.id] == pytest.approx(r.score, abs=1e-9)
    assert phi.count() == 400 * 5
    df.unpersist()


def test_a_level_holds_one_feature_at_a_time():
    """Tables of rows x features x 8 bytes left the cache, so a trial's time grew faster than its rows."""
    rng = np.random.default_rng(3)
    coded = rng.integers(0, 64, (20_000, 64)).astype("u1")
    label = (coded[:, 0] > rng.integers(0, 64, 20_000)).astype("i8")
    edges = np.tile(np.arange(63.0), (64, 1))
    tracemalloc.start()
    forest = B.boost(coded, label, edges, PARAMS | {"n_trees": 1, "max_depth": 7})
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(forest.feature) > 50 and most < 6 * coded.nbytes


def many(spark, n=120_000):
    """(table of n rows, number of those with label 1): more rows than the 100,000 that trials and refits once sampled."""
    df = spark.range(n, numPartitions=6).select(F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double")).alias("features"),
                                                (F.col("id") % 10_000 < 2_501).cast("int").alias("label"))
    return df, sum(i % 10_000 < 2_501 for i in range(n))


def test_trials_learn_from_all_rows_and_score_all(spark):
    """Trees without splits leave the score at the share of label 1, which a sample misses."""
    df, ones = many(spark)
    trials = tuning.search_space(spark, 2).withColumns({"n_trees": F.lit(1), "gamma": F.lit(1e9), "subsample": F.lit(1.0)})
    rows = B.fit_trials(trials, df, df, 2)
    got = rows.groupBy("trial").agg(F.count("*").alias("n"), F.sum("label").alias("ones"), F.min("score").alias("low"), F.max("score").alias("high"))
    for r in got.collect():
        assert (r.n, r.ones) == (120_000, ones) and [r.low, r.high] == pytest.approx([ones / 120_000] * 2, abs=1e-9)


def test_every_trial_has_a_task(spark):
    """A union of single partitions is one partition by default: one task fitted all trials."""
    x, y, edges = made(200)
    df = frame(spark, x, y)
    trials = tuning.search_space(spark, 4).withColumn("n_trees", F.lit(2))
    held = spark.conf.get(B.UNION)
    rows = B.fit_trials(trials, df, df, 5, edges=edges)
    found = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count_distinct("trial").alias("trials")).collect()
    assert [r.trials for r in found] == [1] * 4 and spark.conf.get(B.UNION) == held


def test_a_pass_by_chunks_grows_the_same_trees(monkeypatch):
    x, y, edges = made(3_000)
    p = PARAMS | {"n_trees": 4, "subsample": 0.7, "colsample": 0.6, "min_child": 20, "gamma": 2.0}
    whole = B.boost(B.codes(x, edges), y, edges, p)
    monkeypatch.setattr(B, "CHUNK", 500)
    monkeypatch.setattr(B, "HELD_BYTES", 0)  # rows in files
    monkeypatch.setattr(B, "TABLE_BYTES", 40_000)  # a few features a pass
    parts = B.boost(B.codes(x, edges), y, edges, p)
    assert len(whole.feature) > 12 and (whole.feature == parts.feature).all() and (whole.cut == parts.cut).all()
    assert parts.value == pytest.approx(whole.value) and parts.cover == pytest.approx(whole.cover)


def test_refit_learns_from_all_rows(spark):
    df, ones = many(spark)
    trials = tuning.search_space(spark, 1).withColumns({"n_trees": F.lit(1), "max_depth": F.lit(2), "subsample": F.lit(1.0), "loss": F.lit(0.5)})
    forest = tuning.refit_best(df, trials, 2)
    share = ones / 120_000
    assert forest.base == pytest.approx(math.log(share / (1 - share)), abs=1e-12) and forest.cover[0] == pytest.approx(120_000 * share * (1 - share))


def test_packed_rows_come_back_whole(spark, monkeypatch):
    """Equal rows travel once, with their number; a row without a label is left out."""
    rng = np.random.default_rng(4)
    x = np.concatenate((np.full((900, 3), 0.5), rng.normal(size=(300, 3)).round(1)))
    y = rng.integers(0, 2, 1_200)
    edges = np.tile(np.linspace(-2, 2, 63), (3, 1))
    df = frame(spark, x, y).unionAll(spark.createDataFrame([([0.5] * 3, None)], "features array<double>, label int"))
    monkeypatch.setattr(B, "CHUNK", 70)
    monkeypatch.setattr(B, "BLOCK_BYTES", 12)
    got, label = B.coded_sample(df, edges, "label", "features")
    want = sorted((bytes(c), int(t)) for c, t in zip(B.codes(x, edges), y, strict=True))
    assert [(bytes(c), int(t)) for c, t in zip(got, label, strict=True)] == want
    held = B.coded_rows(df, edges, "label", "features")
    assert held.rows == 1_200 and held.blocks.agg(F.sum(F.length("c"))).first()[0] < 3 * 400
