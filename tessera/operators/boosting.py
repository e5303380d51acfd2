"""Second-order histogram boosting of many trials at once.

``bin_edges`` finds the bins once, by one aggregate over all rows; ``codes`` turns rows into one byte a
feature where they are.  A trial (a row of parameters) boosts on the codes of all rows:

* a level's gradient and hessian sums are one histogram keyed by (node, feature, bin);
* a split needs a hessian sum of ``min_child`` on both sides and a gain above ``gamma``, where a side's score is
  T(G)**2 / (H + ``reg_lambda``) and T moves G towards zero by ``reg_alpha``; the best (feature, bin) of a node
  wins, the first of equal ones;
* each tree draws its rows (``subsample``) and its features (``colsample``) from a generator seeded by (seed, trial).

``fit_trials`` runs all trials of a table in one Spark job, a task for each trial.  ``coded_rows`` writes the
codes of all training and validation rows once, packed, into the shared checkpoint folder; every task reads
them all from there (no shuffle, nothing through the driver) and returns the scores of the validation rows, so
that the metrics of all trials are grouped aggregates.  A lost executor repeats its own trials only.

A task keeps codes and row states (17 bytes a row) in memory up to HELD_BYTES an array, beyond that in unnamed
files of its scratch folder, and passes over them CHUNK rows at a time: its memory does not grow with the rows,
its time does.  More tasks than trials do not shorten the job.

Defined results: a value equal to an edge goes left; null and NaN values count as below every edge; a
table of one class, or without rows, gives trees without splits; rows without a label are neither learnt from nor scored.
"""

from __future__ import annotations

import tempfile
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

BINS = 64
BLOCK_BYTES = 4_096  # codes of a packed block (Arrow hands over 10,000 blocks at once)
CHUNK = 1 << 18  # rows of a pass
HELD_BYTES = 64 << 20  # an array of a task's rows up to this stays in memory
TABLE_BYTES = 64 << 20  # histograms of a pass, if it takes several chunks
SCORE_ROWS = 1 << 14
UNION = "spark.sql.unionOutputPartitioning"
ACCURACY = 2_000
SEED = 42


@dataclass
class Forest:
    """Trees as node tables: a row goes to ``left`` if its code of ``feature`` is at most ``cut``; leaves have feature -1."""

    edges: np.ndarray  # features x (BINS - 1), rising
    base: float
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray  # hessian sums of the training rows
    roots: np.ndarray
    params: dict = field(default_factory=dict)

    def margin(self, coded: np.ndarray) -> np.ndarray:
        out = np.full(len(coded), self.base)
        for root in self.roots.tolist():
            out += self.value[_walk(self, root, coded)]
        return out

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``score`` (the probability of label 1) and ``prediction``."""
        def scored(v: pd.Series) -> pd.Series:
            return pd.Series(probability(self.margin(codes(matrix(v, len(self.edges)), self.edges))))

        score = F.pandas_udf(scored, "double")
        return df.withColumn("score", score(as_array(df, features))).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def as_array(df: DataFrame, features: str):
    kind = df.schema[features].dataType.simpleString()
    return vector_to_array(features) if kind == "vector" else F.col(features).cast("array<double>")


def matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.stack([np.asarray(v, "f8") for v in column]) if len(column) else np.zeros((0, width))


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margin))


def _walk(forest: Forest, root: int, coded: np.ndarray) -> np.ndarray:
    at = np.full(len(coded), root)
    moving = np.arange(len(coded))
    while len(moving):
        moving = moving[forest.feature[at[moving]] >= 0]
        here = at[moving]
        low = coded[moving, forest.feature[here]] <= forest.cut[here]
        at[moving] = np.where(low, forest.left[here], forest.right[here])
    return at


def bin_edges(df: DataFrame, width: int, features: str = "features", bins: int = BINS) -> np.ndarray:
    """features x (bins - 1): quantiles of every feature, by one aggregate over all rows."""
    shares = [i / bins for i in range(1, bins)]
    values = df.select(as_array(df, features).alias("v"))
    row = values.agg(*[F.percentile_approx(F.nanvl(F.get("v", F.lit(j)), F.lit(None).cast("double")), shares, ACCURACY).alias(f"q{j}")
                       for j in range(width)]).first()
    return np.array([row[f"q{j}"] or [0.0] * (bins - 1) for j in range(width)], "f8")


def codes(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One byte a feature: the number of edges below the value (0 for NaN)."""
    out = np.zeros(values.shape, "u1")
    for j, edge in enumerate(edges):
        column = values[:, j]
        out[:, j] = np.where(np.isnan(column), 0, np.searchsorted(edge, column, side="left"))
    return out


@dataclass
class Coded:
    """The codes of all rows of a table, packed; the order of the rows is that of their content, so that reruns agree."""

    blocks: DataFrame  # part, start (in its part), rows, and of each distinct row codes, label and number
    starts: dict[int, int]  # first row of each part
    rows: int


def coded_rows(df: DataFrame, edges: np.ndarray, label: str, features: str) -> Coded:
    """``df`` coded in the tasks, equal rows counted, ordered and written to the shared checkpoint folder."""
    given = df.select(as_array(df, features).alias("v"), F.col(label).cast("int").alias("y")).where("y is not null")
    size = max(1, BLOCK_BYTES // max(1, len(edges)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = codes(matrix(batch["v"], len(edges)), edges)
            yield pd.DataFrame({"c": [bytes(r) for r in made], "y": batch["y"]})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            cuts = range(0, len(batch), size)
            c, y, n = batch["c"].tolist(), batch["y"].to_numpy("i4"), batch["n"].to_numpy("i8")
            rows = np.array([n[k:k + size].sum() for k in cuts], "i8")
            yield pd.DataFrame({"part": part, "start": start + rows.cumsum() - rows, "rows": rows,
                                "c": [b"".join(map(bytes, c[k:k + size])) for k in cuts],
                                "y": [y[k:k + size].tobytes() for k in cuts], "n": [n[k:k + size].tobytes() for k in cuts]})
            start += int(rows.sum())

    each = given.mapInPandas(run, "c binary, y int").groupBy("c", "y").agg(F.count(F.lit(1)).alias("n")).orderBy("c", "y")
    blocks = cut_lineage(each.mapInPandas(pack, "part int, start long, rows long, c binary, y binary, n binary"))
    starts, rows = {}, 0
    for r in blocks.groupBy("part").agg(F.sum("rows").alias("rows")).orderBy("part").collect():  # a row a partition
        starts[r["part"]], rows = rows, rows + r["rows"]
    return Coded(blocks, starts, rows)


def coded_sample(df: DataFrame, edges: np.ndarray, label: str, features: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, labels) of all rows, as every task sees them; for small tables (they are gathered here)."""
    held = coded_rows(df, edges, label, features)
    (made, y), = _received([held.blocks.withColumn("of", F.lit(0)).toPandas()], len(edges), [(held.starts, held.rows)])
    return np.ascontiguousarray(made.T), y.astype("i8")


def room(shape: tuple[int, ...], kind: str) -> np.ndarray:
    """An array in memory or, if large, in an unnamed file of the scratch folder."""
    if int(np.prod(shape)) * np.dtype(kind).itemsize <= HELD_BYTES:
        return np.zeros(shape, kind)
    with tempfile.TemporaryFile() as file:  # the map keeps it
        return np.asarray(np.memmap(file, kind, "w+", shape=shape))


def _received(batches: Iterator[pd.DataFrame], wide: int, sizes: list[tuple[dict[int, int], int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(codes, a line a feature; labels) of each table, from its blocks in any order."""
    out = [(room((wide, rows), "u1"), room((rows,), "i4")) for _, rows in sizes]
    for batch in batches:
        for of, part, start, rows, c, y, n in batch[["of", "part", "start", "rows", "c", "y", "n"]].itertuples(index=False, name=None):
            lines, label = out[of]
            start += sizes[of][0][part]
            block, y, ends = np.frombuffer(c, "u1").reshape(-1, wide), np.frombuffer(y, "i4"), np.frombuffer(n, "i8").cumsum()
            for low in range(0, rows, CHUNK):
                high = min(low + CHUNK, rows)
                row = np.searchsorted(ends, np.arange(low, high), side="right")
                lines[:, start + low:start + high] = block[row].T
                label[start + low:start + high] = y[row]
    return out


def _task_each(tables: list[Coded], wide: int, jobs: list[dict], work: Callable[..., Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``work(job, *tables)`` of every job, in a task of its own that reads all blocks; the first jobs start first."""
    blocks, sizes = None, [(t.starts, t.rows) for t in tables]
    for i, t in enumerate(tables):
        own = t.blocks.withColumn("of", F.lit(i))
        blocks = own if blocks is None else blocks.unionAll(own)

    def of(job: dict) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from work(job, *_received(batches, wide, sizes))

        return blocks.coalesce(1).mapInPandas(run, schema)

    out = None
    for job in jobs:
        out = of(job) if out is None else out.unionAll(of(job))
    return blocks.sparkSession.createDataFrame([], schema) if out is None else out


def _moved(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


class _Grower:
    """Grows one tree at a time on coded rows (a line a feature), CHUNK rows after the other."""

    def __init__(self, lines: np.ndarray, label: np.ndarray, base: float, bins: int, depth: int, min_child: float, gamma: float,
                 alpha: float, lam: float):
        self.lines, self.label, self.bins, self.depth = lines, label, bins, depth
        self.min_child, self.gamma, self.alpha, self.lam = min_child, gamma, alpha, lam
        n = lines.shape[1]
        self.chunks = [(k, min(k + CHUNK, n)) for k in range(0, max(n, 1), CHUNK)]
        self.margin, self.at, self.drawn = room((n,), "f8"), room((n,), "i4"), room((n,), "?")
        self.margin[:] = base

    def score(self, g, h):
        out = np.abs(g)
        out -= self.alpha
        np.maximum(out, 0.0, out=out)
        out *= out
        out /= h + self.lam + 1e-16
        return out

    def state(self, low: int, high: int, slot: np.ndarray) -> tuple[np.ndarray | None, ...]:
        """(rows, gradients, hessians, first bins) of the drawn rows of a chunk whose node has a slot; rows are None if all are."""
        place = slot[self.at[low:high]]
        mine = np.flatnonzero(self.drawn[low:high] & (place >= 0))
        p, y = self.margin[low:high], self.label[low:high]
        if len(mine) == high - low:
            mine = None
        else:
            p, y, place = p[mine], y[mine], place[mine]
        p = probability(p)
        return mine, p - y, p * (1 - p), place * self.bins

    def histograms(self, chosen: np.ndarray, slot: np.ndarray, nodes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Gradient and hessian sums by (node, bin) of each chosen feature; those of one at a time stay in the cache."""
        size = nodes * self.bins
        if len(self.chunks) == 1:
            mine, g, h, base = self.state(*self.chunks[0], slot)
            for f in chosen.tolist():
                line = self.lines[f]
                place = base + (line if mine is None else line.take(mine))
                yield np.bincount(place, g, size), np.bincount(place, h, size)
            return
        group = max(1, TABLE_BYTES // (16 * size))
        for first in range(0, len(chosen), group):
            some = chosen[first:first + group].tolist()
            total: list = [None] * len(some)
            for low, high in self.chunks:
                mine, g, h, base = self.state(low, high, slot)
                for i, f in enumerate(some):
                    line = self.lines[f, low:high]
                    place = base + (line if mine is None else line.take(mine))
                    made = np.bincount(place, g, size), np.bincount(place, h, size)
                    if total[i] is None:
                        total[i] = made
                    else:
                        for a, b in zip(total[i], made, strict=True):
                            a += b
            yield from total

    def grow(self, chosen: np.ndarray, rate: float) -> tuple[np.ndarray, ...]:
        """(feature, cut, left, right, value, cover) of the nodes, the root first; adds the tree to the margins."""
        wide = len(chosen)
        feature, cut, left, right = [-1], [0], [0], [0]
        total_g, total_h = [0.0], [0.0]
        self.at[:] = 0  # node of each row
        for low, high in self.chunks:
            _, g, h, _ = self.state(low, high, np.zeros(1, "i8"))
            total_g[0] += float(g.sum())
            total_h[0] += float(h.sum())
        active = np.zeros(1, "i8")  # nodes of this level
        for _ in range(self.depth):
            active = active[np.array([total_h[k] >= 2 * self.min_child for k in active.tolist()], bool)]
            if not len(active):
                break
            slot = np.full(len(feature), -1)
            slot[active] = np.arange(len(active))
            sum_g, sum_h = np.array([total_g[k] for k in active.tolist()]), np.array([total_h[k] for k in active.tolist()])
            gains, cuts, best_g, best_h = (np.empty((wide, len(active)), k) for k in ("f8", "i8", "f8", "f8"))
            each = np.arange(len(active))
            for f, (low_g, low_h) in enumerate(self.histograms(chosen, slot, len(active))):
                low_g = low_g.reshape(-1, self.bins).cumsum(axis=1)[:, :-1]
                low_h = low_h.reshape(-1, self.bins).cumsum(axis=1)[:, :-1]
                high_h = sum_h[:, None] - low_h
                gain = self.score(low_g, low_h)
                gain += self.score(sum_g[:, None] - low_g, high_h)
                gain[(low_h < self.min_child) | (high_h < self.min_child)] = -np.inf
                cuts[f] = b = gain.argmax(axis=1)
                gains[f], best_g[f], best_h[f] = gain[each, b], low_g[each, b], low_h[each, b]
            best = gains.argmax(axis=0)  # the first feature of equal ones, and of that its first cut
            good = gains[best, each] - self.score(sum_g, sum_h) > max(self.gamma, 1e-12)
            grown = []
            for i in np.flatnonzero(good).tolist():
                node, f = int(active[i]), int(best[i])
                feature[node], cut[node] = int(chosen[f]), int(cuts[f, i])
                left[node], right[node] = len(feature), len(feature) + 1
                lg, lh = float(best_g[f, i]), float(best_h[f, i])
                for a, c in ((lg, lh), (total_g[node] - lg, total_h[node] - lh)):
                    grown.append(len(feature))
                    feature.append(-1), cut.append(0), left.append(0), right.append(0)
                    total_g.append(a), total_h.append(c)
            if not grown:
                break
            by, at_most, lefts, rights = np.array(feature), np.array(cut), np.array(left), np.array(right)
            for low, high in self.chunks:  # all rows move, drawn or not: leaves have no feature
                at = self.at[low:high]
                moving = np.flatnonzero(by[at] >= 0)
                here = at[moving]
                down = self.lines[by[here], low + moving] <= at_most[here]
                at[moving] = np.where(down, lefts[here], rights[here])
            active = np.array(grown)
        value = -_moved(np.array(total_g), self.alpha) / (np.array(total_h) + self.lam + 1e-16) * rate
        for low, high in self.chunks:
            self.margin[low:high] += value[self.at[low:high]]
        return np.array(feature), np.array(cut), np.array(left), np.array(right), value, np.array(total_h)


def boost(coded: np.ndarray, label: np.ndarray, edges: np.ndarray, params: dict, seed: int = SEED) -> Forest:
    """A forest of ``params`` (n_trees, max_depth, learning_rate, subsample, colsample, min_child, gamma, reg_alpha, reg_lambda)."""
    return boost_lines(np.ascontiguousarray(coded.T), label, edges, params, seed)


def boost_lines(lines: np.ndarray, label: np.ndarray, edges: np.ndarray, params: dict, seed: int = SEED) -> Forest:
    """``boost`` on codes that are kept a line a feature."""
    wide, n = lines.shape
    rng = np.random.default_rng(seed)
    share = min(max(label.mean() if n else 0.5, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    grower = _Grower(lines, label, base, edges.shape[1] + 1, int(params["max_depth"]), float(params["min_child"]), float(params["gamma"]),
                     float(params["reg_alpha"]), float(params["reg_lambda"]))
    names, kinds = ("feature", "cut", "left", "right", "value", "cover"), ("i4", "u1", "i8", "i8", "f8", "f8")
    trees, roots, size = [[np.zeros(0, k)] for k in kinds], [], 0
    count = max(1, int(np.ceil(params["colsample"] * wide)))
    for _ in range(int(params["n_trees"])):
        for low, high in grower.chunks:
            grower.drawn[low:high] = rng.random(high - low) < params["subsample"]
        chosen = np.sort(rng.permutation(wide)[:count])
        made = grower.grow(chosen, float(params["learning_rate"]))
        roots.append(size)
        for name, kind, columns, column in zip(names, kinds, trees, made, strict=True):
            columns.append((column + size if name in ("left", "right") else column).astype(kind))
        size += len(made[0])
    return Forest(edges, base, *map(np.concatenate, trees), np.array(roots, "i8"), dict(params))


def fit_boosted(train: DataFrame, width: int, params: dict, label: str = "label", features: str = "features",
                edges: np.ndarray | None = None, seed: int = SEED) -> Forest:
    """One forest, grown by a task on all rows."""
    edges = bin_edges(train, width, features) if edges is None else edges
    names = ("feature", "cut", "left", "right", "value", "cover", "roots")
    kinds = ("i4", "u1", "i8", "i8", "f8", "f8", "i8")

    def work(job: dict, rows: tuple[np.ndarray, np.ndarray]) -> Iterator[pd.DataFrame]:
        made = boost_lines(*rows, edges, job, seed)
        yield pd.DataFrame({k: [getattr(made, k).tobytes()] for k in names} | {"base": [made.base]})

    held = coded_rows(train, edges, label, features)
    row = _task_each([held], width, [params], work, ", ".join(f"{n} binary" for n in names) + ", base double").first()
    return Forest(edges, row["base"], *[np.frombuffer(row[n], k) for n, k in zip(names, kinds, strict=True)], dict(params))


def fit_trials(trials: DataFrame, train: DataFrame, val: DataFrame, width: int, label: str = "label", features: str = "features",
               edges: np.ndarray | None = None, seed: int = SEED, coded: list[Coded] | None = None) -> DataFrame:
    """(trial, label, score, fit_seconds) of all validation rows under every trial; one task a trial, the longest first.

    ``coded`` may hold the ``coded_rows`` of both tables, if more trials are to follow.
    """
    spark = trials.sparkSession
    edges = bin_edges(train, width, features) if edges is None else edges
    held = coded or [coded_rows(t, edges, label, features) for t in (train, val)]

    def work(job: dict, rows: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray]) -> Iterator[pd.DataFrame]:
        began = time.time()
        forest = boost_lines(*rows, edges, job, seed + int(job["trial"]))
        spent = time.time() - began
        lines, y = others
        for k in range(0, len(y), SCORE_ROWS):
            margin = forest.margin(np.ascontiguousarray(lines[:, k:k + SCORE_ROWS].T))
            yield pd.DataFrame({"trial": job["trial"], "label": y[k:k + SCORE_ROWS], "score": probability(margin), "fit_seconds": spent})

    jobs = sorted((r.asDict() for r in trials.collect()), key=lambda t: (-t["n_trees"] * t["max_depth"] * t["colsample"], t["trial"]))  # the trial table: few rows
    out = _task_each(held, width, jobs, work, "trial long, label int, score double, fit_seconds double")
    before = spark.conf.get(UNION, None)
    spark.conf.set(UNION, "false")  # else a union of single partitions is one partition, and one task fits all trials
    try:
        return cut_lineage(out)
    finally:
        spark.conf.unset(UNION) if before is None else spark.conf.set(UNION, before)
