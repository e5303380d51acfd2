"""A feed-forward classifier trained by mini-batches over all rows, in parallel with averaged states.

The training rows are dealt once to ``workers`` partitions and checkpointed there.  An epoch is one job: every
task starts from the state of the last epoch (a broadcast as large as the model), streams its rows an Arrow
batch at a time and takes steps on its share of each mini-batch; the states of all tasks then meet in pieces of
PIECE entries, where they are averaged, weighted by rows.  A lost executor repeats its own tasks of one epoch.

* Layers: linear, batch norm, ReLU, dropout for each hidden size, then linear and sigmoid.
* Batch norm takes mean and variance of the task's share of the mini-batch; running averages serve for scoring.
* Adam with bias correction; the rate falls by ``factor`` after ``patience`` epochs without a better loss.

Not an exchange of gradients at every step: Spark's barrier stages answer a gather about a second after it was
asked (24.6 s for 21 steps of 600 rows by three tasks, measured), and lose the whole stage with one executor.

What is exchanged grows with the model and the number of workers (MAX_WORKERS at most), never with the rows; a task
holds one Arrow batch and one mini-batch share at a time.

Defined results: null and NaN features count as 0 (the mean of a standardised column); rows with a null label or
vector are not learnt from, and a null vector is scored as all zeros; a table without rows gives the initial net.
Rows are dealt in turn and ordered by content, so equal rows are spread over all tasks and batches, and reruns with
equal workers and input partitions agree.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.boosting import as_array, probability
from tessera.session import cut_lineage

# fixed values: default sizes and rates of the net
HIDDEN = (256, 128, 64)
DROPOUT = (0.3, 0.2, 0.0)
DEFAULTS = dict(epochs=30, batch_size=4096, rate=1e-3)
PATIENCE, FACTOR, THRESHOLD = 3, 0.1, 1e-4
BETA_1, BETA_2, EPSILON = 0.9, 0.999, 1e-8
NORM_EPSILON, NORM_MOMENTUM = 1e-5, 0.1

MAX_WORKERS = 1024
LEAST_ROWS = 512
ROWS_PER_WORKER = 500_000
PIECE = 4096
SEED = 42


@dataclass
class Shape:
    """Places of the parameters in one flat array: weights, bias, scale and shift of each layer, then the output's."""

    width: int
    hidden: tuple[int, ...]

    def layers(self) -> list[tuple[int, int]]:
        sizes = [self.width, *self.hidden, 1]
        return list(zip(sizes, sizes[1:], strict=False))

    def views(self, flat: np.ndarray) -> list[list[np.ndarray]]:
        """[weights, bias, scale, shift] of every layer as views of ``flat``; the output has no scale and shift."""
        found, at = [], 0
        for i, (a, b) in enumerate(self.layers()):
            parts = []
            for size in [(a, b), (b,)] + ([(b,), (b,)] if i < len(self.hidden) else []):
                n = math.prod(size)
                parts.append(flat[at:at + n].reshape(size))
                at += n
            found.append(parts)
        return found

    @property
    def size(self) -> int:
        return sum(a * b + b * (3 if i < len(self.hidden) else 1) for i, (a, b) in enumerate(self.layers()))

    @property
    def norms(self) -> int:
        """Entries of the running statistics: a mean and a variance of every hidden unit."""
        return 2 * sum(self.hidden)


@dataclass
class State:
    """Parameters, both moments of Adam, running statistics and the number of steps."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    running: np.ndarray
    steps: int = 0

    @classmethod
    def initial(cls, shape: Shape, seed: int) -> State:
        rng = np.random.default_rng(seed)
        weights = np.zeros(shape.size)
        for (a, b), parts in zip(shape.layers(), shape.views(weights), strict=True):
            bound = 1 / math.sqrt(a)
            parts[0][:] = rng.uniform(-bound, bound, (a, b))
            parts[1][:] = rng.uniform(-bound, bound, b)
            if len(parts) > 2:
                parts[2][:] = 1.0
        running = np.concatenate([np.r_[np.zeros(b), np.ones(b)] for b in shape.hidden] or [np.zeros(0)])
        return cls(weights, np.zeros(shape.size), np.zeros(shape.size), running)

    def step(self, gradient: np.ndarray, rate: float) -> None:
        self.steps += 1
        self.first += (1 - BETA_1) * (gradient - self.first)
        self.second += (1 - BETA_2) * (gradient * gradient - self.second)
        mean = self.first / (1 - BETA_1 ** self.steps)
        spread = np.sqrt(self.second / (1 - BETA_2 ** self.steps))
        self.weights -= rate * mean / (spread + EPSILON)


def loss_and_gradient(shape: Shape, weights: np.ndarray, x: np.ndarray, y: np.ndarray,
                      masks: list[np.ndarray | None]) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum of the rows' cross entropies, its gradient, and mean and variance of every hidden unit.

    ``masks`` holds the dropout factors (0, or 1 / share kept) of each hidden layer, or None.
    """
    *inner, (out_w, out_b) = shape.views(weights)
    value, kept, moments = x, [], []
    for (w, b, scale, shift), mask in zip(inner, masks, strict=True):
        z = value @ w + b
        mean, var = z.mean(axis=0), z.var(axis=0)
        wide = np.sqrt(var + NORM_EPSILON)
        normed = (z - mean) / wide
        active = scale * normed + shift
        factor = (active > 0) * (1.0 if mask is None else mask)
        kept.append((value, normed, wide, factor))
        moments += [mean, var * (len(x) / max(len(x) - 1, 1))]
        value = active * factor
    margin = (value @ out_w + out_b)[:, 0]
    loss = float(np.logaddexp(0.0, margin).sum() - (margin * y).sum())

    gradient = np.zeros_like(weights)
    *inner_g, (out_gw, out_gb) = shape.views(gradient)
    back = (probability(margin) - y)[:, None]
    out_gw[:], out_gb[:] = value.T @ back, back.sum(axis=0)
    back = back @ out_w.T
    for (w, _, scale, _), (gw, gb, gscale, gshift), (given, normed, wide, factor) in zip(inner[::-1], inner_g[::-1], kept[::-1], strict=True):
        back = back * factor
        gscale[:], gshift[:] = (back * normed).sum(axis=0), back.sum(axis=0)
        back = back * scale
        back = (back - back.mean(axis=0) - normed * (back * normed).mean(axis=0)) / wide
        gw[:], gb[:] = given.T @ back, back.sum(axis=0)
        back = back @ w.T
    return loss, gradient, np.concatenate(moments) if moments else np.zeros(0)


def margins(shape: Shape, weights: np.ndarray, running: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The output before the sigmoid, with running statistics and without dropout."""
    *inner, (out_w, out_b) = shape.views(weights)
    at = 0
    for w, b, scale, shift in inner:
        n = len(b)
        mean, var = running[at:at + n], running[at + n:at + 2 * n]
        at += 2 * n
        x = np.maximum(scale * (x @ w + b - mean) / np.sqrt(var + NORM_EPSILON) + shift, 0.0)
    return (x @ out_w + out_b)[:, 0]


def dense(column: pd.Series, width: int) -> np.ndarray:
    """Rows x width; null vectors, null entries and NaN are 0."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        if v is not None:
            out[i] = np.asarray(v, "f8")
    return np.nan_to_num(out, nan=0.0, posinf=0.0, neginf=0.0)


def _shares(batches: Iterator[pd.DataFrame], width: int, rows: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Mini-batch shares of ``rows`` rows, each Arrow batch in a drawn order; the last one may be smaller."""
    x, y = np.zeros((0, width)), np.zeros(0)
    for batch in batches:
        order = rng.permutation(len(batch))
        x = np.concatenate([x, dense(batch["v"], width)[order]])
        y = np.concatenate([y, batch["y"].to_numpy("f8")[order]])
        while len(x) >= rows:
            yield x[:rows], y[:rows]
            x, y = x[rows:], y[rows:]
    if len(x):
        yield x, y


def train_share(batches: Iterator[pd.DataFrame], shape: Shape, state: State, dropout: tuple[float, ...], rows: int, rate: float,
                seed: tuple[int, ...]) -> tuple[State, float, int]:
    """One epoch of one task from ``state`` (left as it is): (new state, loss sum, rows)."""
    rng = np.random.default_rng(seed)
    mine = State(state.weights.copy(), state.first.copy(), state.second.copy(), state.running.copy(), state.steps)
    total, seen = 0.0, 0
    for x, y in _shares(batches, shape.width, rows, rng):
        masks = [None if not p else (rng.random((len(x), n)) >= p) / (1 - p) for p, n in zip(dropout, shape.hidden, strict=True)]
        loss, gradient, moments = loss_and_gradient(shape, mine.weights, x, y, masks)
        mine.step(gradient / len(x), rate)
        mine.running += NORM_MOMENTUM * (moments - mine.running)
        total, seen = total + loss, seen + len(x)
    return mine, total, seen


def pieces(state: State, loss: float, seen: int, rank: int) -> pd.DataFrame:
    """A task's state in pieces of PIECE entries."""
    flat = np.concatenate([state.weights, state.first, state.second, state.running])
    cuts = [flat[i:i + PIECE] for i in range(0, len(flat), PIECE)]
    return pd.DataFrame({"piece": range(len(cuts)), "rank": rank, "seen": seen, "loss": loss, "steps": state.steps,
                         "entries": [c.tobytes() for c in cuts]})


def averaged(group: pd.DataFrame) -> pd.DataFrame:
    """One piece of all tasks, averaged with their rows as weights; added in the order of ranks."""
    group = group.sort_values("rank")
    entries = np.stack([np.frombuffer(e, "f8") for e in group["entries"]])
    mean = np.average(entries, axis=0, weights=group["seen"])
    return pd.DataFrame({"piece": group["piece"].iloc[:1].to_numpy(), "seen": [int(group["seen"].sum())], "loss": [float(group["loss"].sum())],
                         "steps": [int(group["steps"].max())], "entries": [mean.tobytes()]})


@dataclass
class NetModel:
    name: str
    shape: Shape
    state: State
    losses: list[float]  # mean training loss of every epoch
    rates: list[float]
    fit_seconds: float
    params: dict = field(default_factory=dict)
    features: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score`` (the probability of label 1) and ``prediction``."""
        shape, weights, running = self.shape, self.state.weights, self.state.running

        def scored(v: pd.Series) -> pd.Series:
            return pd.Series(probability(margins(shape, weights, running, dense(v, shape.width))), dtype="float64")

        score = F.pandas_udf(scored, "double")
        return df.withColumn("score", score(as_array(df, self.features))).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def dealt(train: DataFrame, label: str, features: str, workers: int | None = None) -> tuple[DataFrame, int]:
    """(v, y) of the rows to learn from, in one partition for each worker, and the number of workers.

    Rows are dealt in turn, so no value can be hot; in a partition they are sorted by content, numbered, and
    then ordered by the hash of the number, which spreads equal rows.
    """
    given = train.select(as_array(train, features).alias("v"), F.col(label).cast("double").alias("y")).filter("v is not null and y is not null")
    if workers is None:
        n, cores = given.count(), train.sparkSession.sparkContext.defaultParallelism
        workers = max(1, min(MAX_WORKERS, max(min(cores, math.ceil(n / LEAST_ROWS)), math.ceil(n / ROWS_PER_WORKER))))
    given = given.repartition(workers).sortWithinPartitions("v", "y").withColumn("at", F.xxhash64(F.monotonically_increasing_id()))
    return cut_lineage(given.sortWithinPartitions("at").select("v", "y")), workers


def fit_net(train: DataFrame, width: int, label: str = "label", features: str = "features", hidden: tuple[int, ...] = HIDDEN,
            dropout: tuple[float, ...] = DROPOUT, workers: int | None = None, seed: int = SEED, **kw) -> NetModel:
    """Train on all rows of ``train``; ``kw``: epochs, batch_size (over all workers), rate."""
    began = time.time()
    p = {**DEFAULTS, **kw}
    shape, rate = Shape(width, tuple(hidden)), float(p["rate"])
    state = State.initial(shape, seed)
    rows, workers = dealt(train, label, features, workers)
    share = max(1, p["batch_size"] // workers)
    spark = train.sparkSession
    losses, rates = [], []
    best, waited = math.inf, 0
    for epoch in range(p["epochs"]):
        held = spark.sparkContext.broadcast(state)

        def run(batches: Iterator[pd.DataFrame], held=held, rate=rate, epoch=epoch) -> Iterator[pd.DataFrame]:
            rank = TaskContext.get().partitionId()
            made, loss, seen = train_share(batches, shape, held.value, dropout, share, rate, (seed, epoch, rank))
            if seen:
                yield pieces(made, loss, seen, rank)

        sent = rows.mapInPandas(run, "piece int, rank int, seen long, loss double, steps long, entries binary")
        met = sent.groupBy("piece").applyInPandas(averaged, "piece int, seen long, loss double, steps long, entries binary")
        found = sorted(met.collect(), key=lambda r: r["piece"])  # as large as the model and its moments
        held.destroy()
        if not found:
            break
        flat = np.frombuffer(b"".join(bytes(r["entries"]) for r in found), "f8")
        cuts = np.cumsum([shape.size] * 3)
        state = State(*[x.copy() for x in np.split(flat, cuts)], found[0]["steps"])
        losses.append(found[0]["loss"] / found[0]["seen"])
        rates.append(rate)
        if losses[-1] < best * (1 - THRESHOLD):
            best, waited = losses[-1], 0
        else:
            waited += 1
            if waited > PATIENCE:
                rate, waited = rate * FACTOR, 0
    return NetModel("net", shape, state, losses, rates, time.time() - began, {**p, "hidden": list(hidden), "workers": workers}, features)
