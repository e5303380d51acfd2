"""Whitening of vectors by shifted Cholesky QR.

``fit`` learns from every usable row of a table; no row of it reaches the driver:

1. the exact sums of the integer entries x = floor(SCALE * c) + OFFSET give the centred rows
   y = (n * x - sums) / n;
2. Gram passes: every task adds up its rows' products, the sums meet by entry, and the driver
   factors one small matrix.  The first factor is of the Gram matrix plus a shift, which a nearly
   dependent table can't break; each later pass solves the rows through the factors so far, and factors
   the Gram matrix of what is left, until that is the identity (three passes as a rule);
3. the product of the factors is R of Y = QR.  Its singular values and right singular vectors are
   those of Y, found without squaring the condition of Y.

``transform`` projects centred rows on the components and scales them to unit variance.

Bounds: a task and the driver hold d * d numbers for d dimensions, whatever the number of rows.

Defined results: a row counts if its vector isn't null or empty, holds no null and no entry that
isn't finite or whose magnitude is 2**40 or more (a sum of such entries need not fit in a long),
and has the commonest length (of equally common ones the greatest); other rows are dropped.
Repeated rows count as often as they come.  Components whose variance is not above RANK of the
first one's don't exist: a table of equal rows, of one row or without rows gives no component and
no row.  ``deviation`` is null where it exceeds a long.  Other columns are carried by
``transform``, but for those named like its results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import then_give_back

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
RANK = 1e-12
MOST_PASSES = 8
LARGEST = float(1 << 40)
UNIT = 2.0 ** -53


@dataclass
class Whitening:
    """What ``fit`` learns: plain numbers, d * d of them at most."""

    n: int
    sums: np.ndarray  # of the entries x, by dimension
    variances: np.ndarray  # by component, falling
    components: np.ndarray  # one unit vector a row
    trace: float
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.trace if self.trace else self.variances


def entries(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable rows of a list column, their entries x)."""
    fits = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(column), dimension), False), bool)
    at = np.flatnonzero(fits)
    c = np.asarray(column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False), "f8").reshape(-1, dimension)
    with np.errstate(invalid="ignore"):
        good = (np.abs(c) < LARGEST).all(axis=1)  # false for nulls, which arrive as NaN
    return at[good], np.floor(SCALE * c[good]).astype("i8") + OFFSET


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows times the inverse of the upper triangle r, by substitution."""
    out = np.empty_like(rows)
    for j in range(len(r)):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _totals(df: DataFrame, column: str, size: int, kind: str, of: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """The sums by place of ``of(batch)`` (``size`` numbers) over all batches: one row a task, then one a place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, "i8" if kind == "long" else "f8")
        for batch in batches:
            total += of(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["total"])

    tasks = df.select(column).mapInArrow(then_give_back(run), f"total array<{kind}>")
    found = tasks.select(F.posexplode("total").alias("place", "value")).groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size, "i8" if kind == "long" else "f8")
    for row in found:  # ``size`` rows, whatever the table
        out[row["place"]] = row["value"]
    return out


def _square(flat: np.ndarray, d: int) -> np.ndarray:
    out = np.zeros((d, d))
    out[np.triu_indices(d)] = flat
    return out + np.triu(out, 1).T


def factor(gram: np.ndarray, rows: int, first: bool) -> np.ndarray:
    """The upper Cholesky factor of a Gram matrix; shifted in the first pass, and where it is singular."""
    d = len(gram)
    size = np.linalg.norm(gram, 2)
    shift = min(11 * (rows * d + d * (d + 1)) * UNIT, 1e-6) * size if first else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(4 * shift, 4 * d * UNIT * size)


def dimension_of(df: DataFrame, column: str) -> int:
    """The commonest length of the vectors (0: there are none)."""
    found = (df.filter(F.size(column) > 0).groupBy(F.size(column).alias("size")).count()
             .agg(F.max_by("size", F.struct("count", "size")).alias("size")).first())
    return found["size"] or 0


def _vectors(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("array<double>").alias("vector"))


def fit(df: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> Whitening:
    """The ``most`` first whitening components of the usable vectors of ``df``."""
    d = dimension_of(df, column)
    rows = _vectors(df, column)

    def sums_of(batch: pa.Array) -> np.ndarray:
        _, x = entries(batch, d)
        return np.append(x.sum(axis=0), len(x))

    counted = _totals(rows, "vector", d + 1, "long", sums_of) if d else np.zeros(1, "i8")
    n, sums = int(counted[-1]), counted[:-1]
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((0, d)), 0.0, 0)
    factors: list[np.ndarray] = []
    upper = np.triu_indices(d)

    def gram_of(batch: pa.Array) -> np.ndarray:
        q = centred(entries(batch, d)[1], n, sums)
        for r in factors:
            q = solved(q, r)
        return (q.T @ q)[upper]

    trace = 0.0
    for step in range(MOST_PASSES):
        gram = _square(_totals(rows, "vector", len(upper[0]), "double", gram_of), d)
        if not step:
            trace = float(np.trace(gram)) / n
            if not trace:
                return Whitening(n, sums, np.zeros(0), np.zeros((0, d)), 0.0, 1)
        values = np.linalg.eigvalsh(gram)
        # directions without variance never become unit vectors; one more factor after the others are
        # near to it leaves an error of the order of the square
        done = step and np.abs(values[values > 1e-8] - 1).max(initial=0.0) < 1e-8
        factors.append(factor(gram, n, not step))
        if done:
            break
    r = factors[0]
    for f in factors[1:]:
        r = f @ r
    _, singular, right = np.linalg.svd(r)
    variances = singular ** 2 / n
    count = min(most, int((variances > RANK * variances[0]).sum()))
    components = right[:count]
    # one sign for all reruns: the entry of greatest magnitude is positive
    top = np.abs(components).argmax(axis=1)
    components = components * np.sign(components[np.arange(count), top])[:, None]
    return Whitening(n, sums, variances[:count], components, trace, len(factors))


def whitened_rows(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, model.n, model.sums) @ (model.components / np.sqrt(model.variances)[:, None]).T


def _deviation(x: np.ndarray, model: Whitening) -> pa.Array:
    """Exact sums of squares of n * x - sums, null beyond a long."""
    apart = model.n * x - model.sums
    size = (apart.astype("f8") ** 2).sum(axis=1)
    fits = size < 9.2e18
    whole = np.where(fits[:, None], apart, 0)
    return pa.array((whole * whole).sum(axis=1), mask=~fits)


def transform(df: DataFrame, model: Whitening, column: str = "embedding", whitened: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """The usable rows of ``df`` without ``column``, with the whitened vector (one number a component) and the
    squared distance to the mean, times n * n, as a long."""
    keep = [f for f in df.schema.fields if f.name != column and f.name.lower() not in (whitened.lower(), deviation.lower())]
    d = len(model.sums)
    carried = [f"c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = entries(batch.column("vector"), d)
            made = whitened_rows(x, model)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * made.shape[1], pa.int32()), pa.array(made.ravel()))
            rest = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*[rest.column(c) for c in carried], lists, _deviation(x, model)], [*carried, "w", "d"])

    schema = T.StructType([*[T.StructField(c, f.dataType) for c, f in zip(carried, keep, strict=True)],
                           T.StructField("w", T.ArrayType(T.DoubleType())), T.StructField("d", T.LongType())])
    given = df.select(*[F.col(f"`{f.name}`").alias(c) for c, f in zip(carried, keep, strict=True)], F.col(column).cast("array<double>").alias("vector"))
    if not len(model.variances):
        given = given.filter(F.lit(False))
    made = given.mapInArrow(then_give_back(run), schema)
    return made.select(*[F.col(c).alias(f.name) for c, f in zip(carried, keep, strict=True)], F.col("w").alias(whitened), F.col("d").alias(deviation))


def identity_error(df: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """The largest absolute entry of the covariance of the whitened rows of ``df`` minus the identity."""
    k, d = len(model.variances), len(model.sums)
    if not k or not model.n:
        return 0.0
    upper = np.triu_indices(k)

    def of(batch: pa.Array) -> np.ndarray:
        w = whitened_rows(entries(batch, d)[1], model)
        return np.concatenate(((w.T @ w)[upper], w.sum(axis=0), [len(w)]))

    total = _totals(_vectors(df, column), "vector", len(upper[0]) + k + 1, "double", of)
    mean = total[-k - 1:-1] / total[-1]
    return float(np.abs(_square(total[:-k - 1], k) / total[-1] - np.outer(mean, mean) - np.eye(k)).max())
