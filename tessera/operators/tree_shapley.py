"""Exact Shapley values of tree ensembles, over the trees' own covers.

With no value known for a feature, a row goes down both sides of a split in the shares of the training
rows that did.  A leaf's part is then a product over the features of its path: feature k contributes o_k (1 if
the row meets all of the path's conditions on k, else 0) if it is known, and z_k (the share of those that
reached the leaf's side) if not.  The Shapley value of j at a leaf of value v is

    v * (o_j - z_j) * integral over t in [0, 1] of the product over k != j of (z_k (1 - t) + o_k t) dt,

a polynomial in t of degree below the path's length, which Gauss-Legendre points integrate exactly.  All rows
of a batch are handled at once, leaf by leaf; a row stays one row, and the trees (bounded by the learner's
depth and number of trees) travel with the function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.boosting import Forest, codes, matrix


@dataclass
class Trees:
    """Node tables with plain thresholds: left if the value is at most ``threshold``; leaves have feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    roots: np.ndarray
    width: int
    base: float = 0.0
    edges: np.ndarray | None = None  # given: thresholds are codes of these bins


def of_forest(forest: Forest) -> Trees:
    """The trees of a boosted forest; they add up to its margin."""
    return Trees(forest.feature, forest.cut.astype("f8"), forest.left, forest.right, forest.value, forest.cover, forest.roots,
                 len(forest.edges), forest.base, forest.edges)


def of_spark_tree(model, width: int, value=None) -> Trees:
    """The nodes of a fitted Spark ML decision tree; leaf values are the shares of label 1 unless ``value`` (of a node) is given."""
    rows: list[list] = []

    def add(node) -> int:
        at, stats = len(rows), node.impurityStats()
        total = float(sum(stats.stats()))
        rows.append([-1, 0.0, 0, 0, value(node) if value else float(stats.stats()[1]) / total if total else 0.0, total])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[at][:2] = [split.featureIndex(), split.threshold()]
            rows[at][2] = add(node.leftChild())
            rows[at][3] = add(node.rightChild())
        return at

    add(model._java_obj.rootNode())
    columns = [np.array(c) for c in zip(*rows, strict=True)]
    return Trees(*columns, np.zeros(1, "i8"), width)


def paths(trees: Trees) -> Iterator[tuple[float, list[tuple[int, float, float, float]]]]:
    """(value, [(feature, above, at most, share)]) of every leaf: one interval and one share for each feature of its path."""
    for root in trees.roots.tolist():
        stack = [(root, {})]
        while stack:
            node, held = stack.pop()
            f = int(trees.feature[node])
            if f < 0:
                yield float(trees.value[node]), [(k, *v) for k, v in held.items()]
                continue
            low, high, share = held.get(f, (-np.inf, np.inf, 1.0))
            cut, total = float(trees.threshold[node]), float(trees.cover[node])
            for child, interval in ((int(trees.left[node]), (low, min(high, cut))), (int(trees.right[node]), (max(low, cut), high))):
                part = float(trees.cover[child]) / total if total else 0.5
                stack.append((child, {**held, f: (*interval, share * part)}))


def expected(trees: Trees) -> float:
    """The prediction with no feature known."""
    return trees.base + sum(v * float(np.prod([s for *_, s in path])) for v, path in paths(trees))


def shapley(trees: Trees, x: np.ndarray) -> np.ndarray:
    """rows x features: exact Shapley values of the summed trees."""
    out = np.zeros((len(x), trees.width))
    points: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for value, path in paths(trees):
        m = len(path)
        if not m or not value:
            continue
        if m not in points:
            at, weight = np.polynomial.legendre.leggauss((m + 1) // 2 + 1)
            points[m] = ((at + 1) / 2, weight / 2)
        t, weight = points[m]
        known = np.stack([(x[:, f] > low) & (x[:, f] <= high) for f, low, high, _ in path]).astype("f8")  # features x rows
        share = np.array([s for *_, s in path])
        factor = share[:, None, None] * (1 - t) + known[:, :, None] * t  # features x rows x points
        # products of all factors but one, from both ends
        before, after = np.ones_like(factor), np.ones_like(factor)
        np.cumprod(factor[:-1], axis=0, out=before[1:])
        after[:-1] = np.cumprod(factor[:0:-1], axis=0)[::-1]
        parts = value * (known - share[:, None]) * ((before * after) @ weight)
        for (f, *_), part in zip(path, parts, strict=True):
            out[:, f] += part
    return out


def shapley_trees(trees: Trees, rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, feature, phi, base): every feature of every row; phi and base add up to the trees' prediction."""
    base = expected(trees)
    kind = rows.schema[vec_col].dataType.simpleString()
    vec = vector_to_array(vec_col) if kind == "vector" else F.col(vec_col).cast("array<double>")

    def phi(v: pd.Series) -> pd.Series:
        x = matrix(v, trees.width)
        return pd.Series(list(shapley(trees, codes(x, trees.edges).astype("f8") if trees.edges is not None else x)))

    made = rows.select(id_col, F.pandas_udf(phi, "array<double>")(vec).alias("__phi"))
    return made.select(id_col, F.posexplode("__phi").alias("feature", "phi")).withColumn("base", F.lit(base))
