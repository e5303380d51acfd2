"""A metric tree over the vectors of a table: pivots of pivots, with a radius and a count at each node.

Every node that holds more than ``cell`` rows has up to FANOUT children around pivots drawn from its own rows
by hash order; a row goes down to the nearest pivot's child.  A level costs one pass over the table: where a row
stands is recomputed from its vector and the tree so far, so no row is written down between levels.  The
tree itself (pivots, radii, counts) is bounded: ``cell`` grows with the table so that the nodes stay below
TREE_BYTES, and travels to the tasks whole.

``candidates`` descends the tree for a block of queries at once and keeps an upper bound of every
query's k-th distance; a subtree whose nearest possible row is beyond the bounds of all queries of the block
is left out.  What stays is exact: no true neighbour is in a cell that is left out.

Defined results: rows of equal vectors can't be told apart, so a cell of radius zero, or one whose drawn pivots are
all equal, stays whole, whatever its size; groups without references have no tree; null vectors aren't allowed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_hex

FANOUT = 64
CELL = 1_024
TREE_BYTES = 128 << 20
SLACK = 1e-9
QUERIES = 64


@dataclass
class Tree:
    """Nodes by number; the roots (one a group) have no pivot and hold all rows of their group."""

    roots: dict = field(default_factory=dict)
    pivots: list = field(default_factory=list)
    children: list = field(default_factory=list)  # of each node: numbers, or nothing for a leaf
    radius: list = field(default_factory=list)
    count: list = field(default_factory=list)

    def add(self, pivot, count: int = 0, radius: float = math.inf) -> int:
        self.pivots.append(pivot)
        self.children.append([])
        self.radius.append(radius)
        self.count.append(count)
        return len(self.pivots) - 1


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """rows x pivots: Euclidean distances."""
    out = np.empty((len(x), len(pivots)))
    for i, p in enumerate(pivots):
        apart = x - p
        out[:, i] = np.sqrt(np.einsum("ij,ij->i", apart, apart))
    return out


def leaves(tree: Tree, groups: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, distance to its pivot) of each row; -1 for rows of groups without a tree."""
    at = np.array([tree.roots.get(g, -1) for g in groups], "i8")
    away = np.zeros(len(x))
    open_rows = np.flatnonzero(at >= 0)
    while len(open_rows):
        order = open_rows[np.argsort(at[open_rows], kind="stable")]
        nodes, first = np.unique(at[order], return_index=True)
        moved = []
        for node, rows in zip(nodes.tolist(), np.split(order, first[1:]), strict=True):
            below = tree.children[node]
            if below:
                d = distances(x[rows], np.array([tree.pivots[c] for c in below]))
                best = d.argmin(axis=1)
                at[rows], away[rows] = np.array(below)[best], d[np.arange(len(rows)), best]
                moved.append(rows)
        open_rows = np.concatenate(moved) if moved else np.zeros(0, "i8")
    return at, away


def matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype("f8") if len(column) else np.zeros((0, 0))


def located(df: DataFrame, tree, vec: str, group: str) -> DataFrame:
    """``df`` with ``__leaf`` and ``__away``; ``tree`` is a broadcast tree."""
    def run(g: pd.Series, v: pd.Series) -> pd.DataFrame:
        leaf, away = leaves(tree.value, g.to_numpy(), matrix(v))
        return pd.DataFrame({"leaf": leaf, "away": away})

    place = F.pandas_udf(run, "leaf long, away double")(F.col(group), F.col(vec))
    return df.withColumn("__place", place).select("*", F.col("__place.leaf").alias("__leaf"), F.col("__place.away").alias("__away")).drop("__place")


def build(ref: DataFrame, rid: str, vec: str, group: str, cell: int | None = None, fanout: int = FANOUT) -> Tree:
    """The tree of ``ref`` (rid, vec, group): every group has its own root."""
    spark = ref.sparkSession
    held = ref.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("d")).collect()  # one row a group
    tree = Tree()
    total, width = sum(r["n"] for r in held), max((r["d"] or 1 for r in held), default=1)
    cell = cell or max(CELL, math.ceil(4 * total * (8 * width + 64) / TREE_BYTES))
    for r in held:
        tree.roots[r[group]] = tree.add(None, r["n"])
    split = [n for n in tree.roots.values() if tree.count[n] > cell]
    while split:
        now = spark.sparkContext.broadcast(tree)
        big = spark.createDataFrame([(n,) for n in split], "__leaf long")
        rows = located(ref.select(rid, vec, group), now, vec, group).join(F.broadcast(big), "__leaf")
        drawn = rows.withColumn("__h", hash_hex(F.col(rid), "pivot"))
        rank = F.row_number().over(Window.partitionBy("__leaf").orderBy("__h", rid))  # FANOUT a node and task at most
        found = drawn.withColumn("__rn", rank).where(F.col("__rn") <= fanout).select("__leaf", vec, "__rn").collect()
        for r in sorted(found, key=lambda r: (r["__leaf"], r["__rn"])):
            pivot = np.array(r[vec], "f8")
            if not any((tree.pivots[c] == pivot).all() for c in tree.children[r["__leaf"]]):
                tree.children[r["__leaf"]].append(tree.add(pivot))
        after = spark.sparkContext.broadcast(tree)
        sizes = located(ref.select(vec, group), after, vec, group).groupBy("__leaf").agg(
            F.count(F.lit(1)).alias("n"), F.max("__away").alias("r")).collect()  # one row a leaf: bounded by TREE_BYTES
        fresh = {c for n in split for c in tree.children[n]}
        for r in sizes:
            if r["__leaf"] in fresh:
                tree.count[r["__leaf"]], tree.radius[r["__leaf"]] = r["n"], r["r"]
        for node in split:
            tree.children[node] = [c for c in tree.children[node] if tree.count[c]]
        # equal vectors can't be told apart: neither a cell of radius zero nor an only child goes on
        alone = {tree.children[n][0] for n in split if len(tree.children[n]) == 1}
        split = [c for c in sorted(fresh - alone) if tree.count[c] > cell and tree.radius[c] > 0]
        now.unpersist()
        after.unpersist()
    # a node's rows lie around its pivot: the radius found when it was a leaf holds for all rows below it
    return tree


def leaf_order(tree: Tree) -> list[tuple]:
    """(group, leaf) of every leaf, depth first: a group's leaves together, those of one parent side by side."""
    out = []
    for group, root in tree.roots.items():
        todo = [root]
        while todo:
            node = todo.pop()
            todo += reversed(tree.children[node])
            if not tree.children[node]:
                out.append((group, node))
    return out


def packed(order: list[tuple], sizes: dict, most: int) -> dict:
    """leaf -> (first block, number of blocks): leaves in a row share a block while it has at most ``most`` rows and one
    group; a leaf with more rows has blocks of its own."""
    out, block, held, of = {}, -1, 0, None
    for group, leaf in order:
        size = sizes.get(leaf, 0)
        if size > most:
            n = math.ceil(size / most)
            out[leaf], block, held = (block + 1, n), block + n, most
        elif size:
            if block < 0 or group != of or held + size > most:
                block, held = block + 1, 0
            out[leaf], held = (block, 1), held + size
        of = group
    return out


def candidates(tree: Tree, group, x: np.ndarray, k: int) -> list[int]:
    """The leaves that may hold one of the ``k`` nearest rows of any of the queries ``x`` of one group."""
    root = tree.roots.get(group)
    if root is None or not len(x):
        return []
    frontier, tau = [root], np.full(len(x), np.inf)
    while True:
        opened = [c for n in frontier for c in (tree.children[n] or [n])]
        if opened == [root]:
            return [root]
        d = distances(x, np.array([tree.pivots[n] for n in opened]))
        radius, count = np.array([tree.radius[n] for n in opened]), np.array([tree.count[n] for n in opened])
        upper = d + radius
        order = upper.argsort(axis=1)
        enough = count[order].cumsum(axis=1) >= k
        reach = np.where(enough.any(axis=1), upper[np.arange(len(x)), order[np.arange(len(x)), enough.argmax(axis=1)]], np.inf)
        tau = np.minimum(tau, reach)
        near = (d - radius <= (tau * (1 + SLACK) + SLACK)[:, None]).any(axis=0)
        kept = [n for n, good in zip(opened, near.tolist(), strict=True) if good]
        if not any(tree.children[n] for n in kept):
            return kept
        frontier = kept


def candidate_rows(tree, k: int, block: list[str]):
    """applyInPandas body for a block of queries: one row for each leaf that the block needs."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__leaf") if "__leaf" in pdf else pdf  # near queries prune together
        x, found = matrix(pdf["__qvec"]), set()
        for start in range(0, len(x), QUERIES):  # bounds the matrix of queries and nodes
            found.update(candidates(tree.value, pdf["__g"].iloc[0], x[start:start + QUERIES], k))
        out = pd.DataFrame({"__leaf": np.array(sorted(found), "i8")})
        for c in block:
            out[c] = pdf[c].iloc[0]
        return out[[*block, "__leaf"]]

    return run

