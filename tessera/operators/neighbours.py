"""Exact k-nearest neighbours without an all-pairs join, and the kNN vote.

1. ``metric_tree.build`` splits the references into cells below pivots of pivots, with a radius and a count at
   each node; its size is bounded in bytes, and so is what is broadcast.
2. Rows go down the tree to their own leaf; neighbouring leaves share a block (``block_rows``: about BLOCKS
   on either side, of bounded size), so their number doesn't grow with the number of cells.  Each block of
   queries descends the tree, with an upper bound of every query's k-th distance, and names the leaves that can hold a
   neighbour: rows are (block, block), never (query, pivot).
3. Two blocks meet in ``cogroup().applyInPandas``: a matrix product leaves out the pairs that are too far
   (``k_best``), exact distances decide on the others, only the k best per query leave it.  Then
   ``row_number() <= k`` per query keeps the global k nearest; Spark plans this
   as a window group limit, taking partial top-k before the shuffle.

In high dimensions distances concentrate and the bounds may prune little; the
work then is a blocked all-pairs computation, but pair rows are still never
materialised and every block is bounded.

Distances are squared Euclidean on doubles, rounded to 9 digits for ordering;
ties go to the smaller id.  They are computed by Arrow-batched numpy UDFs
(higher-order SQL lambdas run without code generation and were ~20x slower);
the per-pair sum keeps the sequential order of the SQL form, so both give the
same doubles.  The tree's bounds use a tiny relative slack so
that rounding in the bound can never drop a true neighbour.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import metric_tree
from tessera.session import cut_lineage

DIST_DIGITS = 9


def sq_dist(a, b) -> Column:
    """Squared Euclidean distance as a SQL expression (sequential sum over dimensions)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    diffs = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def _matrix(s: pd.Series) -> np.ndarray:
    if len(s) == 0:
        return np.zeros((0, 0))
    return np.vstack(s.to_numpy()).astype(np.float64)


def _sq_dist_batch(a: pd.Series, b: pd.Series) -> pd.Series:
    if len(a) == 0:
        return pd.Series([], dtype="float64")
    diff = _matrix(a) - _matrix(b)
    acc = np.zeros(diff.shape[0])
    for j in range(diff.shape[1]):
        acc = acc + diff[:, j] * diff[:, j]
    return pd.Series(acc)


QUERY_BLOCK = 1024
REF_BLOCK = 4096
BLOCKS = 16  # aimed at on either side, between the sizes above and LARGEST times those
LARGEST = 8
AT_ONCE = 1 << 21  # pairs whose rough distances a task holds


def block_rows(rows: int, least: int) -> int:
    """Rows of a block: vectors are sent once for every block of the other side, so large tables have larger blocks."""
    return min(max(least, math.ceil(rows / BLOCKS)), LARGEST * least)


def k_best(qx: np.ndarray, rx: np.ndarray, qids: np.ndarray, rids: np.ndarray, k: int, exclude_self: bool = False):
    """(query row, reference row, distance) of the ``k`` nearest references of every query; ties go to the smaller id.

    A matrix product gives rough distances.  The k-th least of the minima of stripes bounds a query's k-th distance
    from above; the pairs within it (and a slack for rounding) get their exact distance, the same
    sequential sum as ``sq_dist``.  Rows with entries that aren't finite have no distances.
    """
    q_rows, r_rows = (np.flatnonzero(np.isfinite(x).all(axis=1)) for x in (qx, rx))
    qx, rx, qids, rids = qx[q_rows], rx[r_rows], qids[q_rows], rids[r_rows]
    n, found = len(rx), []
    if n and len(qx):
        with np.errstate(over="ignore", invalid="ignore"):
            q_norm, r_norm = np.einsum("ij,ij->i", qx, qx), np.einsum("ij,ij->i", rx, rx)
            rough = np.isfinite(4 * (q_norm.max() + r_norm.max()))
        q_axes, r_axes = np.ascontiguousarray(qx.T), np.ascontiguousarray(rx.T)
        kth = min(k, n)
        stripes = max(1, min(64, n // (8 * kth)))
        slack = 4e-9 + 1e-11 * (q_norm + r_norm.max())
        by_id = np.argsort(rids, kind="stable") if exclude_self else None
        step = max(1, AT_ONCE // n)
        for start in range(0, len(qx), step):
            some = slice(start, start + step)
            if rough:
                near = qx[some] @ r_axes
                near *= -2.0
                near += r_norm
                near += q_norm[some, None]
            else:  # squares overflow: every pair is summed
                near = np.zeros((len(qx[some]), n))
            if exclude_self:
                lo, hi = (np.searchsorted(rids, qids[some], side, sorter=by_id) for side in ("left", "right"))
                for i in np.flatnonzero(hi > lo).tolist():
                    near[i, by_id[lo[i]:hi[i]]] = np.inf
            least = near[:, :stripes * (n // stripes)].reshape(len(near), stripes, -1).min(axis=1)
            limit = np.partition(least, kth - 1, axis=1)[:, kth - 1] + slack[some]
            i, j = np.divmod(np.flatnonzero(near <= limit[:, None]), n)
            del near
            away = np.zeros(len(i))
            with np.errstate(over="ignore"):
                for q_axis, r_axis in zip(q_axes[:, some], r_axes, strict=True):
                    diff = q_axis[i] - r_axis[j]
                    away += diff * diff
            away = np.round(away, DIST_DIGITS)
            good = np.isfinite(away)
            if exclude_self:
                good &= qids[some][i] != rids[j]
            i, j, away = i[good], j[good], away[good]
            order = np.lexsort((rids[j], away, i))  # query, distance, id
            i, j, away = i[order], j[order], away[order]
            first = np.arange(len(i)) - np.searchsorted(i, i, "left") < k
            found.append((q_rows[start + i[first]], r_rows[j[first]], away[first]))
    if not found:
        return np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _block_top_k(k: int, exclude_self: bool, by: list[str], qid: str, rid: str):
    """cogroup body: a block of queries against a block of references; emits only each query's k best."""
    def run(qpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        cols = [*by, qid, rid, "sq_dist"]
        if len(qpdf) == 0 or len(rpdf) == 0:
            return pd.DataFrame({c: [] for c in cols})
        qids, rids = qpdf["__qid"].to_numpy(), rpdf[rid].to_numpy()
        i, j, away = k_best(_matrix(qpdf["__qvec"]), _matrix(rpdf["__rvec"]), qids, rids, k, exclude_self)
        res = pd.DataFrame({qid: qids[i], rid: rids[j], "sq_dist": away})
        for c in by:
            res[c] = qpdf[c].iloc[0]
        return res[cols]
    return run


def nearest(query: DataFrame, ref: DataFrame, k: int, qid: str = "qid", rid: str = "rid",
            vec: str = "vec", by: list[str] | None = None, exclude_self: bool = False,
            n_pivots: int | None = None) -> DataFrame:
    """(by..., qid, rid, sq_dist, rank) for the k nearest ``ref`` rows of each ``query`` row.

    ``query`` has (by..., qid, vec), ``ref`` has (by..., rid, vec); neighbours
    are searched within the same ``by`` group.  With ``exclude_self`` a ref row
    whose id equals the query id is skipped (self-neighbourhood of one table).

    ``n_pivots`` sets the number of cells aimed at (None: cells of ``metric_tree.CELL`` rows, more where
    the tree would outgrow its bound).  Ids of ``query`` are unique; null vectors aren't allowed.
    """
    by = by or []
    k_eff = k + (1 if exclude_self else 0)
    spark = ref.sparkSession
    group = F.to_json(F.struct(*[F.col(c) for c in by])) if by else F.lit("")
    # fresh attribute ids: query and ref may be the same table (self-neighbourhood)
    query = query.select(*[F.col(c).alias(c) for c in by], F.col(qid).alias("__qid"), F.col(vec).alias("__qvec"), group.alias("__g"))
    ref = ref.select(*[F.col(c).alias(c) for c in by], F.col(rid).alias(rid), F.col(vec).alias("__rvec"), group.alias("__g"))
    cell = math.ceil(ref.count() / n_pivots) if n_pivots else None
    tree = spark.sparkContext.broadcast(metric_tree.build(ref, rid, "__rvec", "__g", cell))

    # leaves that stand beside each other in the tree share a block; a full leaf is dealt into several
    order = metric_tree.leaf_order(tree.value)
    sizes = {leaf: tree.value.count[leaf] for _, leaf in order}
    packs = _blocks(spark, order, sizes, block_rows(sum(sizes.values()), REF_BLOCK))
    refs = metric_tree.located(ref, tree, "__rvec", "__g").join(F.broadcast(packs), "__leaf")
    refs = refs.withColumn("__rb", F.col("__first") + F.pmod(F.xxhash64(rid), F.col("__n")))
    near = cut_lineage(metric_tree.located(query, tree, "__qvec", "__g").where(F.col("__leaf") >= 0))
    sizes = {r["__leaf"]: r["n"] for r in near.groupBy("__leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a leaf
    blocks = _blocks(spark, order, sizes, block_rows(sum(sizes.values()), QUERY_BLOCK))
    near = near.join(F.broadcast(blocks), "__leaf").withColumn("__qb", F.col("__first") + F.pmod(F.xxhash64("__qid"), F.col("__n")))
    near = near.select(*by, "__qid", "__qvec", "__g", "__leaf", "__qb")
    needs = near.groupBy("__qb").applyInPandas(metric_tree.candidate_rows(tree, k_eff, ["__qb"]), "__qb long, __leaf long")
    needs = needs.join(F.broadcast(packs), "__leaf").select("__qb", F.explode(F.sequence("__first", F.col("__first") + F.col("__n") - 1)).alias("__rb"))
    needs = cut_lineage(needs.distinct())  # a row for each two blocks that meet

    def meeting(own: str, other: str) -> DataFrame:
        return F.broadcast(needs.groupBy(own).agg(F.collect_list(other).alias("__other")))

    key = ["__qb", "__rb"]
    qside = near.join(meeting("__qb", "__rb"), "__qb").select(*by, "__qb", F.explode("__other").alias("__rb"), "__qid", "__qvec")
    rside = refs.join(meeting("__rb", "__qb"), "__rb").select(*by, F.explode("__other").alias("__qb"), "__rb", rid, "__rvec")
    schema_by = ", ".join(f"`{c}` {query.schema[c].dataType.simpleString()}" for c in by)
    schema = ((schema_by + ", ") if by else "") + (
        f"`{qid}` {query.schema['__qid'].dataType.simpleString()}, "
        f"`{rid}` {ref.schema[rid].dataType.simpleString()}, sq_dist double")
    part = (qside.groupBy(*key).cogroup(rside.groupBy(*key))
            .applyInPandas(_block_top_k(k, exclude_self, by, qid, rid), schema))
    w = Window.partitionBy(qid).orderBy("sq_dist", rid)
    return (part.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


def _blocks(spark, order: list[tuple], sizes: dict, most: int) -> DataFrame:
    """(__leaf, __first, __n): the blocks first .. first + n - 1 of at most about ``most`` rows, one row a leaf."""
    schema = "__leaf long, __first long, __n long"
    return spark.createDataFrame([(leaf, *at) for leaf, at in metric_tree.packed(order, sizes, most).items()], schema)


def knn_vote(neigh: DataFrame, ref_labels: DataFrame, qid: str = "qid", rid: str = "rid",
             label: str = "label", digits: int = DIST_DIGITS) -> DataFrame:
    """Inverse-distance vote: weight 1/d; if any neighbour is at distance 0 only those vote.
    Highest vote (rounded) wins; ties -> the smaller label (of any orderable type).
    Returns (qid, predicted, vote, share): share of all votes, the class's probability."""
    per = label_votes(neigh, ref_labels, qid, rid, label, digits)
    best = per.groupBy(qid).agg(
        F.min_by(F.struct(F.col(label).alias("l"), "vote"), F.struct(-F.col("vote"), F.col(label))).alias("b"),
        F.sum("vote").alias("__all"))
    return best.select(qid, F.col("b.l").alias("predicted"), F.col("b.vote").alias("vote"),
                       (F.col("b.vote") / F.col("__all")).alias("share"))


def knn_share(neigh: DataFrame, ref_labels: DataFrame, positive, qid: str = "qid", rid: str = "rid",
              label: str = "label", digits: int = DIST_DIGITS) -> DataFrame:
    """(qid, score): the share of the votes that label ``positive`` has, its probability."""
    per = label_votes(neigh, ref_labels, qid, rid, label, digits)
    mine = F.sum(F.when(F.col(label) == F.lit(positive), F.col("vote")).otherwise(0.0))
    return per.groupBy(qid).agg((mine / F.sum("vote")).alias("score"))


def label_votes(neigh: DataFrame, ref_labels: DataFrame, qid: str = "qid", rid: str = "rid",
                label: str = "label", digits: int = DIST_DIGITS) -> DataFrame:
    """(qid, label, vote) of the labels among the neighbours."""
    j = neigh.join(ref_labels.select(rid, label), on=rid)
    d = F.sqrt(F.col("sq_dist"))
    per = j.groupBy(qid, label).agg(
        F.sum(F.when(d > 0, F.lit(1.0) / d)).alias("__w"),
        F.count_if(d == 0).alias("__zeros"))
    has_zero = F.max("__zeros").over(Window.partitionBy(qid)) > 0  # per query: at most k label rows
    vote = F.when(has_zero, F.col("__zeros").cast("double")).otherwise(F.coalesce("__w", F.lit(0.0)))
    return per.withColumn("vote", F.round(vote, digits)).select(qid, label, "vote")


def knn_classify(query: DataFrame, ref: DataFrame, k: int = 7, qid: str = "qid", rid: str = "rid",
                 vec: str = "vec", label: str = "label", n_pivots: int | None = None) -> DataFrame:
    """Predict each query row's label from its k nearest reference rows."""
    neigh = nearest(query.select(qid, vec), ref.select(rid, vec), k, qid, rid, vec, n_pivots=n_pivots)
    return knn_vote(neigh, ref, qid, rid, label)
