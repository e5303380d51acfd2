"""Feature attributions as Spark jobs.

* ``shapley_linear`` - exact Shapley values of a linear score with
  independent features: phi_j = w_j * (x_j - mean_j), base = f(mean).
* ``shapley_sampled`` - permutation-sampled Shapley values
  (Strumbelj & Kononenko 2014) of any fitted model: every (row, permutation)
  becomes a path of d + 1 hybrid rows from a hashed background row, scored by
  one ``transform``; phi = mean difference per (row, feature).
* ``global_importance`` - mean |phi| per feature, ranked.
* ``top_k_per_row`` - the k largest |phi| of each row.
* ``local_surrogate`` - perturb around a row, weight by proximity and fit a
  weighted ridge per explained row (a small numpy solve per group in
  ``applyInPandas``; the group size is the perturbation count, a parameter).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import DEFAULT_SEED, hash_u


def shapley_linear(df: DataFrame, id_cols: list[str], weights: dict[str, float], intercept: float = 0.0,
                   means: dict[str, float] | None = None) -> DataFrame:
    """Long (ids..., feature, value, phi) plus ``base`` and ``prediction`` per row."""
    feats = list(weights)
    if means is None:
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in feats]).first()
        means = {c: row[c] for c in feats}
    base = intercept + sum(weights[c] * (means[c] or 0.0) for c in feats)
    pred = F.lit(intercept)
    for c in feats:
        pred = pred + F.lit(weights[c]) * F.col(c).cast("double")
    wide = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in feats], pred.alias("prediction"))
    long = wide.unpivot([*id_cols, "prediction"], feats, "feature", "value")
    w_map = F.create_map(*[F.lit(x) for c in feats for x in (c, float(weights[c]))])
    m_map = F.create_map(*[F.lit(x) for c in feats for x in (c, float(means[c] or 0.0))])
    phi = w_map[F.col("feature")] * (F.col("value") - m_map[F.col("feature")])
    return long.withColumns({"phi": phi, "base": F.lit(base)})


def global_importance(phi: DataFrame, feature: str = "feature", top: int | None = 20) -> DataFrame:
    """(feature, mean_abs_phi, rank) - rank 1 is the most important; ties by name."""
    g = phi.groupBy(feature).agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    w = Window.orderBy(F.col("mean_abs_phi").desc(), F.col(feature))  # one row per feature
    out = g.withColumn("rank", F.row_number().over(w))
    return out.where(F.col("rank") <= top) if top else out


def top_k_linear(df: DataFrame, id_cols: list[str], weights: dict[str, float], k: int = 15,
                 means: dict[str, float] | None = None) -> DataFrame:
    """(ids..., feature, phi, rank) of each row's ``k`` largest |phi| of a linear score; ties by name.

    Ranked inside the row: nothing is shuffled, and rows may share their ids.
    """
    if means is None:
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in weights]).first()
        means = {c: row[c] for c in weights}
    every = []
    for c, w in weights.items():
        phi = F.lit(float(w)) * (F.col(c).cast("double") - F.lit(float(means[c] or 0.0)))
        every.append(F.struct((-F.abs(phi)).alias("order"), F.lit(c).alias("feature"), phi.alias("phi")))
    best = F.slice(F.array_sort(F.array(*every)), 1, k)
    ranked = df.select(*id_cols, F.posexplode(best).alias("rank", "best"))
    return ranked.select(*id_cols, "best.feature", "best.phi", (F.col("rank") + 1).alias("rank"))


def top_k_per_row(phi: DataFrame, id_cols: list[str], k: int = 15, feature: str = "feature") -> DataFrame:
    w = Window.partitionBy(*id_cols).orderBy(F.abs("phi").desc(), F.col(feature))
    return phi.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


HYBRIDS_AT_ONCE = 2_048


def _hybrids(seed: int, n_features: int):
    """mapInArrow body: for each (row, permutation) the d + 1 hybrids of its path.

    Hybrid i has the row's values in the first i features of the permutation and the background's in the
    others, so it is "with" the feature placed last (``__plus``) and "without" the one placed next (``__minus``):
    d + 1 vectors give all d differences.  The permutation comes from a generator seeded by (seed, row id,
    permutation), so it does not depend on partitioning.  A batch has about HYBRIDS_AT_ONCE vectors, whatever came in.
    """
    d = n_features
    step = max(1, HYBRIDS_AT_ONCE // (d + 1))
    placed = np.tril(np.ones((d + 1, d), bool), -1)  # row i: the first i places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                rids, ps = part.column("__rid"), part.column("__p").to_pylist()
                xs, zs = (np.array(part.column(c).to_pylist(), "f8") for c in ("__x", "__z"))
                n = part.num_rows
                vecs = np.empty((n, d + 1, d))
                plus, minus = np.full((n, d + 1), -1), np.full((n, d + 1), -1)
                for i, rid in enumerate(rids.to_pylist()):
                    rng = np.random.default_rng([seed, rid & 0xFFFFFFFF, (rid >> 32) & 0xFFFFFFFF, ps[i]])
                    order = rng.permutation(d)
                    plus[i, 1:], minus[i, :-1] = order, order
                    mine = np.empty((d + 1, d), bool)
                    mine[:, order] = placed
                    vecs[i] = np.where(mine, xs[i], zs[i])
                ends = np.arange(0, vecs.size + 1, d, dtype="i4")
                yield pa.RecordBatch.from_arrays(
                    [rids.take(pa.array(np.repeat(np.arange(n), d + 1))), pa.array(plus.ravel()), pa.array(minus.ravel()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(vecs.ravel()))], ["__rid", "__plus", "__minus", "__v"])

    return run


def shapley_sampled(model, rows: DataFrame, background: DataFrame, id_col: str, vec_col: str,
                    n_features: int, n_perm: int = 8, seed: int = DEFAULT_SEED,
                    features_col: str = "features") -> DataFrame:
    """(id, feature, phi) by permutation sampling.

    ``model`` has ``transform(df)`` adding ``score`` from a vector column
    ``features_col``.  Background row of (row, permutation) = background
    member of index hash(row|perm) mod n_background (equi-join on index).
    Per (row, permutation) the "with" minus "without" differences add up to
    f(row) - f(background), so phi sums to f(row) - mean f(background).
    """
    from pyspark.ml.functions import array_to_vector
    from tessera.operators.sampling import hash_rank

    bg = hash_rank(background.select(F.col(id_col).alias("__bid"), F.col(vec_col).alias("__z")),
                   "__bid", name="__bidx", tag="bg")
    n_bg = bg.count()
    perms = rows.select(F.col(id_col).alias("__rid"), F.col(vec_col).alias("__x"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))).alias("__p"))
    key = F.concat_ws("|", F.col("__rid").cast("string"), F.col("__p").cast("string"))
    perms = perms.withColumn("__bidx", (F.pmod(F.floor(hash_u(key, "bgpick", seed) * F.lit(4294967296.0))
                                               .cast("long"), F.lit(n_bg)) + 1))
    perms = perms.join(bg.select("__bidx", "__z"), on="__bidx").select("__rid", "__p", "__x", "__z")
    # the permutations of a row in one task: their differences are added up before the shuffle
    perms = perms.repartition("__rid")
    id_type = rows.schema[id_col].dataType.simpleString()
    paths = perms.mapInArrow(_hybrids(seed, n_features), f"__rid {id_type}, __plus long, __minus long, __v array<double>")
    scored = model.transform(paths.withColumn(features_col, array_to_vector("__v")).drop("__v"))
    ends = F.array(F.struct(F.col("__plus").alias("j"), F.col("score").alias("s")),
                   F.struct(F.col("__minus").alias("j"), (-F.col("score")).alias("s")))
    parts = scored.select("__rid", F.explode(ends).alias("e")).select("__rid", F.col("e.j").alias("__j"), F.col("e.s").alias("__s"))
    phi = parts.where("__j >= 0").groupBy("__rid", "__j").agg((F.sum("__s") / n_perm).alias("phi"))
    return phi.select(F.col("__rid").alias(id_col), F.col("__j").alias("feature"), "phi")


def _perturb(seed: int, n_samples: int, scale: np.ndarray, id_type: str):
    """mapInPandas body: n_samples gaussian perturbations x + scale * noise per row,
    from a generator seeded by (seed, row id) - partition-independent."""
    def run(it):
        for pdf in it:
            for rid, x in zip(pdf["__rid"].to_numpy(), pdf["__x"].to_numpy()):
                r = int(rid)
                rng = np.random.default_rng([seed, r & 0xFFFFFFFF, (r >> 32) & 0xFFFFFFFF])
                noise = rng.standard_normal((n_samples, len(scale)))
                xp = np.asarray(x, dtype=np.float64)[None, :] + noise * scale[None, :]
                yield pd.DataFrame({"__rid": np.full(n_samples, r), "__noise": list(noise), "__xp": list(xp)})
    return run, f"__rid {id_type}, __noise array<double>, __xp array<double>"


def local_surrogate(model, rows: DataFrame, id_col: str, vec_col: str, n_features: int,
                    scale: list[float], n_samples: int = 1000, top: int = 15, alpha: float = 1.0,
                    seed: int = DEFAULT_SEED, features_col: str = "features") -> DataFrame:
    """Weighted ridge around each row: (id, feature, coef, rank) for the top features by |coef|.

    Perturbations x' = x + std * N(0, 1) in standardised units; proximity
    weight exp(-|noise|^2 / width^2) with width = 0.75 sqrt(d); one weighted
    ridge solve per explained row over its ``n_samples`` perturbations."""
    from pyspark.ml.functions import array_to_vector

    width = 0.75 * math.sqrt(n_features)
    sc = np.asarray([float(s) if s and s > 0 else 1.0 for s in scale], dtype=np.float64)
    fn, schema = _perturb(seed, n_samples, sc, rows.schema[id_col].dataType.simpleString())
    samp = rows.select(F.col(id_col).alias("__rid"), F.col(vec_col).alias("__x")).mapInPandas(fn, schema)
    samp = samp.withColumn(features_col, array_to_vector("__xp"))
    scored = model.transform(samp)
    d2 = F.aggregate(F.col("__noise"), F.lit(0.0), lambda a, v: a + v * v)
    out = scored.select("__rid", F.col("__noise").alias("z"), F.col("score").alias("y"),
                        F.exp(-d2 / F.lit(width * width)).alias("w"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        z = np.vstack(pdf["z"].to_numpy())
        y = pdf["y"].to_numpy(dtype=float)
        w = pdf["w"].to_numpy(dtype=float)
        a = np.hstack([np.ones((z.shape[0], 1)), z])
        aw = a * w[:, None]
        reg = alpha * np.eye(a.shape[1])
        reg[0, 0] = 0.0
        coef = np.linalg.solve(a.T @ aw + reg, aw.T @ y)
        return pd.DataFrame({"__rid": pdf["__rid"].iloc[0], "feature": np.arange(z.shape[1]),
                             "coef": coef[1:], "intercept": coef[0]})

    coefs = out.groupBy("__rid").applyInPandas(
        solve, f"__rid {rows.schema[id_col].dataType.simpleString()}, feature long, coef double, intercept double")
    coefs = coefs.withColumnRenamed("__rid", id_col)
    return top_k_per_row(coefs.withColumnRenamed("coef", "phi"), [id_col], top).withColumnRenamed("phi", "coef")
