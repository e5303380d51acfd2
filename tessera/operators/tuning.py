"""Hyper-parameter search as a trial table.

The search space is the unit cube, one side a parameter: ``space_of`` maps uniforms to parameters by
column expressions.  ``search_space`` draws them as ``hash_u(trial, parameter)``, so that any engine can
repeat the table.  ``propose`` draws a next batch from the trials so far: by parameter, Parzen
densities of the good and of the other trials, and of CANDIDATES draws from the good one the draw whose
ratio is greatest.

``tune_gbt`` fits all trials of a batch in one Spark job (``boosting.fit_trials``) and evaluates them by
grouped aggregates over (trial, label, score); the best is a ``min_by``, refit by ``refit_best``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_u
from tessera.operators import boosting
from tessera.operators import metrics as M
from tessera.session import cut_lineage

# fixed values: the search space of the boosted-tree tuning
TREES_CHOICES = [100, 150, 200, 300, 400, 500]
DEPTH_RANGE = (3, 12)
RATE_LOG_RANGE = (0.005, 0.3)
SUBSAMPLE_RANGE = (0.5, 1.0)
COLSAMPLE_RANGE = (0.5, 1.0)
MIN_CHILD_RANGE = (1, 20)
GAMMA_RANGE = (0.0, 5.0)
REG_LOG_RANGE = (1e-8, 10.0)
N_TRIALS = 50


#: Tags of the uniforms, one a parameter.
TAGS = ["trees", "depth", "rate", "subsample", "colsample", "child", "gamma", "alpha", "lambda"]
PARAMS = ["n_trees", "max_depth", "learning_rate", "subsample", "colsample", "min_child", "gamma", "reg_alpha", "reg_lambda"]
GOOD_SHARE = 0.15
CANDIDATES = 24


def space_of(u: dict) -> list:
    """The parameter columns of uniforms by tag (choice, quniform, loguniform, uniform)."""
    def within(tag, low, high):
        return F.lit(low) + u[tag] * (high - low)

    def logs(tag, low, high):
        return F.exp(within(tag, math.log(low), math.log(high)))

    trees = F.element_at(F.array(*[F.lit(x) for x in TREES_CHOICES]),
                         F.least(F.floor(u["trees"] * len(TREES_CHOICES)) + 1, F.lit(len(TREES_CHOICES))).cast("int"))
    return [trees.alias("n_trees"), F.round(within("depth", *DEPTH_RANGE)).cast("int").alias("max_depth"), logs("rate", *RATE_LOG_RANGE).alias("learning_rate"),
            within("subsample", *SUBSAMPLE_RANGE).alias("subsample"), within("colsample", *COLSAMPLE_RANGE).alias("colsample"),
            F.round(within("child", *MIN_CHILD_RANGE)).cast("int").alias("min_child"), within("gamma", *GAMMA_RANGE).alias("gamma"),
            logs("alpha", *REG_LOG_RANGE).alias("reg_alpha"), logs("lambda", *REG_LOG_RANGE).alias("reg_lambda")]


def search_space(spark: SparkSession, n_trials: int = N_TRIALS, seed: int = 42, first: int = 0) -> DataFrame:
    """One row per trial with the sampled parameters and their uniforms."""
    t = spark.range(first, n_trials).withColumnRenamed("id", "trial")
    u = {tag: hash_u(F.col("trial"), tag, seed) for tag in TAGS}
    return t.select("trial", *space_of(u), F.array(*u.values()).alias("uniforms"))


def _log_density(at: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Log of a Parzen density on [0, 1]: normal windows around the centres (reflected at the ends) and one uniform part."""
    width = max(1.0 / (1 + len(centres)), 0.03)
    mirrored = np.concatenate((centres, -centres, 2 - centres))
    windows = np.exp(-0.5 * ((at[:, None] - mirrored) / width) ** 2).sum(axis=1) / (width * math.sqrt(2 * math.pi))
    return np.log((windows + 1.0) / (len(centres) + 1.0))


def propose(uniforms: np.ndarray, loss: np.ndarray, count: int, seed: int) -> np.ndarray:
    """``count`` new points of the unit cube from the points tried so far and their losses (a trial table: few rows)."""
    rng = np.random.default_rng(seed)
    order = np.argsort(loss, kind="stable")
    best = order[:max(2, math.ceil(GOOD_SHARE * len(order)))]
    rest = np.setdiff1d(order, best)
    out = np.empty((count, uniforms.shape[1]))
    for j in range(uniforms.shape[1]):
        good, bad = uniforms[best, j], uniforms[rest, j]
        width = max(1.0 / (1 + len(good)), 0.03)
        drawn = rng.choice(good, (count, CANDIDATES)) + width * rng.standard_normal((count, CANDIDATES))
        drawn = np.abs(drawn)
        drawn = np.clip(np.where(drawn > 1, 2 - drawn, drawn), 0.0, 1.0)
        wild = rng.random((count, CANDIDATES)) < 1.0 / (1 + len(good))
        drawn = np.where(wild, rng.random((count, CANDIDATES)), drawn)
        flat = drawn.ravel()
        ratio = (_log_density(flat, good) - _log_density(flat, bad)).reshape(drawn.shape)
        out[:, j] = drawn[np.arange(count), ratio.argmax(axis=1)]
    return out


def proposed_space(spark: SparkSession, points: np.ndarray, first: int) -> DataFrame:
    rows = spark.createDataFrame([(first + i, [float(x) for x in p]) for i, p in enumerate(points)], "trial long, uniforms array<double>")
    u = {tag: F.col("uniforms")[i] for i, tag in enumerate(TAGS)}
    return rows.select("trial", *space_of(u), "uniforms")


TRIAL_METRICS = ["auc", "accuracy", "f1_score", "precision", "recall", "mcc", "log_loss"]


def tune_gbt(train: DataFrame, val: DataFrame, width: int, label: str = "label", features: str = "features",
             n_trials: int = N_TRIALS, seed: int = 42, batch: int | None = None) -> DataFrame:
    """The trial table with seven metrics on ``val``, ``fit_seconds`` and loss = 1 - AUC.

    Without ``batch`` all trials come from the hashed table and run in one job.  With it they run ``batch`` at
    a time, and every batch after the first is proposed by ``propose`` from those before.  Bins come from all
    rows of ``train``; every trial is fitted on all of them and compared on all rows of ``val``, which are coded once.
    """
    spark = train.sparkSession
    edges = boosting.bin_edges(train, width, features)
    coded = [boosting.coded_rows(t, edges, label, features) for t in (train, val)]
    step, done, out = batch or n_trials, 0, None
    while done < n_trials:
        size = min(step, n_trials - done)
        if out is None:
            space = search_space(spark, size, seed)
        else:
            known = out.select("uniforms", F.coalesce("loss", F.lit(1.0)).alias("loss")).orderBy("trial").collect()  # the trials so far
            points = propose(np.array([r["uniforms"] for r in known]), np.array([r["loss"] for r in known]), size, seed + done)
            space = proposed_space(spark, points, done)
        scored = boosting.fit_trials(space, train, val, width, label, features, edges, seed, coded)
        marked = scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
        found = M.evaluate(marked, "label", "prediction", "score", ["trial"]).select("trial", *TRIAL_METRICS)
        spent = scored.groupBy("trial").agg(F.first("fit_seconds").alias("fit_seconds"))
        made = space.join(found, on="trial").join(spent, on="trial").withColumn("loss", F.lit(1.0) - F.col("auc"))
        out = cut_lineage(made if out is None else out.unionByName(made))
        done += size
    return out


def best_params(trials: DataFrame) -> dict:
    """Parameters of the trial with the lowest loss (ties: lowest trial id)."""
    row = trials.agg(F.min_by(F.struct("*"), F.struct("loss", "trial")).alias("b")).first()["b"]
    return row.asDict()


def refit_best(train: DataFrame, trials: DataFrame, width: int, label: str = "label", features: str = "features",
               seed: int = 42) -> boosting.Forest:
    """The best trial's parameters, fitted again on all rows."""
    best = best_params(trials)
    return boosting.fit_boosted(train, width, {p: float(best[p]) for p in PARAMS}, label, features, seed=seed)
