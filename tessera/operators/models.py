"""Classifiers on Spark ML, evaluated with the metric operators.

The reference's five learners map to Spark ML estimators (or, for the RBF
SVM, to random Fourier features + a linear SVM + a Platt logistic layer, so
no row cap is needed).  Every fitted model exposes ``transform`` giving a
``prediction`` and a positive-class ``score`` column, so all of them share
the same evaluation path.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import metrics as M

# fixed values: default hyper-parameters of the five learners
GBT_DEFAULTS = dict(maxIter=200, maxDepth=5, stepSize=0.1, subsamplingRate=0.8,
                    featureSubsetStrategy="0.8", minInstancesPerNode=10)
TREE_DEFAULTS = dict(maxDepth=10, minInstancesPerNode=5)
MLP_HIDDEN = [256, 128, 64]
MLP_DEFAULTS = dict(maxIter=30, blockSize=4096, stepSize=1e-3)
SVM_DEFAULTS = dict(C=1.0, n_components=256)
SEED = 42


def features_vector(df: DataFrame, features, out: str = "features") -> DataFrame:
    """A ``VectorUDT`` column from an array column name or from a list of numeric columns."""
    if isinstance(features, str):
        return df.withColumn(out, array_to_vector(F.transform(features, lambda x: x.cast("double"))))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


@dataclass
class FittedModel:
    name: str
    model: object
    fit_seconds: float
    params: dict = field(default_factory=dict)
    pre: object = None  # optional feature map applied before the model

    def transform(self, df: DataFrame) -> DataFrame:
        x = self.pre(df) if self.pre is not None else df
        out = self.model.transform(x)
        if "probability" in out.columns:
            score = vector_to_array("probability")[1]
        else:
            score = F.col("prediction")
        return out.withColumn("score", score.cast("double")).withColumn(
            "prediction", F.col("prediction").cast("int"))

    def feature_importances(self, names: list[str]) -> list[tuple[str, float]]:
        m = self.model.stages[-1] if isinstance(self.model, PipelineModel) else self.model
        imp = getattr(m, "featureImportances", None)
        if imp is None:
            return []
        arr = imp.toArray()
        return [(n, float(arr[i])) for i, n in enumerate(names)]


ROWS_PER_PARTITION = 500_000
LEAST_ROWS = 1_000


def training_input(df: DataFrame) -> DataFrame:
    """Persist the training rows once (iterative learners scan them every
    iteration), in as many partitions as the session has cores, fewer where a task would
    have less than ``LEAST_ROWS`` rows: empty tasks only add overhead to every iteration.  What is persisted
    keeps the session's shuffle partitions (adaptive coalescing shows in ``df.rdd`` only), so it is always coalesced."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        return df  # the caller's, persisted once for many fits
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, math.ceil(n / LEAST_ROWS)), math.ceil(n / ROWS_PER_PARTITION))
    return df.coalesce(parts).persist()


def _fit(name: str, estimator, train: DataFrame, params: dict, pre=None) -> FittedModel:
    t0 = time.time()
    given = pre(train) if pre is not None else train
    x = training_input(given)
    try:
        model = estimator.fit(x)
    finally:
        if x is not given:
            x.unpersist()
    return FittedModel(name, model, time.time() - t0, params, pre)


def fit_gbt(train: DataFrame, label: str = "label", features: str = "features", **kw) -> FittedModel:
    p = {**GBT_DEFAULTS, **kw}
    est = GBTClassifier(labelCol=label, featuresCol=features, seed=SEED, **p)
    return _fit("gbt", est, train, p)


def fit_tree(train: DataFrame, label: str = "label", features: str = "features", **kw) -> FittedModel:
    p = {**TREE_DEFAULTS, **kw}
    est = DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=SEED, **p)
    return _fit("tree", est, train, p)


def fit_mlp(train: DataFrame, n_features: int, label: str = "label", features: str = "features",
            n_classes: int = 2, **kw) -> FittedModel:
    p = {**MLP_DEFAULTS, **kw}
    layers = [n_features, *MLP_HIDDEN, n_classes]
    est = MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=layers, seed=SEED, **p)
    return _fit("mlp", est, train, {**p, "layers": layers})


def rbf_gamma_scale(train: DataFrame, features: str, n_features: int) -> float:
    """gamma = 1 / (n_features * variance of all feature values): one aggregate."""
    arr = vector_to_array(features)
    row = train.agg(F.sum(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)).alias("s"),
                    F.sum(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x)).alias("ss"),
                    F.count(F.lit(1)).alias("n")).first()
    cnt = row["n"] * n_features
    if not cnt:
        return 1.0
    mean = row["s"] / cnt
    var = row["ss"] / cnt - mean * mean
    return 1.0 / (n_features * var) if var > 0 else 1.0


def random_fourier_map(n_features: int, gamma: float, n_components: int, seed: int = SEED,
                       features: str = "features", out: str = "rff"):
    """z_j = sqrt(2/m) cos(w_j . x + b_j), w ~ N(0, 2 gamma I), b ~ U[0, 2 pi) (Rahimi-Recht 2007).

    ``W`` and ``b`` are a fixed, seeded parameter of m x d numbers (a literal in
    the plan); the map itself is a JVM array expression per row.
    """
    rng = np.random.RandomState(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, n_features))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)

    def rff_batch(v: pd.Series) -> pd.Series:  # one matrix product per Arrow batch
        if len(v) == 0:
            return pd.Series([], dtype=object)
        x = np.vstack(v.to_numpy()).astype(np.float64)
        return pd.Series(list(scale * np.cos(x @ w.T + b)))

    def apply(df: DataFrame) -> DataFrame:
        rff = F.pandas_udf(rff_batch, "array<double>")
        return df.withColumn(out, array_to_vector(rff(vector_to_array(features))))
    return apply


def fit_svm_rff(train: DataFrame, n_features: int, label: str = "label", features: str = "features",
                **kw) -> FittedModel:
    """RBF-kernel SVM analogue: RFF map -> LinearSVC -> Platt logistic layer on the margin."""
    p = {**SVM_DEFAULTS, **kw}
    gamma = rbf_gamma_scale(train, features, n_features)
    rff = random_fourier_map(n_features, gamma, p["n_components"], features=features)
    n = max(train.count(), 1)
    svc = LinearSVC(labelCol=label, featuresCol="rff", rawPredictionCol="svm_raw", predictionCol="svm_pred",
                    regParam=1.0 / (p["C"] * n), maxIter=100)
    platt = LogisticRegression(labelCol=label, featuresCol="margin", maxIter=100)
    return _fit("svm_rff", MarginPlatt(svc, platt), train, {**p, "gamma": gamma}, pre=rff)


class MarginPlatt:
    """Fits the margin classifier, then the logistic layer on its margin.

    Models are used without their training summaries: a summary holds the training table and its
    session, which tasks would have to serialise with the model.
    """

    def __init__(self, svc: LinearSVC, platt: LogisticRegression):
        self.svc, self.platt = svc, platt

    def fit(self, x: DataFrame) -> PipelineModel:
        margin = self.svc.fit(x).copy()  # copies leave the summary out
        to_margin = MarginToVector()
        layer = self.platt.fit(to_margin.transform(margin.transform(x)).select(self.platt.getLabelCol(), "margin"))
        layer._java_obj.setSummary(x.sparkSession._jvm.scala.Option.empty())
        return PipelineModel([margin, to_margin, layer])


class MarginToVector(Transformer):
    """Pipeline stage: the SVM margin (raw score of class 1) as a 1-d feature vector."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("margin", array_to_vector(F.array(vector_to_array("svm_raw")[1])))


def evaluate_model(model: FittedModel, data: DataFrame, label: str = "label",
                   by: list[str] | None = None) -> DataFrame:
    """Metric rows (one per ``by`` group): counts, ratios, AUC, log loss, average
    precision, fit time.  The narrow scored table (label, prediction, score) is
    persisted once, so inference runs once for all metric aggregations; the
    result (one row per group) is materialised before the cache is released."""
    by = by or []
    scored = model.transform(data).select(*by, label, "prediction", "score").persist()
    try:
        row = M.evaluate(scored, label, "prediction", "score", by)
        row = row.withColumns({"model": F.lit(model.name), "fit_seconds": F.lit(round(model.fit_seconds, 3))})
        rows = row.collect()  # one row per group
        return data.sparkSession.createDataFrame(rows, row.schema)
    finally:
        scored.unpersist()


def importance_table(spark, model: FittedModel, names: list[str], top: int | None = 20) -> DataFrame:
    """(feature, importance, rank) of a tree model; the vector has one entry per
    feature, so this small table is built from the fitted model on the driver."""
    rows = model.feature_importances(names)
    df = spark.createDataFrame(rows, "feature string, importance double")
    from pyspark.sql import Window
    ranked = df.withColumn("rank", F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature")))
    return ranked.where(F.col("rank") <= top) if top else ranked
