"""Bindings of attribution and scoring operators (SQL-checkable forms)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import explain as X
from tessera.operators import scoring as SC
from tessera.plans.common import rounded, table

# fixed values of the bindings: a linear score over four lineitem columns.  Sevenths
# have no short decimal expansion, so products with the 2-decimal data never sit
# exactly on a rounding boundary of the 6-digit comparison.
LINEAR_WEIGHTS = {"l_quantity": 0.15 / 7, "l_extendedprice": 1e-4 / 7, "l_discount": -22 / 7, "l_tax": 13.5 / 7}
LINEAR_INTERCEPT = -3.6 / 7
TOP_PER_ROW = 2
N_MODEL_COLUMNS = 64
MODEL_COLUMNS = [f"f{i:02d}" for i in range(N_MODEL_COLUMNS)]
SCORE_WEIGHTS = {c: ((-1.0) ** i) / (i + 1) for i, c in enumerate(MODEL_COLUMNS)}


def _line(spark, sf):
    return table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", *LINEAR_WEIGHTS)


def linear_phi(spark, sf):
    return X.shapley_linear(_line(spark, sf), ["l_orderkey", "l_linenumber"], LINEAR_WEIGHTS, LINEAR_INTERCEPT)


def q_shapley_linear(spark, sf):
    return rounded(linear_phi(spark, sf))


def q_shapley_global(spark, sf):
    return rounded(X.global_importance(linear_phi(spark, sf), top=20))


def q_top_features(spark, sf):
    top = X.top_k_linear(_line(spark, sf), ["l_orderkey", "l_linenumber"], LINEAR_WEIGHTS, TOP_PER_ROW)
    return rounded(top.select("l_orderkey", "l_linenumber", "feature", "phi", "rank"))


def _scored(spark, sf):
    e = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    e = e.withColumn("values", F.slice("embedding", 1, F.lit(N_MODEL_COLUMNS) - F.col("label")))  # ragged input rows
    aligned = SC.align_positional(e, "values", MODEL_COLUMNS, keep=["vec_id"])
    return SC.score_table(aligned, SC.linear_scorer(SCORE_WEIGHTS))


def q_align_named(spark, sf):
    """Named rows as they come to a scorer: some model columns missing, others as text, extra ones."""
    e = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    odd = {c: F.get("embedding", F.lit(i)) for i, c in enumerate(MODEL_COLUMNS) if i % 3}
    odd[MODEL_COLUMNS[1]] = F.when(F.col("label") > 4, odd[MODEL_COLUMNS[1]].cast("string")).otherwise("n/a")
    named = e.select("vec_id", "label", *[v.alias(c) for c, v in odd.items()])
    scored = SC.score_table(SC.align_named(named, MODEL_COLUMNS, keep=["vec_id"]), SC.linear_scorer(SCORE_WEIGHTS))
    return rounded(scored.select("vec_id", "score", "prediction", "label_text"))


def q_align_score(spark, sf):
    return rounded(_scored(spark, sf).select("vec_id", "score", "prediction", "label_text"))


def q_score_summary(spark, sf):
    return SC.score_totals(_scored(spark, sf))


QUERIES = {
    "shapley_linear": q_shapley_linear,
    "shapley_global": q_shapley_global,
    "top_features": q_top_features,
    "align_score": q_align_score,
    "align_named": q_align_named,
    "score_summary": q_score_summary,
}

_cols = list(LINEAR_WEIGHTS)
_PHI = ("WITH m AS (SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in _cols) + " FROM lineitem),\n"
        "p AS MATERIALIZED (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, " + f"{LINEAR_INTERCEPT!r}"
        + "".join(f" + {LINEAR_WEIGHTS[c]!r} * {c}" for c in _cols) + " AS prediction, "
        + ", ".join(_cols) + " FROM lineitem),\n"
        "phi AS (" + "\nUNION ALL ".join(
            f"SELECT rid, l_orderkey, l_linenumber, prediction, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
            f"{LINEAR_WEIGHTS[c]!r} * ({c} - m_{c}) AS phi, "
            f"({LINEAR_INTERCEPT!r}" + "".join(f" + {LINEAR_WEIGHTS[k]!r} * m_{k}" for k in _cols) + ") AS base "
            "FROM p, m" for c in _cols) + ")\n")

_ALIGN = ("WITH a AS (SELECT vec_id, " + ", ".join(
    f"CASE WHEN {N_MODEL_COLUMNS} - label >= {i + 1} THEN CAST(embedding[{i + 1}] AS DOUBLE) ELSE 0.0 END AS {c}"
    for i, c in enumerate(MODEL_COLUMNS)) + " FROM embeddings),\n"
    "s AS (SELECT vec_id, 1.0 / (1.0 + exp(-(0.0" + "".join(
        f" + {SCORE_WEIGHTS[c]!r} * {c}" for c in MODEL_COLUMNS) + "))) AS score FROM a),\n"
    "t AS (SELECT vec_id, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM s)\n")

_NAMED = ("WITH s AS (SELECT vec_id, 1.0 / (1.0 + exp(-(0.0" + "".join(
    f" + {SCORE_WEIGHTS[c]!r} * " + (f"CASE WHEN label > 4 THEN CAST(embedding[{i + 1}] AS DOUBLE) ELSE 0.0 END" if i == 1
                                     else f"CAST(embedding[{i + 1}] AS DOUBLE)")
    for i, c in enumerate(MODEL_COLUMNS) if i % 3) + "))) AS score FROM embeddings),\n"
    "t AS (SELECT vec_id, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM s)\n")

ORACLE = {
    "align_named": _NAMED + f"""SELECT vec_id, round(score, 6) AS score, prediction,
  CASE WHEN prediction = 1 THEN '{SC.POSITIVE_TEXT}' ELSE '{SC.NEGATIVE_TEXT}' END AS label_text FROM t""",
    "shapley_linear": _PHI + """SELECT l_orderkey, l_linenumber, round(prediction, 6) AS prediction, feature,
  round(value, 6) AS value, round(phi, 6) AS phi, round(base, 6) AS base FROM phi""",
    "shapley_global": _PHI + """SELECT feature, round(mean_abs_phi, 6) AS mean_abs_phi,
  CAST(row_number() OVER (ORDER BY mean_abs_phi DESC, feature) AS INTEGER) AS rank
FROM (SELECT feature, avg(abs(phi)) AS mean_abs_phi FROM phi GROUP BY feature) g""",
    "top_features": _PHI + f"""SELECT l_orderkey, l_linenumber, feature, round(phi, 6) AS phi, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY abs(phi) DESC, feature) AS INTEGER)
    AS rank FROM phi) WHERE rank <= {TOP_PER_ROW}""",
    "align_score": _ALIGN + f"""SELECT vec_id, round(score, 6) AS score, prediction,
  CASE WHEN prediction = 1 THEN '{SC.POSITIVE_TEXT}' ELSE '{SC.NEGATIVE_TEXT}' END AS label_text FROM t""",
    "score_summary": _ALIGN + """SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count_if(prediction = 1) AS BIGINT) AS disease_count FROM t""",
}
