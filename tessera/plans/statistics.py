"""Bindings of metrics, curves, splits, samples, batches and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators import sampling as S
from tessera.operators.scaling import standardise
from tessera.plans.common import rounded, table

SEED = 42
TEST, VAL = 0.15, 0.15
SAMPLE_K = 100


def scored_labels(spark, sf):
    """labels join documents; score = rounded n_chars / (n_chars + 5000) (many ties)."""
    lab = table(spark, sf, "labels", "doc_id", "quality", "toxic")
    doc = table(spark, sf, "documents", "doc_id", "n_chars")
    j = lab.join(doc, on="doc_id")
    score = F.round(F.col("n_chars") / (F.col("n_chars") + F.lit(5000.0)), 2)
    return j.select("doc_id", F.col("quality").alias("y"), "toxic", score.alias("score"),
                    (score >= 0.3).cast("int").alias("pred"))


def q_confusion(spark, sf):
    return rounded(M.confusion_matrix(scored_labels(spark, sf), "y", "pred"))


def q_binary_metrics(spark, sf):
    return rounded(M.binary_metrics(scored_labels(spark, sf), "y", "pred"))


def q_log_loss(spark, sf):
    return rounded(M.log_loss(scored_labels(spark, sf), "y", "score"))


def q_roc_auc(spark, sf):
    return rounded(M.roc_auc(scored_labels(spark, sf), "y", "score"))


def q_roc_curve(spark, sf):
    return rounded(M.roc_curve(scored_labels(spark, sf), "y", "score"))


def q_youden(spark, sf):
    return rounded(M.youden(scored_labels(spark, sf), "y", "score"))


def q_pr_curve(spark, sf):
    return rounded(M.pr_curve(scored_labels(spark, sf), "y", "score"))


def q_avg_precision(spark, sf):
    return rounded(M.avg_precision(scored_labels(spark, sf), "y", "score"))


def embedding_guess(spark, sf):
    """embeddings with a rule prediction: index of the largest component, modulo the 10 labels."""
    e = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    largest = F.array_position("embedding", F.array_max("embedding")) - 1
    return e.select("vec_id", "label", (largest % 10).cast("int").alias("guess"))


def q_class_report(spark, sf):
    return rounded(M.class_report(embedding_guess(spark, sf), "label", "guess"))


def _customers(spark, sf):
    return table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")


def q_stratified_split(spark, sf):
    c = _customers(spark, sf).select("c_custkey", "c_mktsegment")
    return S.stratified_split(c, "c_custkey", "c_mktsegment", TEST, VAL, SEED)


def q_class_balance(spark, sf):
    return rounded(S.class_balance(_customers(spark, sf), "c_mktsegment"))


def q_sample_fixed(spark, sf):
    c = _customers(spark, sf).select("c_custkey", "c_mktsegment")
    return S.sample_fixed(c, "c_custkey", SAMPLE_K, SEED)


def q_batch_slice(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return S.batch_slice(o, ["o_orderdate", "o_orderkey"], 5, max_size=None).select("o_orderkey", "batch")


def q_standardise(spark, sf):
    c = S.stratified_split(_customers(spark, sf), "c_custkey", "c_mktsegment", TEST, VAL, SEED)
    z = standardise(c, ["c_acctbal", "c_nationkey"], fit_on=F.col("split") == "train", suffix="_z")
    return rounded(z.select("c_custkey", "split", "c_acctbal_z", "c_nationkey_z"))


QUERIES = {
    "confusion": q_confusion,
    "binary_metrics": q_binary_metrics,
    "log_loss": q_log_loss,
    "roc_auc": q_roc_auc,
    "roc_curve": q_roc_curve,
    "youden": q_youden,
    "pr_curve": q_pr_curve,
    "avg_precision": q_avg_precision,
    "class_report": q_class_report,
    "stratified_split": q_stratified_split,
    "class_balance": q_class_balance,
    "sample_fixed": q_sample_fixed,
    "batch_slice": q_batch_slice,
    "standardise": q_standardise,
}

# ---------------------------------------------------------------- oracle SQL

SCORED = """
sc AS (SELECT l.doc_id, l.quality AS y, l.toxic, round(d.n_chars / (d.n_chars + 5000.0), 2) AS score
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
scp AS (SELECT *, CAST(score >= 0.3 AS INTEGER) AS pred FROM sc)
"""
POINTS = """
g AS (SELECT score, CAST(count_if(y = 1) AS BIGINT) AS pos, CAST(count_if(y <> 1) AS BIGINT) AS neg FROM sc GROUP BY score),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
pts AS (SELECT score, pos, neg,
    sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
    sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
    (SELECT P FROM tot) AS P, (SELECT N FROM tot) AS N FROM g)
"""
COUNTS = """
cnt AS (SELECT CAST(count_if(y = 0 AND pred = 0) AS BIGINT) AS tn, CAST(count_if(y = 0 AND pred = 1) AS BIGINT) AS fp,
               CAST(count_if(y = 1 AND pred = 0) AS BIGINT) AS fn, CAST(count_if(y = 1 AND pred = 1) AS BIGINT) AS tp
        FROM scp),
d AS (SELECT tn, fp, fn, tp, CAST(tn AS DOUBLE) AS dtn, CAST(fp AS DOUBLE) AS dfp, CAST(fn AS DOUBLE) AS dfn,
             CAST(tp AS DOUBLE) AS dtp FROM cnt)
"""


RANK = ("row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('42|' || CAST(c_custkey AS VARCHAR)), c_custkey)")
SPLIT = f"""
r AS (SELECT c_custkey, c_mktsegment, c_acctbal, c_nationkey, {RANK} AS rn,
             count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer),
r2 AS (SELECT *, round(CAST(n AS DOUBLE) * CAST({TEST!r} AS DOUBLE)) AS nt FROM r),
r3 AS (SELECT *, round((CAST(n AS DOUBLE) - nt) * CAST({VAL / (1.0 - TEST)!r} AS DOUBLE)) AS nv FROM r2),
sp AS (SELECT *, CASE WHEN rn <= nt THEN 'test' WHEN rn <= nt + nv THEN 'val' ELSE 'train' END AS split FROM r3)
"""

EPS = 2.220446049250313e-16

ORACLE = {
    "confusion": "WITH " + SCORED + """,
cells AS (SELECT y AS actual, pred AS predicted, CAST(count(*) AS BIGINT) AS n FROM scp GROUP BY y, pred)
SELECT CAST(actual AS INTEGER) AS actual, CAST(predicted AS INTEGER) AS predicted, n,
       round(n * 100.0 / sum(n) OVER (PARTITION BY actual), 6) AS pct FROM cells""",
    "binary_metrics": "WITH " + SCORED + "," + COUNTS + """
SELECT tn, fp, fn, tp,
  round(coalesce((dtp + dtn) / nullif(dtp + dfp + dtn + dfn, 0), 0), 6) AS accuracy,
  round(coalesce(dtp / nullif(dtp + dfp, 0), 0), 6) AS precision,
  round(coalesce(dtp / nullif(dtp + dfn, 0), 0), 6) AS recall,
  round(coalesce(dtn / nullif(dtn + dfp, 0), 0), 6) AS specificity,
  round(coalesce(2.0 * dtp / nullif(2.0 * dtp + dfp + dfn, 0), 0), 6) AS f1_score,
  round((coalesce(dtp / nullif(dtp + dfn, 0), 0) + coalesce(dtn / nullif(dtn + dfp, 0), 0)) / 2.0, 6)
    AS balanced_accuracy,
  round(coalesce((dtp * dtn - dfp * dfn) / nullif(sqrt((dtp + dfp) * (dtp + dfn) * (dtn + dfp) * (dtn + dfn)), 0), 0), 6)
    AS mcc,
  round(coalesce((po - pe) / nullif(1.0 - pe, 0), 0), 6) AS cohen_kappa
FROM (SELECT *, (dtp + dtn) / (dtp + dfp + dtn + dfn) AS po,
        ((dtp + dfp) * (dtp + dfn) + (dtn + dfn) * (dtn + dfp)) / ((dtp + dfp + dtn + dfn) * (dtp + dfp + dtn + dfn)) AS pe
      FROM d)""",
    "log_loss": "WITH " + SCORED + f"""
SELECT round(avg(-(y * ln(p) + (1.0 - y) * ln(1.0 - p))), 6) AS log_loss
FROM (SELECT CAST(y AS DOUBLE) AS y, least(greatest(score, {EPS!r}), {1.0 - EPS!r}) AS p FROM sc)""",
    "roc_auc": "WITH " + SCORED + """,
g AS (SELECT score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM sc GROUP BY score),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS below FROM g)
SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
  sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0))
  / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END, 6) AS auc FROM c""",
    "roc_curve": "WITH " + SCORED + "," + POINTS + """
SELECT round(score, 6) AS threshold, round(coalesce(CAST(fp AS DOUBLE) / nullif(N, 0), 0), 6) AS fpr,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0), 6) AS tpr FROM pts""",
    "youden": "WITH " + SCORED + "," + POINTS + """,
cur AS (SELECT score AS threshold, coalesce(CAST(fp AS DOUBLE) / nullif(N, 0), 0) AS fpr,
               coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0) AS tpr FROM pts)
SELECT round(threshold, 6) AS threshold, round(round(tpr - fpr, 9), 6) AS youden_j, round(tpr, 6) AS tpr,
       round(fpr, 6) AS fpr
FROM cur ORDER BY round(tpr - fpr, 9) DESC, threshold DESC LIMIT 1""",
    "pr_curve": "WITH " + SCORED + "," + POINTS + """
SELECT round(score, 6) AS threshold, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0), 6) AS recall FROM pts""",
    "avg_precision": "WITH " + SCORED + "," + POINTS + """
SELECT round(sum(coalesce(CAST(pos AS DOUBLE) / nullif(P, 0), 0) * coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)), 6)
  AS avg_precision FROM pts""",
    "class_report": """WITH e AS (SELECT vec_id, CAST(label AS VARCHAR) AS y,
      CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS VARCHAR) AS p FROM embeddings),
pairs AS (SELECT y, p, count(*) AS n FROM e GROUP BY y, p),
ts AS (SELECT y AS cls, sum(n) AS support, sum(CASE WHEN y = p THEN n END) AS tp FROM pairs GROUP BY y),
ps AS (SELECT p AS cls, sum(n) AS predicted FROM pairs GROUP BY p),
per AS (SELECT coalesce(ts.cls, ps.cls) AS cls, CAST(coalesce(support, 0) AS BIGINT) AS support,
               CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(predicted, 0) AS BIGINT) AS predicted
        FROM ts FULL JOIN ps ON ts.cls = ps.cls),
m AS (SELECT cls, support, tp, coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), 0) AS precision,
             coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS recall,
             coalesce(2.0 * tp / nullif(predicted + support, 0), 0) AS f1_score FROM per),
t AS (SELECT sum(support) AS support, sum(tp) AS tp, avg(precision) AS m_p, avg(recall) AS m_r, avg(f1_score) AS m_f,
             sum(precision * support) AS w_p, sum(recall * support) AS w_r, sum(f1_score * support) AS w_f FROM m)
SELECT cls AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
       support FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, round(coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0), 6),
       CAST(support AS BIGINT) FROM t
UNION ALL SELECT 'macro avg', round(m_p, 6), round(m_r, 6), round(m_f, 6), CAST(support AS BIGINT) FROM t
UNION ALL SELECT 'weighted avg', round(coalesce(w_p / nullif(support, 0), 0), 6),
       round(coalesce(w_r / nullif(support, 0), 0), 6), round(coalesce(w_f / nullif(support, 0), 0), 6),
       CAST(support AS BIGINT) FROM t""",
    "stratified_split": "WITH " + SPLIT + "SELECT c_custkey, c_mktsegment, split FROM sp",
    "class_balance": """WITH c AS (SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY c_mktsegment)
SELECT c_mktsegment, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share,
       round(CAST(min(n) OVER () AS DOUBLE) / max(n) OVER (), 6) AS balance_ratio FROM c""",
    "sample_fixed": f"""SELECT c_custkey, c_mktsegment FROM (SELECT c_custkey, c_mktsegment,
    row_number() OVER (ORDER BY md5('42|s|' || CAST(c_custkey AS VARCHAR)), c_custkey) AS rn FROM customer)
  WHERE rn <= {SAMPLE_K}""",
    "batch_slice": """WITH b AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn,
      (SELECT count(*) FROM orders) // 5 AS size FROM orders)
SELECT o_orderkey, CAST(floor((rn - 1) / size) + 1 AS INTEGER) AS batch FROM b WHERE floor((rn - 1) / size) + 1 <= 5""",
    "standardise": "WITH " + SPLIT + """,
st AS (SELECT avg(CAST(c_acctbal AS DOUBLE)) AS ma, stddev_pop(CAST(c_acctbal AS DOUBLE)) AS sa,
              avg(CAST(c_nationkey AS DOUBLE)) AS mn, stddev_pop(CAST(c_nationkey AS DOUBLE)) AS sn
       FROM sp WHERE split = 'train')
SELECT c_custkey, split,
  round((c_acctbal - ma) / CASE WHEN sa > 0 THEN sa ELSE 1.0 END, 6) AS c_acctbal_z,
  round((c_nationkey - mn) / CASE WHEN sn > 0 THEN sn ELSE 1.0 END, 6) AS c_nationkey_z
FROM sp, st""",
}
