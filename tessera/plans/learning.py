"""Bindings of kNN and SMOTE on ``embeddings`` (64 floats, labels 0..9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_u
from tessera.operators.balance import smote
from tessera.operators.net import fit_net
from tessera.operators.neighbours import knn_classify, knn_share, knn_vote, nearest
from tessera.operators import metrics as MM
from tessera.operators import models as MD
from tessera.operators.explain import local_surrogate, shapley_sampled
from tessera.operators.sampling import sample_fixed, stratified_split
from tessera.operators.scaling import fit_scaler
from tessera.operators.tree_shapley import of_spark_tree, shapley_trees
from tessera.operators.tuning import N_TRIALS, PARAMS, refit_best, tune_gbt
from tessera.plans.common import rounded, table
from tessera.session import cut_lineage

QUERY_SHARE = 0.2
K_VOTE = 7
K_SMOTE = 5
N_DIM = 64
N_PERM = 8
REFIT_TRIALS = 16
REFIT_BATCH = 8
LOCAL_ROWS = 3
SURROGATE_SAMPLES = 1000


def _emb(spark, sf):
    return table(spark, sf, "embeddings", "vec_id", "embedding", "label")


def knn_sets(spark, sf):
    e = _emb(spark, sf).withColumn("__is_q", hash_u(F.col("vec_id"), "q") < QUERY_SHARE)
    query = e.where("__is_q").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"), "label")
    ref = e.where(~F.col("__is_q")).select(F.col("vec_id").alias("rid"), F.col("embedding").alias("vec"), "label")
    return query, ref


def q_knn_classify(spark, sf):
    query, ref = knn_sets(spark, sf)
    pred = knn_classify(query, ref, K_VOTE, "qid", "rid", "vec", "label")
    out = pred.join(query.select("qid", "label"), on="qid")
    return rounded(out.select(F.col("qid").alias("vec_id"), "label", "predicted", "vote", F.col("share").alias("score")))


def q_smote(spark, sf):
    syn = smote(_emb(spark, sf), "vec_id", "label", "embedding", K_SMOTE)
    long = syn.select("label", "synthetic_index", "base_id", "neighbour_id",
                      F.posexplode("embedding").alias("dim", "value"))
    return rounded(long)


# ------------------------------------------------------------- model fits
# Binary target on embeddings: label < 5.  Split 70/15/15 by hashed id.


def model_data(spark, sf):
    e = _emb(spark, sf).withColumn("y", (F.col("label") < 5).cast("int"))
    e = stratified_split(e, "vec_id", "y")
    return MD.features_vector(e, "embedding")


def _train_val(spark, sf):
    d = model_data(spark, sf)
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "val")


def _eval(model, val):
    return rounded(MD.evaluate_model(model, val, "y"))


_FITTERS = {
    "gbt": lambda tr: MD.fit_gbt(tr, "y"),
    "tree": lambda tr: MD.fit_tree(tr, "y"),
    "mlp": lambda tr: MD.fit_mlp(tr, N_DIM, "y"),
    "svm_rff": lambda tr: MD.fit_svm_rff(tr, N_DIM, "y"),
    "net": lambda tr: fit_net(tr, N_DIM, "y"),
}


def fitted(spark, sf, name):
    return _FITTERS[name](_train_val(spark, sf)[0])


def q_fit_gbt(spark, sf):
    return _eval(fitted(spark, sf, "gbt"), _train_val(spark, sf)[1])


def q_fit_tree(spark, sf):
    return _eval(fitted(spark, sf, "tree"), _train_val(spark, sf)[1])


def q_fit_mlp(spark, sf):
    return _eval(fitted(spark, sf, "mlp"), _train_val(spark, sf)[1])


def q_fit_net(spark, sf):
    return _eval(fitted(spark, sf, "net"), _train_val(spark, sf)[1])


def q_fit_svm_rff(spark, sf):
    return _eval(fitted(spark, sf, "svm_rff"), _train_val(spark, sf)[1])


def q_model_compare(spark, sf):
    tr, va = _train_val(spark, sf)
    rows = [MD.evaluate_model(fitted(spark, sf, m), va, "y") for m in ("tree", "mlp", "svm_rff", "gbt")]
    q = va.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"), "y")
    r = tr.select(F.col("vec_id").alias("rid"), F.col("embedding").alias("vec"), F.col("y").alias("label"))
    near = cut_lineage(nearest(q.select("qid", "vec"), r.select("rid", "vec"), K_VOTE, "qid", "rid", "vec"))
    knn = (knn_vote(near, r).join(knn_share(near, r, 1), on="qid").join(q.select("qid", "y"), on="qid")
           .withColumn("prediction", F.col("predicted").cast("int")))
    rows.append(MM.evaluate(knn, "y", "prediction", "score").withColumns(
        {"model": F.lit("knn"), "fit_seconds": F.lit(0.0)}))
    out = rows[0]
    for r_ in rows[1:]:
        out = out.unionByName(r_)
    return rounded(out.select("model", "accuracy", "balanced_accuracy", "f1_score", "precision", "recall",
                              "auc", "mcc", "log_loss", "fit_seconds"))


def q_tune_gbt(spark, sf):
    tr, va = _train_val(spark, sf)
    return rounded(tune_gbt(tr, va, N_DIM, "y", n_trials=N_TRIALS).drop("uniforms"))


def q_tune_refit(spark, sf):
    """The best of a few proposed trials, refitted and evaluated on all validation rows."""
    tr, va = _train_val(spark, sf)
    trials = tune_gbt(tr, va, N_DIM, "y", n_trials=REFIT_TRIALS, batch=REFIT_BATCH)
    forest = refit_best(tr, trials, N_DIM, "y")
    scored = cut_lineage(forest.transform(va).select("y", "prediction", "score"))
    out = MM.evaluate(scored, "y", "prediction", "score")
    return rounded(out.withColumns({p: F.lit(forest.params[p]) for p in PARAMS}))


def q_shapley_trees(spark, sf):
    tr, va = _train_val(spark, sf)
    fit = fitted(spark, sf, "tree")
    return rounded(shapley_trees(of_spark_tree(fit.model, N_DIM), va, "vec_id", "embedding"))


def q_shapley_sampled(spark, sf):
    tr, va = _train_val(spark, sf)
    model = fitted(spark, sf, "tree")
    phi = shapley_sampled(model, va, tr, "vec_id", "embedding", N_DIM, n_perm=N_PERM)
    return rounded(phi)


def q_local_surrogate(spark, sf):
    tr, va = _train_val(spark, sf)
    model = fitted(spark, sf, "tree")
    scale = fit_scaler(tr.select(*[F.col("embedding")[i].alias(f"x{i}") for i in range(N_DIM)]),
                       [f"x{i}" for i in range(N_DIM)]).stds
    rows = sample_fixed(va, "vec_id", LOCAL_ROWS)
    out = local_surrogate(model, rows, "vec_id", "embedding", N_DIM, [scale[f"x{i}"] for i in range(N_DIM)],
                          n_samples=SURROGATE_SAMPLES, top=15)
    return rounded(out)


def q_feature_importance(spark, sf):
    names = [f"e{i:02d}" for i in range(N_DIM)]
    return rounded(MD.importance_table(spark, fitted(spark, sf, "tree"), names, top=20))


QUERIES = {
    "feature_importance": q_feature_importance,
    "knn_classify": q_knn_classify,
    "smote": q_smote,
    "fit_gbt": q_fit_gbt,
    "fit_tree": q_fit_tree,
    "fit_mlp": q_fit_mlp,
    "fit_net": q_fit_net,
    "fit_svm_rff": q_fit_svm_rff,
    "model_compare": q_model_compare,
    "tune_gbt": q_tune_gbt,
    "tune_refit": q_tune_refit,
    "shapley_trees": q_shapley_trees,
    "shapley_sampled": q_shapley_sampled,
    "local_surrogate": q_local_surrogate,
}


def _hint(key_sql: str, tag: str) -> str:
    return f"(('0x' || substr(md5('42|{tag}|' || {key_sql}), 1, 8))::BIGINT)"


DIST = ("round(list_sum(list_transform(list_zip({a}, {b}), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE))"
        " * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)))), 9)")

ORACLE = {
    "knn_classify": f"""WITH e AS (SELECT vec_id, embedding, label,
    {_hint("CAST(vec_id AS VARCHAR)", "q")} / 4294967296.0 < {QUERY_SHARE} AS is_q FROM embeddings),
q AS (SELECT vec_id AS qid, embedding AS vec, label FROM e WHERE is_q),
r AS (SELECT vec_id AS rid, embedding AS vec, label FROM e WHERE NOT is_q),
pairs AS (SELECT q.qid, r.rid, r.label, {DIST.format(a="q.vec", b="r.vec")} AS d2 FROM q, r),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, rid) AS rk FROM pairs) WHERE rk <= {K_VOTE}),
per AS (SELECT qid, label, sum(CASE WHEN sqrt(d2) > 0 THEN 1.0 / sqrt(d2) END) AS w,
               count_if(sqrt(d2) = 0) AS zeros FROM top GROUP BY qid, label),
v AS (SELECT qid, label, round(CASE WHEN max(zeros) OVER (PARTITION BY qid) > 0 THEN CAST(zeros AS DOUBLE)
                                    ELSE coalesce(w, 0.0) END, 9) AS vote FROM per),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY vote DESC, label) AS rn FROM v) WHERE rn = 1)
SELECT b.qid AS vec_id, q.label, b.label AS predicted, round(b.vote, 6) AS vote,
       round(b.vote / (SELECT sum(vote) FROM v WHERE v.qid = b.qid), 6) AS score FROM best b JOIN q ON b.qid = q.qid""",
    "smote": f"""WITH sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
need AS (SELECT label, n, (SELECT max(n) FROM sizes) - n AS need FROM sizes WHERE n < (SELECT max(n) FROM sizes)),
m AS (SELECT e.vec_id, e.embedding, e.label FROM embeddings e JOIN need USING (label)),
idx AS (SELECT vec_id, embedding, label, row_number() OVER (PARTITION BY label
          ORDER BY md5('42|idx|' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS idx FROM m),
pairs AS (SELECT a.vec_id AS qid, b.vec_id AS rid, {DIST.format(a="a.embedding", b="b.embedding")} AS d2
          FROM m a JOIN m b ON a.label = b.label AND a.vec_id <> b.vec_id),
nb AS (SELECT qid, rid, rk FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, rid) AS rk FROM pairs)
       WHERE rk <= {K_SMOTE}),
gen0 AS (SELECT label, n, unnest(range(0, need)) AS i FROM need),
gen AS (SELECT label, i AS synthetic_index, n,
    {_hint("CAST(label AS VARCHAR) || '|' || CAST(i AS VARCHAR)", "b")} % n AS bidx,
    {_hint("CAST(label AS VARCHAR) || '|' || CAST(i AS VARCHAR)", "n")} % least({K_SMOTE}, n - 1) + 1 AS rk,
    {_hint("CAST(label AS VARCHAR) || '|' || CAST(i AS VARCHAR)", "u")} / 4294967296.0 AS u FROM gen0),
j AS (SELECT g.label, g.synthetic_index, b.vec_id AS base_id, nb.rid AS neighbour_id, g.u,
             b.embedding AS bvec, nv.embedding AS nvec
      FROM gen g JOIN idx b ON g.label = b.label AND g.bidx = b.idx
      JOIN nb ON nb.qid = b.vec_id AND nb.rk = g.rk
      JOIN m nv ON nv.vec_id = nb.rid),
v AS (SELECT label, synthetic_index, base_id, neighbour_id,
        list_transform(list_zip(bvec, nvec), lambda z: CAST(z[1] AS DOUBLE) + u * (CAST(z[2] AS DOUBLE) - CAST(z[1] AS DOUBLE)))
          AS vec FROM j)
SELECT label, CAST(synthetic_index AS BIGINT) AS synthetic_index, base_id, neighbour_id,
       CAST(g.p - 1 AS INTEGER) AS dim, round(g.x, 6) AS value
FROM v, unnest(vec) WITH ORDINALITY AS g(x, p)""",
}
