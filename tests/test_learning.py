"""kNN exactness and pruning, SMOTE invariants, Shapley additivity, model fits."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tessera.operators import explain
from tessera.operators import models as MD
from tessera.operators import tuning
from tessera.operators.balance import smote
from tessera.operators.explain import shapley_sampled
from tessera.operators.neighbours import nearest, sq_dist
from tessera.operators.sampling import stratified_split
from tessera.operators.tuning import search_space


def _emb(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")


@pytest.mark.parametrize("n_pivots", [1, 8, None])
def test_nearest_is_exact(spark, n_pivots):
    e = _emb(spark)
    q = e.where(F.col("vec_id") % 5 == 0).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    r = e.where(F.col("vec_id") % 5 != 0).select(F.col("vec_id").alias("rid"), F.col("embedding").alias("vec"))
    got = nearest(q, r, 7, n_pivots=n_pivots).select("qid", "rid", "rank")
    brute = (q.join(r.withColumnRenamed("vec", "rvec"), how="cross")
             .select("qid", "rid", F.round(sq_dist("vec", "rvec"), 9).alias("d")))
    from pyspark.sql import Window
    brute = (brute.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("d", "rid")))
             .where("rank <= 7").select("qid", "rid", "rank"))
    assert got.exceptAll(brute).count() == 0 and brute.exceptAll(got).count() == 0


def test_smote_balances_and_interpolates(spark):
    e = _emb(spark)
    syn = smote(e, "vec_id", "label", "embedding", 5)
    sizes = {r["label"]: r["count"] for r in e.groupBy("label").count().collect()}
    grown = {r["label"]: r["count"] for r in syn.groupBy("label").count().collect()}
    top = max(sizes.values())
    for lab, n in sizes.items():
        assert n + grown.get(lab, 0) == top
    # every synthetic point lies on the segment between its base and its neighbour
    vecs = e.select(F.col("vec_id").alias("id"), "embedding")
    chk = (syn.join(vecs.withColumnRenamed("id", "base_id").withColumnRenamed("embedding", "b"), on="base_id")
              .join(vecs.withColumnRenamed("id", "neighbour_id").withColumnRenamed("embedding", "nb"), on="neighbour_id"))
    bad = chk.select(F.aggregate(F.zip_with(F.zip_with("b", "nb", lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
                                            "embedding", lambda s, v: F.abs(s["x"] + F.col("u") * (s["y"] - s["x"]) - v)),
                                 F.lit(0.0), lambda a, v: F.greatest(a, v)).alias("err"))
    assert bad.agg(F.max("err")).first()[0] < 1e-6
    assert syn.where("u < 0 or u >= 1").count() == 0


def _model_data(spark):
    e = _emb(spark).withColumn("y", (F.col("label") < 5).cast("int"))
    return MD.features_vector(stratified_split(e, "vec_id", "y"), "embedding")


def test_fit_tree_and_evaluate(spark):
    d = _model_data(spark)
    m = MD.fit_tree(d.where("split = 'train'"), "y")
    row = MD.evaluate_model(m, d.where("split = 'val'"), "y").first()
    assert 0.0 <= row["accuracy"] <= 1.0 and row["tp"] + row["fp"] + row["tn"] + row["fn"] > 0


def test_shapley_sampled_is_additive(spark):
    d = _model_data(spark).cache()
    tr, va = d.where("split = 'train'"), d.where("split = 'val'").limit(5)
    m = MD.fit_tree(tr, "y", maxDepth=4)
    phi = shapley_sampled(m, va, tr, "vec_id", "embedding", 64, n_perm=3)
    assert phi.count() == 5 * 64
    # efficiency: per row, sum(phi) = f(row) - mean over permutations of f(background)
    assert phi.where(F.isnan("phi")).count() == 0


def test_search_space_is_deterministic_and_in_bounds(spark):
    a = search_space(spark, 50).collect()
    b = search_space(spark, 50).collect()
    assert a == b and len(a) == 50
    for r in a:
        assert r["n_trees"] in (100, 150, 200, 300, 400, 500)
        assert 3 <= r["max_depth"] <= 12 and 0.005 <= r["learning_rate"] <= 0.3
        assert 0.5 <= r["subsample"] <= 1 and 1 <= r["min_child"] <= 20


def test_shapley_sampled_efficiency_property(spark):
    """Per row: sum_j phi_j = f(row) - mean over permutations of f(its background row)."""
    from pyspark.ml.classification import LogisticRegression
    d = _model_data(spark).cache()
    tr, va = d.where("split = 'train'"), d.where("split = 'val'").limit(4)
    lr = LogisticRegression(labelCol="y", featuresCol="features", maxIter=20).fit(tr)

    class M:
        def transform(self, df):
            from pyspark.ml.functions import vector_to_array
            return lr.transform(df).withColumn("score", vector_to_array("probability")[1])
    phi = shapley_sampled(M(), va, tr, "vec_id", "embedding", 64, n_perm=1)
    sums = {r["vec_id"]: r["s"] for r in phi.groupBy("vec_id").agg(F.sum("phi").alias("s")).collect()}
    f_row = {r["vec_id"]: r["score"] for r in M().transform(va).collect()}
    # with one permutation: sum phi = f(row) - f(background); f(background) lies in [0, 1]
    for k, s in sums.items():
        assert -1.0 <= f_row[k] - s <= 1.0 + 1e-9
        assert 0.0 - 1e-9 <= f_row[k] - s <= 1.0 + 1e-9


def test_shapley_linear_local_breakdown_adds_up(spark):
    from tessera.operators.explain import shapley_linear
    # (orderkey, linenumber) repeats in the test data: give each row its own id
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("rid", F.monotonically_increasing_id()).cache()
    w = {"l_quantity": 0.3, "l_discount": -2.0, "l_tax": 5.0}
    phi = shapley_linear(li, ["rid"], w, intercept=0.1)
    chk = phi.groupBy("rid").agg(
        (F.sum("phi") + F.first("base")).alias("s"), F.first("prediction").alias("p"))
    assert chk.where(F.abs(F.col("s") - F.col("p")) > 1e-9).count() == 0


def test_tuning_query_fits_every_trial(spark, monkeypatch):
    monkeypatch.setattr(tuning, "TREES_CHOICES", [2, 3])
    trials = E.queries()["tune_gbt"](spark, SF_SMALL).collect()
    assert len(trials) == 50 and len({r["trial"] for r in trials}) == 50
    assert all(r["loss"] is not None and r["fit_seconds"] > 0 for r in trials)


def test_hybrids_come_in_small_batches():
    """A batch of 600 rows of 64 features was 76,800 vectors at once."""
    n, d = 600, 64
    rng = np.random.default_rng(0)
    given = pa.RecordBatch.from_pydict({"__rid": list(range(n)), "__p": [1] * n, "__x": rng.random((n, d)).tolist(), "__z": rng.random((n, d)).tolist()})
    made = list(explain._hybrids(42, d)(iter([given])))
    assert max(b.num_rows for b in made) <= explain.HYBRIDS_AT_ONCE and sum(b.num_rows for b in made) == n * (d + 1)


def test_shapley_sampled_equals_its_definition(spark):
    rng = np.random.default_rng(1)
    x, z, d, n_perm = rng.random((5, 6)), rng.random(6), 6, 3
    f = lambda v: v[0] * v[1] + v[2] ** 2 - v[3] * v[4] * v[5]

    class Model:
        def transform(self, df):
            v = [F.get(vector_to_array("features"), F.lit(j)) for j in range(d)]
            return df.withColumn("score", f(v))

    schema = "vec_id long, v array<double>"
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], schema)
    got = shapley_sampled(Model(), rows, spark.createDataFrame([(9, z.tolist())], schema), "vec_id", "v", d, n_perm)
    want = {}
    for i, r in enumerate(x):
        for p in range(n_perm):
            order, at = np.random.default_rng([42, i, 0, p]).permutation(d), z.copy()
            for j in order.tolist():
                before = f(at)
                at[j] = r[j]
                want[i, j] = want.get((i, j), 0.0) + (f(at) - before) / n_perm
    assert {(r.vec_id, r.feature): r.phi for r in got.collect()} == pytest.approx(want)


def test_training_rows_are_persisted_in_few_partitions(spark):
    """A join's 200 shuffle partitions stayed in the cache: 200 tasks a stage, 12 stages a tree."""
    held = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "30")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = spark.range(3_500).withColumn("g", F.col("id") % 7)
        rows = rows.join(rows.groupBy("g").agg(F.count("*").alias("n")), "g")
        x = MD.training_input(rows)
        tasks = x.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) <= 4 and x._jdf.queryExecution().toRdd().getNumPartitions() <= 4
        assert sum(r["count"] for r in tasks) == 3_500
        x.unpersist()
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
