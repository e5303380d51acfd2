"""Goldens and invariants of the statistics operators."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tessera.operators import metrics as M
from tessera.operators import prefix
from tessera.operators.sampling import batch_slice, stratified_split
from tessera.operators.scaling import standardise

# fixed values: published confusion counts and metrics of the reference's SVM run
SVM_COUNTS = dict(tp=6003, tn=54675, fp=22850, fn=1345)
SVM_METRICS = dict(accuracy=0.714927008589304, balanced_accuracy=0.7611066820069807, f1_score=0.33164829700836995,
                   precision=0.20805462170311578, recall=0.8169569951007076, specificity=0.7052563689132538,
                   mcc=0.31001763783536335, cohen_kappa=0.22464401943861212)
# fixed values: published KS results with n = m = 5000 (statistic, p-value)
KS_GOLDEN = [(0.016, 0.5441874830769005), (0.0132, 0.7764175867140878), (0.032, 0.011947718089521279),
             (0.0318, 0.01273501809411445), (0.0242, 0.10697090744102715), (0.0, 1.0)]


def test_binary_metrics_from_published_counts(spark):
    counts = spark.createDataFrame([SVM_COUNTS]).select(*[F.col(c).cast("long") for c in ("tp", "tn", "fp", "fn")])
    row = M.binary_metrics_from_counts(counts).first()
    for k, v in SVM_METRICS.items():
        assert row[k] == pytest.approx(v, abs=1e-12), k


def test_ks_pvalue_matches_published(spark):
    from tessera.functions.kolmogorov import ks_pvalue
    df = spark.createDataFrame([(d, 5000, 5000) for d, _ in KS_GOLDEN], "d double, n long, m long")
    got = [r[0] for r in df.select(ks_pvalue("d", "n", "m")).collect()]
    for g, (_, p) in zip(got, KS_GOLDEN):
        assert g == pytest.approx(p, abs=1e-4)
        assert (g < 0.05) == (p < 0.05)


def test_ks_pvalue_tiny_lambda_is_one(spark):
    from tessera.functions.kolmogorov import ks_pvalue
    df = spark.createDataFrame([(0.0002, 5000, 5000)], "d double, n long, m long")
    assert df.select(ks_pvalue("d", "n", "m")).first()[0] == pytest.approx(1.0, abs=1e-9)


@pytest.mark.parametrize("how", ["sum", "max"])
def test_two_level_prefix_equals_plain_window(spark, how):
    # a hot key with most rows, as a skewed production key would be
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 5).alias("k"),
        F.col("id").alias("o"), ((F.col("id") * 7919) % 1000).cast("double").alias("v"))
    two = prefix.running(df, ["k"], ["o"], {"r": F.col("v")}, how=how, buckets=16, totals=True)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    agg = F.sum if how == "sum" else F.max
    plain = df.withColumn("r2", agg("v").over(w)).withColumn("t2", agg("v").over(Window.partitionBy("k")))
    j = two.join(plain, on=["k", "o", "v"])
    assert j.where((F.col("r") != F.col("r2")) | (F.col("r_total") != F.col("t2"))).count() == 0
    assert j.count() == 5000


def test_two_level_global_row_number(spark):
    df = spark.range(0, 3000).select((F.col("id") * 13 % 3000).alias("o"))
    out = prefix.row_number(df, [], ["o"], buckets=8)
    assert out.where(F.col("rn") != F.col("o") + 1).count() == 0


def test_auc_with_ties_and_curves(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.3), (1, 0.3), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    # by hand: pairs (pos, neg) = 9; wins: .9 vs {.3,.1}=2 +tie .9 =.5; .8 vs {.3,.1}=2; .3 vs .1 = 1, tie .3 = .5
    assert M.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(6.0 / 9.0)
    for b in (1, 4):
        assert M.roc_auc(df, "y", "s", buckets=b).first()["auc"] == pytest.approx(6.0 / 9.0)
    ap = M.avg_precision(df, "y", "s").first()["avg_precision"]
    # thresholds .9: P=.5 R=1/3; .8: P=2/3 R=2/3; .3: P=.6 R=1; .1: P=.5 R=1
    assert ap == pytest.approx(1 / 3 * 0.5 + 1 / 3 * 2 / 3 + 1 / 3 * 0.6)
    y = M.youden(df, "y", "s").first()
    assert y["threshold"] == 0.8 and y["youden_j"] == pytest.approx(2 / 3 - 1 / 3)


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first()["auc"] is None


def test_stratified_split_sizes_and_shares(spark):
    c = spark.read.parquet(f"{SF_MID}/customer.parquet")
    s = stratified_split(c, "c_custkey", "c_mktsegment")
    assert s.count() == c.count()
    per = s.groupBy("c_mktsegment", "split").count().collect()
    sizes = {}
    for r in per:
        sizes.setdefault(r["c_mktsegment"], {})[r["split"]] = r["count"]
    for seg, d in sizes.items():
        n = sum(d.values())
        assert abs(d["test"] - n * 0.15) <= 1 and abs(d["val"] - n * 0.15) <= 1.5


def test_split_is_partitioning_independent(spark):
    c = spark.read.parquet(f"{SF_MID}/customer.parquet")
    a = stratified_split(c, "c_custkey", "c_mktsegment").select("c_custkey", "split")
    b = stratified_split(c.repartition(7), "c_custkey", "c_mktsegment").select("c_custkey", "split")
    assert a.exceptAll(b).count() == 0


def test_standardise_train_mean_zero_std_one(spark):
    c = stratified_split(spark.read.parquet(f"{SF_MID}/customer.parquet"), "c_custkey", "c_mktsegment")
    z = standardise(c, ["c_acctbal"], fit_on=F.col("split") == "train", suffix="_z")
    r = z.where("split = 'train'").agg(F.avg("c_acctbal_z").alias("m"), F.stddev_pop("c_acctbal_z").alias("s")).first()
    assert r["m"] == pytest.approx(0.0, abs=1e-9) and r["s"] == pytest.approx(1.0, abs=1e-9)


def test_zero_variance_column_divides_by_one(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 3.0)], "id int, x double")
    assert {r["x"] for r in standardise(df, ["x"]).collect()} == {0.0}


def test_batches_are_contiguous(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderdate")
    b = batch_slice(o, ["o_orderdate", "o_orderkey"], 5, max_size=None)
    n = o.count()
    assert b.count() == (n // 5) * 5
    assert sorted(r["count"] for r in b.groupBy("batch").count().collect()) == [n // 5] * 5


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
def test_exact_median_bucket_method(spark, n):
    from tessera.operators.columns import exact_median
    df = spark.range(n).select(((F.col("id") * 7919) % 997 / 7.0).alias("x"))
    vals = sorted(r["x"] for r in df.collect())
    expect = (vals[(n - 1) // 2] + vals[n // 2]) / 2.0
    assert exact_median(df, "x") == pytest.approx(expect)


def test_two_level_prefix_descending_exclusive(spark):
    df = spark.range(0, 4000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 31) % 4001).alias("o"),
                                     (F.col("id") % 7).cast("long").alias("v"))
    two = prefix.running(df, ["k"], ["o"], {"r": F.col("v")}, descending=True, inclusive=False, buckets=8)
    w = Window.partitionBy("k").orderBy(F.col("o").desc()).rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumn("r2", F.coalesce(F.sum("v").over(w), F.lit(0)))
    j = two.join(plain, on=["k", "o", "v"])
    assert j.count() == 4000 and j.where(F.col("r") != F.col("r2")).count() == 0


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("how", ["sum", "max"])
@pytest.mark.parametrize("kind", ["string", "double", "date", "decimal(20,4)", "long"])
def test_prefix_equals_plain_window_for_any_order(spark, kind, how, descending):
    """Text, nulls, NaN, dates and decimals; null and hot keys; one range and many."""
    texts = [None, *"abcde", "ab", "ba", "ca", "abc", "\u00e9", ""]
    o = {"string": F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("id") % len(texts) + 1).cast("int")),
         "double": F.when(F.col("id") % 9 == 0, F.lit(None)).when(F.col("id") % 9 == 1, F.lit(float("nan"))).otherwise(F.col("id") * 37 % 101 / 7),
         "date": F.when(F.col("id") % 8 > 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 13 % 300).cast("int"))),
         "decimal(20,4)": F.when(F.col("id") % 8 > 0, (F.col("id") * 7919 % 1000 / 16).cast("decimal(20,4)")),
         "long": F.col("id") * 31 % 997}[kind]
    df = spark.range(0, 900).select(
        F.when(F.col("id") % 10 < 6, F.lit("hot")).when(F.col("id") % 10 == 6, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        o.cast(kind).alias("o"), "id", F.when(F.col("id") % 11 > 0, F.col("id") % 17).alias("v")).repartition(5)
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in ("o", "id")]
    w = Window.partitionBy("k").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    agg = F.sum if how == "sum" else F.max
    whole = agg("v").over(Window.partitionBy("k"))
    plain = {r["id"]: (r["r"], r["t"]) for r in df.select(
        "id", (F.coalesce(agg("v").over(w), F.lit(0)) if how == "sum" else agg("v").over(w)).alias("r"), whole.alias("t")).collect()}
    for buckets in (1, 7):
        got = prefix.running(df, ["k"], ["o", "id"], {"r": F.col("v")}, how=how, descending=descending, buckets=buckets, totals=True).collect()
        assert {r["id"]: (r["r"], r["r_total"]) for r in got} == plain


def test_prefix_cuts_a_hot_key(spark):
    df = spark.range(0, 6000).select(F.lit(0).alias("k"), F.col("id").alias("o"), (F.col("id") % 13).alias("v"))
    out = prefix.running(df, ["k"], ["o"], {"r": F.col("v")}, buckets=8).withColumn("p", F.spark_partition_id())
    assert out.where(F.col("r") != F.expr("o div 13 * 78 + (o % 13) * (o % 13 + 1) div 2")).count() == 0
    assert max(r["count"] for r in out.groupBy("p").count().collect()) < 6000
