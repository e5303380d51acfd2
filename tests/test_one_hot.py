"""One-hot columns and the sparse form for any number of levels."""
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import columns as C
from tessera.operators import lookup as L


def test_sparse_equals_columns(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", "a", None, "c", "a", ""] * 4)], "id long, v string")
    levels = C.level_table(df, "v")
    assert [tuple(r) for r in levels.orderBy("index").collect()] == [("", 0), ("a", 1), ("b", 2), ("c", 3)]
    wide = {r.id: [r[c] for c in ("v_", "v_a", "v_b", "v_c")] for r in C.one_hot(df, "v").collect()}
    sparse = {r.id: [int(x) for x in r.x] for r in C.one_hot_sparse(df, "v").select("id", vector_to_array("v_vector").alias("x")).collect()}
    assert wide == sparse


def test_unseen_levels_are_zero(spark):
    levels = C.level_table(spark.createDataFrame([("a",), ("b",)], "v string"), "v")
    out = C.one_hot_sparse(spark.createDataFrame([(1, "b"), (2, "z"), (3, None)], "id long, v string"), "v", levels, drop=False)
    assert {r.id: list(r.v_vector.toArray()) for r in out.collect()} == {1: [0, 1], 2: [0, 0], 3: [0, 0]}


def test_a_hundred_thousand_levels_and_a_frequent_one(spark):
    df = spark.range(100_000).select("id", F.format_string("l%06d", "id").alias("v")).unionByName(
        spark.range(50_000).select("id", F.lit("l000007").alias("v")))
    out = C.one_hot(df, "v", "level")
    assert out.columns == ["id", "level_vector"]
    found = out.select(F.udf(lambda x: [int(x.size), *map(int, x.indices)], "array<int>")("level_vector").alias("x")).groupBy("x").count()
    assert found.count() == 100_000
    assert found.where("x[1] = 7").first()["count"] == 50_001 and found.where("x[0] != 100000").count() == 0


def test_lookup_joins_as_join_does(spark, monkeypatch):
    monkeypatch.setattr(L, "FEW_ROWS", 3)
    rows = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7), (3, 8), (9, 9), (None, 1), (None, 2)] + [(4, i) for i in range(9)], "k long, x long")
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, y string")
    for how in ("inner", "left"):
        assert sorted(map(str, L.lookup(rows, table, "k", 64, how).collect())) == sorted(map(str, rows.join(table, "k", how).collect()))


def test_no_levels(spark):
    df = spark.createDataFrame([(1, None)], "id long, v string")
    assert C.one_hot(df, "v").columns == ["id"] and C.one_hot_sparse(df, "v").count() == 1
