"""Preparation of tables whose rows repeat, CSV files in any column order, lenient numbers."""
import pytest
from pyspark.sql import functions as F

from tessera.functions.numeric import lenient_double
from tessera.operators.balance import smote
from tessera.operators.prepare import prepare_splits, with_row_id
from tessera.sources.tables import read_csv_sources


def test_smote_balances_a_table_with_repeated_rows(spark):
    major = [(0, float(i % 50), float(i % 7)) for i in range(200)]
    minor = [(1, float(i % 4), 1.0) for i in range(40)]  # each row ten times
    df = spark.createDataFrame(major + minor, "y int, a double, b double").repartition(3)
    out = prepare_splits(df, "y")
    train = {r["y"]: r["count"] for r in out.where("split = 'train'").groupBy("y").count().collect()}
    assert train[0] == train[1] == 140
    assert out.where("synthetic").count() == 112
    assert out.select("row_id").distinct().count() == out.count()


def test_row_ids_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (1, "a")], "x int, s string")
    ids = lambda n: sorted(map(tuple, with_row_id(df.repartition(n)).collect()), key=str)
    assert ids(1) == ids(3) and len({r[2] for r in ids(2)}) == 4


def test_smote_refuses_shared_ids(spark):
    df = spark.createDataFrame([(1, 0, [0.0]), (1, 0, [1.0]), (2, 1, [2.0])], "id int, y int, v array<double>")
    with pytest.raises(ValueError, match="unique"):
        smote(df, "id", "y", "v")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,extra,a\n20,x,1\n21,y,2\n")
    got = read_csv_sources(spark, {"t": (str(tmp_path / "t.csv"), "a int, b int, missing string")})["t"]
    assert [tuple(r) for r in got.orderBy("a").collect()] == [(1, 20, None), (2, 21, None)]


def test_numbers_with_type_suffixes_are_bad_text(spark):
    texts = ["12", "12d", "1f", " -1.5e3 ", ".5", "5.", "abc", "", None, "1e", "NaN", "1 2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(lenient_double("t", -1.0)).collect()]
    assert got[10] != got[10] and got[:10] + got[11:] == [12.0, -1.0, -1.0, -1500.0, 0.5, 5.0, -1.0, -1.0, -1.0, -1.0, -1.0]
