"""Cut-offs by histogram refinement label the rows that a full ranking would."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import sampling as S


def ranked(ids):
    return sorted(ids, key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("few,digits", [(10_000, 4), (3, 1), (1, 2)])
def test_split_equals_full_ranking(spark, monkeypatch, few, digits):
    monkeypatch.setattr(S, "FEW", few)
    monkeypatch.setattr(S, "DIGITS", digits)
    rng = random.Random(few)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), "text") for i in range(900)] + [(5000, "lonely", "x"), (5001, "two", "x"), (5002, "two", "x")]
    got = {r.id: r.split for r in S.stratified_split(spark.createDataFrame(rows, "id long, y string, other string").repartition(3), "id", "y").collect()}
    want = {}
    for y in {r[1] for r in rows}:
        mine = ranked([r[0] for r in rows if r[1] == y])
        n = len(mine)
        n_test = int(n * 0.15 + 0.5)
        n_val = int((n - n_test) * (0.15 / 0.85) + 0.5)
        want |= {i: "test" if p < n_test else "val" if p < n_test + n_val else "train" for p, i in enumerate(mine)}
    assert got == want


def test_rows_of_one_id_share_their_split_and_nothing_is_lost(spark):
    rows = [(i % 40, "a") for i in range(400)] + [(99, "a")] * 300 + [(None, "a")] * 5
    out = S.stratified_split(spark.createDataFrame(rows, "id long, y string"), "id", "y").collect()
    assert len(out) == len(rows)
    assert len({(r.id, r.split) for r in out}) == len({r.id for r in out})


def test_no_row_is_shuffled_to_be_labelled(spark):
    df = spark.createDataFrame([(i, i % 2, "w" * 50) for i in range(300)], "id long, y int, wide string")
    plan = S.stratified_split(df, "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "wide" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_batches_equal_full_ranking(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1.5, 2.5, 9.0]), i, "z") for i in range(103)]
    df = spark.createDataFrame(rows, "v double, id long, other string").repartition(4)
    got = {r.id: r.batch for r in S.batch_slice(df, ["v", "id"], 5).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == {r[1]: p // 20 + 1 for p, r in enumerate(order[:100])}
    assert S.batch_slice(df.limit(3), ["v", "id"], 5).count() == 0
    assert S.batch_slice(df, ["v", "id"], 4, max_size=2).groupBy("batch").agg(F.count("*").alias("n")).collect().__len__() == 4


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, y string")
    assert S.stratified_split(none, "id", "y").collect() == [] and S.batch_slice(none, ["id"], 3).collect() == []
