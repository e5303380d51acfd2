"""The net: gradients against differences, averages and one worker against a plain loop, the schedule, convergence and reruns."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from tessera.operators import metrics as M
from tessera.operators import net as N
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("dropped", [False, True])
def test_gradient_equals_differences(dropped):
    shape, rng = N.Shape(5, (7, 4)), np.random.default_rng(1)
    state = N.State.initial(shape, 3)
    state.weights += rng.normal(0, 0.1, shape.size)
    x, y = rng.normal(size=(30, 5)), (rng.random(30) < 0.4).astype(float)
    masks = [(rng.random((30, n)) >= 0.3) / 0.7 if dropped else None for n in shape.hidden]
    _, gradient, moments = N.loss_and_gradient(shape, state.weights, x, y, masks)
    assert moments.shape == (shape.norms,)
    for j in range(shape.size):
        up, down = state.weights.copy(), state.weights.copy()
        up[j] += 1e-6
        down[j] -= 1e-6
        slope = (N.loss_and_gradient(shape, up, x, y, masks)[0] - N.loss_and_gradient(shape, down, x, y, masks)[0]) / 2e-6
        assert abs(slope - gradient[j]) < 1e-4 * max(1.0, abs(slope)), j


def test_steps_of_adam_by_hand():
    state = N.State(np.array([1.0]), np.zeros(1), np.zeros(1), np.zeros(0))
    state.step(np.array([0.5]), 0.1)  # the first step is the rate, against the sign
    assert state.weights[0] == pytest.approx(0.9, abs=1e-8)
    state.step(np.array([-0.5]), 0.1)
    mean = (0.9 * 0.05 - 0.1 * 0.5) / (1 - 0.81)
    spread = np.sqrt((0.999 * 0.00025 + 0.001 * 0.25) / (1 - 0.999 ** 2))
    assert state.weights[0] == pytest.approx(0.9 - 0.1 * mean / spread, abs=1e-7)


def test_states_are_averaged_by_rows():
    shape, rng = N.Shape(70, (60,)), np.random.default_rng(2)
    states = [N.State(*rng.normal(size=(3, shape.size)), rng.normal(size=shape.norms), n) for n in (4, 6, 5)]
    sent = pd.concat([N.pieces(s, float(i), n, i) for i, (s, n) in enumerate(zip(states, (2, 3, 5)))])
    met = [N.averaged(g) for _, g in sent.groupby("piece")]
    assert len(met) > 1 and all(m["seen"][0] == 10 and m["loss"][0] == 3.0 and m["steps"][0] == 6 for m in met)
    flat = np.concatenate([np.frombuffer(m["entries"][0], "f8") for m in met])
    assert np.allclose(flat[:shape.size], 0.2 * states[0].weights + 0.3 * states[1].weights + 0.5 * states[2].weights)
    assert np.allclose(flat[3 * shape.size:], 0.2 * states[0].running + 0.3 * states[1].running + 0.5 * states[2].running)


def test_shares_keep_every_row_once():
    batches = [pd.DataFrame({"v": [[float(i)] for i in range(a, b)], "y": [float(i) for i in range(a, b)]}) for a, b in ((0, 7), (7, 7), (7, 20))]
    shares = list(N._shares(iter(batches), 1, 6, np.random.default_rng(0)))
    assert [len(y) for _, y in shares] == [6, 6, 6, 2]
    assert sorted(np.concatenate([y for _, y in shares]).tolist()) == list(range(20))
    assert all((x[:, 0] == y).all() for x, y in shares)


def rings(spark, n=2400):
    """Two classes that no line parts: inside or outside a circle."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 2))
    inside = (x ** 2).sum(axis=1) < 1.4
    rows = [(i, [float(a) for a in v], int(t)) for i, (v, t) in enumerate(zip(x, inside))]
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


def test_converges_over_several_workers_and_reruns_agree(spark):
    df = rings(spark)
    train, test = df.filter("id % 4 > 0").repartition(3, "id").cache(), df.filter("id % 4 = 0")
    kw = dict(hidden=(32, 16), dropout=(0.1, 0.0), workers=3, epochs=15, batch_size=96, rate=0.01)
    model = N.fit_net(train, 2, **kw)
    assert model.losses[-1] < 0.5 * np.log(2) and model.state.steps >= 15 * 18  # an untrained net loses log 2 a row
    scored = model.transform(test).select("label", "prediction", "score")
    assert M.roc_auc(scored, "label", "score").first()["auc"] > 0.97
    again = N.fit_net(train, 2, **kw)
    assert np.array_equal(model.state.weights, again.state.weights) and model.losses == again.losses


def test_rate_falls_on_a_plateau(spark):
    flat = spark.createDataFrame([([0.0, 0.0], i % 2) for i in range(64)], "features array<double>, label int")
    model = N.fit_net(flat, 2, hidden=(4,), dropout=(0.0,), workers=1, epochs=14, rate=1e-12, batch_size=64)
    assert model.rates[:5] == [1e-12] * 5 and model.rates[-1] < 1e-12
    assert sorted(model.rates, reverse=True) == model.rates


def test_more_workers_than_rows_and_odd_rows(spark):
    rows = [([1.0, None], 1), ([float("nan"), 2.0], 0), (None, 1), ([3.0, 4.0], None), ([0.0, 1.0], 1), ([0.0, 1.0], 1)]
    schema = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])
    df = spark.createDataFrame(rows, schema)
    model = N.fit_net(df, 2, hidden=(3,), dropout=(0.5,), workers=3, epochs=2)
    assert len(model.losses) == 2
    scores = [r.score for r in model.transform(df).collect()]
    assert len(scores) == 6 and all(0 <= s <= 1 for s in scores)
    empty = N.fit_net(df.limit(0), 2, hidden=(3,), dropout=(0.5,), epochs=2)
    assert empty.losses == [] and empty.transform(df).count() == 6


def test_one_worker_takes_the_steps_of_a_plain_loop(spark):
    df = rings(spark, 300)
    kw = dict(hidden=(6,), dropout=(0.0,))
    model = N.fit_net(df, 2, workers=1, epochs=2, batch_size=64, rate=0.01, **kw)
    rows, _ = N.dealt(df, "label", "features", 1)
    given, shape = rows.toPandas(), N.Shape(2, (6,))
    state = N.State.initial(shape, N.SEED)
    for epoch in range(2):
        state, loss, seen = N.train_share(iter([given]), shape, state, (0.0,), 64, 0.01, (N.SEED, epoch, 0))
    assert seen == 300 and np.allclose(model.state.weights, state.weights, atol=1e-12) and model.losses[-1] == pytest.approx(loss / 300)


def test_equal_rows_are_spread_over_workers(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0))).otherwise(F.array(F.col("id").cast("double"))).alias("features"),
                                 (F.col("id") % 2).alias("label"))
    rows, _ = N.dealt(df, "label", "features", 4)
    each = [r["count"] for r in rows.filter("v[0] = 1.0").groupBy(F.spark_partition_id()).count().collect()]
    assert len(each) == 4 and max(each) < 120


def test_net_query(spark):
    row = E.queries()["fit_net"](spark, SF_SMALL).first()
    assert row["model"] == "net" and 0 <= row["auc"] <= 1 and row["tp"] + row["fp"] + row["tn"] + row["fn"] > 0
