import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameml.functions import activations as A
from frameml.functions.vectors import argmax, argmin, soft_threshold, squared_distance

POINTS = [-2.0, -0.3, 0.4, 1.7]


@pytest.fixture(scope="module")
def column(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(POINTS)], "id long, v double")


def values(df, col):
    return np.array([r[0] for r in df.orderBy("id").select(col).collect()], dtype=float)


@pytest.mark.parametrize("kind", A.KINDS)
def test_activation_gradients_by_finite_differences(column, kind):
    h = 1e-6
    x = F.abs(F.col("v")) + 0.1 if kind in ("log", "pow") else F.col("v")
    up = values(column, A.activation(x + h, kind, 3.0))
    down = values(column, A.activation(x - h, kind, 3.0))
    exact = values(column, A.activation_grad(x, kind, F.lit(2.0), 3.0))
    assert np.allclose((up - down) / (2 * h) * 2.0, exact, rtol=1e-5, atol=1e-6)


def test_activation_values(column):
    assert np.allclose(values(column, A.activation(F.col("v"), "relu")), np.maximum(POINTS, 0))
    assert np.allclose(values(column, A.activation(F.col("v"), "sigmoid")), 1 / (1 + np.exp(-np.array(POINTS))))
    assert np.allclose(values(column, A.activation(F.lit(0.0), "log")), math.log(1e-8))
    with pytest.raises(ValueError):
        A.activation(F.col("v"), "swish")


def test_softmax_every_row(spark):
    rows = [[1.0, 2.0, 3.0], [1000.0, 1001.0, 999.0], [-5.0, 0.0, 5.0]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id long, x array<double>")
    got = [r["s"] for r in df.select("id", A.softmax(F.col("x")).alias("s")).orderBy("id").collect()]
    for out, row in zip(got, rows):
        e = np.exp(np.array(row) - max(row))
        assert np.allclose(out, e / e.sum()) and abs(sum(out) - 1) < 1e-12


def test_softmax_gradient(spark):
    x, g, h = np.array([0.3, -1.0, 0.8]), np.array([1.0, -2.0, 0.5]), 1e-6
    df = spark.createDataFrame([(x.tolist(), g.tolist())], "x array<double>, g array<double>")
    got = df.select(A.softmax_grad(A.softmax(F.col("x")), F.col("g"))).first()[0]
    soft = lambda z: np.exp(z) / np.exp(z).sum()
    want = [(soft(x + h * e) @ g - soft(x - h * e) @ g) / (2 * h) for e in np.eye(3)]
    assert np.allclose(got, want, atol=1e-6)


def test_soft_threshold_and_distance(column):
    assert np.allclose(values(column, soft_threshold(F.col("v"), 0.35)), [-1.65, 0.0, 0.05, 1.35])
    assert np.allclose(values(column, squared_distance([F.col("v"), F.lit(1.0)], [1.0, 3.0])),
                       (np.array(POINTS) - 1) ** 2 + 4)
    arrays = squared_distance(F.array(F.col("v"), F.lit(2.0)), F.array(F.lit(0.5), F.lit(1.0)))
    assert np.allclose(values(column, arrays), (np.array(POINTS) - 0.5) ** 2 + 1)


def test_arg_ties_go_to_the_lowest(spark):
    one = spark.range(1)
    assert one.select(argmin([F.lit(2.0), F.lit(1.0), F.lit(1.0)])).first()[0] == 1
    assert one.select(argmax([F.lit(2.0), F.lit(3.0), F.lit(3.0)])).first()[0] == 1


def test_dropout_after_tanh(spark):
    n, p = 4000, 0.3
    df = spark.range(n).withColumn("x", F.array_repeat(F.lit(1.0), 10))
    hidden = F.transform("x", lambda v: F.tanh(v))
    out = df.select("id", A.dropout_array(hidden, p, "id", seed=5).alias("d"))
    got = np.array([r["d"] for r in out.orderBy("id").collect()])
    share = (got == 0).mean()
    assert abs(share - p) < 3 * math.sqrt(p * (1 - p) / got.size)
    assert np.allclose(got[got != 0], math.tanh(1.0) / (1 - p))
    again = np.array([r["d"] for r in out.repartition(7).orderBy("id").collect()])
    assert np.array_equal(got, again)
    off = df.select(A.dropout_array(hidden, p, "id", training=False).alias("d")).first()["d"]
    assert np.allclose(off, math.tanh(1.0))
    with pytest.raises(ValueError):
        A.keep_mask(1.0, "id")
