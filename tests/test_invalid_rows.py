"""One rule for null, NaN and wrong-width features on both sides of the literal limit, and wide solves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameml.functions.activations import activation, activation_grad
from frameml.operators.clustering import assignment
from frameml.operators.logistic import LogisticModel, logistic_predict
from frameml.operators.mixture import MixtureModel, gaussian_pdf, gmm_predict
from frameml.operators.scoring import dense_layer, linear_score
from frameml.operators.solvers import mahalanobis, whiten
from frameml.plans.features import resolve

BAD = (1, 2, 3, 4, 5)


def table(spark, d):
    good = [float(j % 3) for j in range(d)]
    rows = [(0, good), (1, None), (2, [None, *good[1:]]), (3, [float("nan"), *good[1:]]), (4, good[:-1]), (5, [*good, 9.0]), (6, good)]
    return spark.createDataFrame(rows, "id long, x array<double>")


def nulls(df, value):
    return tuple(r["id"] for r in df.select("id", value.alias("v")).where("v is null").orderBy("id").collect())


@pytest.mark.parametrize("d", [3, 201])
def test_scores_are_null_for_invalid_rows(spark, d):
    df = table(spark, d)
    weights = np.ones((d, 2))
    assert nulls(df, linear_score(df, "x", np.ones(d))) == BAD
    assert nulls(dense_layer(df, "x", weights, [0.0, 0.0]), F.col("out")) == BAD
    assert nulls(logistic_predict(df, LogisticModel(tuple(np.ones(d)), ()), "x"), F.col("prediction")) == BAD
    assert nulls(df, assignment(df, "x", np.stack([np.zeros(d), np.ones(d)]))) == BAD


@pytest.mark.parametrize("d", [2, 16])
def test_mixtures_are_null_for_invalid_rows(spark, d):
    df = table(spark, d)
    eye = tuple(map(tuple, np.eye(d)))
    model = MixtureModel((0.5, 0.5), (tuple(np.zeros(d)), tuple(np.ones(d))), (eye, eye))
    assert nulls(gmm_predict(df, model, "x"), F.col("component")) == BAD
    assert nulls(df, gaussian_pdf(df, "x", np.zeros(d), np.eye(d))) == BAD


def test_width_comes_from_all_rows(spark):
    df = spark.createDataFrame([(0, None), (1, [1.0, 2.0]), (2, [3.0, 4.0])], "id long, x array<double>")
    assert resolve(df, "x").d == 2
    with pytest.raises(ValueError, match="1 to 2"):
        resolve(df.union(spark.createDataFrame([(3, [1.0])], df.schema)), "x")
    with pytest.raises(ValueError, match="empty"):
        resolve(df.limit(0), "x")


def test_array_column_of_a_stream(spark, tmp_path):
    table(spark, 3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, x array<double>").parquet(str(tmp_path / "in"))
    scored = stream.withColumn("v", linear_score(stream, "x", [1.0, 1.0, 1.0]))
    query = (scored.writeStream.format("memory").queryName("invalid_rows").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "state")).start())
    query.awaitTermination()
    got = {r["id"]: r["v"] for r in spark.table("invalid_rows").collect()}
    assert got == {0: 3.0, 6: 3.0, **dict.fromkeys(BAD)}


def test_relu_keeps_nulls(spark):
    df = spark.createDataFrame([(0, None), (1, -1.0), (2, 2.0)], "id long, v double")
    got = df.orderBy("id").select(activation(F.col("v"), "relu").alias("a"), activation_grad(F.col("v"), "relu").alias("g")).collect()
    assert [tuple(r) for r in got] == [(None, None), (0.0, 0.0), (2.0, 1.0)]


def test_wide_whitening_distance_and_density(spark, make):
    d, rng = 16, np.random.default_rng(3)
    x = rng.normal(size=(120, d)) @ rng.normal(size=(d, d)) + 2.0
    df = make(x).withColumn("g", F.col("id") % 2)
    w = np.array([r[:] for r in whiten(df, "x").orderBy("id").select(*[f"w{k}" for k in range(d)]).collect()])
    assert np.allclose(np.cov(w.T), np.eye(d), atol=1e-6)
    got = np.array([r[0] for r in mahalanobis(df, "x", "g").orderBy("id").select("distance_sq").collect()])
    for g in (0, 1):
        part = x[g::2] - x[g::2].mean(axis=0)
        want = np.einsum("ij,jk,ik->i", part, np.linalg.inv(np.cov(part.T)), part)
        assert np.allclose(got[g::2], want, rtol=1e-6)
    cov = np.eye(d) * 2.0
    dens = [r[0] for r in df.orderBy("id").select(gaussian_pdf(df, "x", x[0], cov)).collect()]
    want = np.exp(-0.25 * ((x - x[0]) ** 2).sum(axis=1)) / np.sqrt((2 * np.pi * 2.0) ** d)
    assert np.allclose(dens, want, rtol=1e-8)
