import numpy as np
import pytest
from pyspark.sql import functions as F

from frameml.operators import logistic as L, metrics, regression as R, solvers
from frameml.plans.moments import centred_moments, moments

RNG = np.random.default_rng(1)


def test_moments_forms_agree(make):
    x, y, w = RNG.normal(size=(200, 5)), RNG.normal(size=200), None
    df = make(x, y)
    for method in ("narrow", "wide"):
        m = moments(df, "x", "y", method=method)
        assert np.allclose(m.gram, x.T @ x) and np.allclose(m.xy, x.T @ y)
        assert np.isclose(m.yy, y @ y) and m.n == 200 and np.allclose(m.sx, x.sum(0))
        s = moments(df.repartition(7), "x", "y", shift=[1.0] * 5, method=method)
        assert np.allclose(s.mean, x.mean(0)) and np.allclose(s.covariance(), np.cov(x.T))
        v = moments(df, "x", "y", weight=F.abs(F.col("x0")), method=method)
        assert np.allclose(v.gram, (x.T * abs(x[:, 0])) @ x)


def test_centred_moments_keep_digits(make):
    x = RNG.normal(size=(300, 2)) + 1e8
    assert np.allclose(centred_moments(make(x), ["x0", "x1"]).covariance(), np.cov(x.T), rtol=1e-6)


@pytest.mark.parametrize("wide", [False, True])
def test_invalid_rows(spark, make, wide):
    df = make(RNG.normal(size=(20, 2)), RNG.normal(size=20))
    method = "wide" if wide else "narrow"
    for bad in (None, float("nan")):
        broken = df.withColumn("x0", F.when(F.col("id") == 3, F.lit(bad)).otherwise(F.col("x0")))
        with pytest.raises(ValueError, match="1 rows"):
            moments(broken, ["x0", "x1"], "y", method=method)
        assert moments(broken, ["x0", "x1"], "y", method=method, handle_invalid="skip").n == 19
    with pytest.raises(ValueError, match="empty"):
        moments(df.filter("id < 0"), ["x0", "x1"], "y", method=method)
    with pytest.raises(ValueError):
        moments(df, ["x0", "nope"], "y")
    with pytest.raises(ValueError):
        moments(df, ["x0"], "y", handle_invalid="ignore")


def test_linear_closed_form_and_descent(make):
    x1 = np.arange(100) * 0.1
    x2 = RNG.uniform(size=100) * 10
    df = make(np.c_[x1, x2], 3 * x1 + 2 * x2)
    assert np.allclose(R.linear_fit(df, ["x0", "x1"], "y").theta, [3, 2])
    model = R.linear_fit_gd(df, ["x0", "x1"], "y", epochs=1000, lr=0.01)
    assert np.allclose(model.theta, [3, 2], atol=1e-2)
    losses = [v for _, v in model.history]
    assert len(losses) == 10 and all(a >= b for a, b in zip(losses, losses[1:]))
    assert len(R.linear_fit_gd(df, ["x0", "x1"], "y", epochs=3, lr=0.01).history) == 3
    scored = R.linear_predict(df, model, "x")
    assert metrics.mse(scored, "prediction", "y").first()["mse"] < 1e-3


def test_descent_forms_agree(make, monkeypatch):
    df = make(RNG.normal(size=(80, 3)), RNG.normal(size=80))
    a = R.linear_fit_gd(df, "x", "y", epochs=25, lr=0.1, reg=0.2, theta0=[1, 2, 3])
    monkeypatch.setattr(R, "GRAM_WIDTH", 1)
    b = R.linear_fit_gd(df, "x", "y", epochs=25, lr=0.1, reg=0.2, theta0=[1, 2, 3])
    assert np.allclose(a.theta, b.theta) and np.allclose(a.history, b.history)


def test_singular_design_and_ridge(make):
    df = make(np.ones((50, 2)), 2 * np.ones(50))
    with pytest.raises(R.SingularMatrixError):
        R.linear_fit(df, ["x0", "x1"], "y")
    theta = R.linear_fit(df, ["x0", "x1"], "y", reg=10.0).theta
    assert abs(theta[0] - 0.909) < 0.01 and abs(theta[1] - 0.909) < 0.01


def test_collinear_designs_raise(make):
    for seed in range(5):
        x = np.random.default_rng(seed).normal(size=(30, 3))
        with pytest.raises(R.SingularMatrixError):
            R.linear_fit(make(np.c_[x, x @ [1.0, -2, 0.5]], x[:, 0]), "x", "y")


def lasso_on_rows(x, y, reg, epochs=100):
    theta = np.zeros(x.shape[1])
    for _ in range(epochs):
        biggest = 0.0
        for j in range(x.shape[1]):
            z = x[:, j] @ x[:, j]
            if z == 0:
                continue
            rho = x[:, j] @ (y - x @ theta) + z * theta[j]
            new = np.sign(rho) * max(abs(rho) - reg * len(x), 0) / z
            if abs(new - theta[j]) > 1e-5:
                biggest = max(biggest, abs(new - theta[j]))
                theta[j] = new
        if biggest < 1e-4:
            break
    return theta


def test_lasso(make):
    x1 = np.arange(50) % 10
    x2 = (np.arange(50) * 7) % 10 * 0.01
    theta = R.lasso_fit(make(np.c_[x1, x2], x1), "x", "y", reg=0.5).theta
    assert abs(theta[0]) > 0.1 and abs(theta[1]) < 1e-4
    x = np.c_[RNG.normal(size=(60, 4)), np.zeros(60)]
    y = x @ [1.0, -2, 0, 0.3, 9] + RNG.normal(size=60) * 0.1
    assert np.allclose(R.lasso_fit(make(x, y), "x", "y", reg=0.1).theta, lasso_on_rows(x, y, 0.1))


def newton_on_rows(x, y, steps):
    theta = np.zeros(x.shape[1])
    for _ in range(steps):
        h = 1 / (1 + np.exp(-x @ theta))
        hess = x.T @ (x * (h * (1 - h))[:, None]) + 1e-4 * np.eye(x.shape[1])
        theta = theta - np.linalg.solve(hess, x.T @ (h - y))
    return theta


def test_logistic_or_gate(make):
    x = np.array([[1, 0, 0], [1, 0, 1], [1, 1, 0], [1, 1, 1.0]])
    y = np.array([0, 1, 1, 1.0])
    df = make(x, y)
    model = L.logistic_fit(df, "x", "y", max_iters=5)
    assert np.allclose(model.theta, newton_on_rows(x, y, 5)) and len(model.history) == 5
    got = [r["prediction"] for r in L.logistic_predict(df, model, "x").orderBy("id").collect()]
    assert got == [0.0, 1.0, 1.0, 1.0]
    p = [r["probability"] for r in L.logistic_predict_proba(df, model, "x").orderBy("id").collect()]
    assert np.allclose(p, 1 / (1 + np.exp(-x @ np.array(model.theta))))


def test_logistic_wide(make):
    x = RNG.normal(size=(300, 20))
    y = (x[:, 0] + 0.5 * RNG.normal(size=300) > 0).astype(float)
    assert np.allclose(L.logistic_fit(make(x, y), "x", "y", max_iters=4).theta, newton_on_rows(x, y, 4))


def grouped(spark, n=120):
    x = RNG.normal(size=(n, 3)) @ np.array([[1, 0.3, 0], [0, 1, 0.2], [0, 0, 2]]) + 50
    g = np.arange(n) % 3
    y = x @ [1.0, 2, 3] + g
    rows = [(i, f"g{k}", *map(float, r), float(t)) for i, (k, r, t) in enumerate(zip(g, x, y))]
    rows.append((n, "one", 1.0, 2.0, 3.0, 4.0))
    df = spark.createDataFrame(rows, "id long, g string, a double, b double, c double, y double")
    return df, x, g, y


def test_generalized_variance(spark):
    df, x, g, _ = grouped(spark)
    got = {r["g"]: r for r in solvers.generalized_variance(df, "g", ["a", "b", "c"]).collect()}
    for k in range(3):
        assert np.isclose(got[f"g{k}"]["det"], np.linalg.det(np.cov(x[g == k].T)), rtol=1e-8)
    assert got["one"]["det"] is None and got["one"]["n"] == 1
    flat = spark.createDataFrame([(0, float(v), 2.0 * v) for v in range(5)], "g int, a double, b double")
    assert abs(solvers.generalized_variance(flat, "g", ["a", "b"]).first()["det"]) < 1e-12


def test_fit_by_group(spark):
    df, x, g, y = grouped(spark)
    got = {r["g"]: r for r in solvers.linear_fit_by_group(df, "g", ["a", "b", "c"], "y", reg=0.5).collect()}
    for k in range(3):
        z = x[g == k]
        assert np.allclose(got[f"g{k}"]["theta"], np.linalg.solve(z.T @ z + 0.5 * np.eye(3), z.T @ y[g == k]))
    plain = {r["g"]: r for r in solvers.linear_fit_by_group(df, "g", ["a", "b", "c"], "y").collect()}
    assert plain["one"]["status"] == "singular" and plain["one"]["theta"] is None
    assert plain["g0"]["status"] == "ok"


def test_wide_groups(make):
    x, g = RNG.normal(size=(300, 18)) + 5, np.arange(300) % 3
    y = x @ np.arange(18.0)
    df = make(x, y).withColumn("g", F.when(F.col("id") % 3 == 2, F.lit(None)).otherwise(F.col("id") % 3)).repartition(4)
    fits = {r["g"]: r for r in solvers.linear_fit_by_group(df, "g", "x", "y", reg=0.5).collect()}
    dets = {r["g"]: r["det"] for r in solvers.generalized_variance(df, "g", "x").collect()}
    for key, k in ((0, 0), (1, 1), (None, 2)):
        z = x[g == k]
        assert fits[key]["n"] == 100
        assert np.allclose(fits[key]["theta"], np.linalg.solve(z.T @ z + 0.5 * np.eye(18), z.T @ y[g == k]))
        assert np.isclose(dets[key], np.linalg.det(np.cov(z.T)), rtol=1e-6)
    broken = df.withColumn("y", F.when(F.col("id") == 5, float("nan")).otherwise(F.col("y")))
    with pytest.raises(Exception, match="null or NaN"):
        solvers.linear_fit_by_group(broken, "g", "x", "y").collect()


def test_nan_inside_a_wide_array(make):
    df = make(RNG.normal(size=(30, 20)), RNG.normal(size=30))
    for bad in (F.lit(float("nan")), F.lit(None).cast("double")):
        broken = df.withColumn("x", F.when(F.col("id") == 4, F.transform("x", lambda v: bad)).otherwise(F.col("x")))
        with pytest.raises(ValueError, match="1 rows"):
            moments(broken, ("x", 20), "y")
        assert moments(broken, ("x", 20), "y", handle_invalid="skip").n == 29
    short = df.withColumn("x", F.when(F.col("id") < 2, F.slice("x", 1, 3)).otherwise(F.col("x")))
    with pytest.raises(ValueError, match="2 rows"):
        moments(short, ("x", 20), "y")


def test_group_columns_may_have_any_name(make):
    df = make(RNG.normal(size=(40, 2)), np.arange(40) % 2)
    for name in ("y", "x0", "m", "r", "bad", "mu"):
        named = df.select((F.col("y") + 1).alias("label"), F.col("x0").alias("u"), F.col("x1").alias("w"),
                          F.col("y").alias(name))
        assert solvers.linear_fit_by_group(named, name, ["u", "w"], "label", reg=1.0).count() == 2
        assert solvers.generalized_variance(named, name, ["u", "w"]).columns == [name, "n", "det"]
    assert solvers.mahalanobis(named, ["u", "w"], name).filter("distance_sq > 0").count() == 40


def test_cholesky_factor():
    a = np.array([[4.0, 12, -16], [12, 37, -43], [-16, -43, 98]])
    low = R.cholesky(a)
    assert np.allclose([low[0, 0], low[1, 0], low[2, 2]], [2, 6, 3]) and np.allclose(low @ low.T, a)


def test_whiten(make):
    x = RNG.normal(size=(400, 3)) @ RNG.normal(size=(3, 3)) + 7
    got = np.array([[r["w0"], r["w1"], r["w2"]] for r in solvers.whiten(make(x), "x").collect()])
    assert np.allclose(np.cov(got.T), np.eye(3), atol=1e-8) and np.allclose(got.mean(0), 0, atol=1e-8)
    with pytest.raises(R.SingularMatrixError):
        solvers.whiten(make(np.c_[x[:, 0], 2 * x[:, 0]]), "x")


def test_mahalanobis(spark):
    df, x, g, _ = grouped(spark)
    got = {r["id"]: r["distance_sq"] for r in solvers.mahalanobis(df, ["a", "b", "c"], "g").collect()}
    assert len(got) == 121 and got[120] is None
    for k in range(3):
        z = x[g == k] - x[g == k].mean(0)
        want = np.einsum("ij,jk,ik->i", z, np.linalg.inv(np.cov(z.T)), z)
        assert np.allclose([got[i] for i in np.flatnonzero(g == k)], want)


def test_metrics(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), ("a", 2), ("b", 5)]
    df = spark.createDataFrame(rows, "g string, y int")
    assert {r["g"]: r["impurity"] for r in metrics.gini(df, "y", "g").collect()} == {"a": 0.5, "b": 0.0}
    assert {r["g"]: (r["majority"], r["votes"]) for r in metrics.majority_class(df, "y", "g").collect()} == {
        "a": (1, 2), "b": (5, 1)}
    assert metrics.gini(df.filter("y > 9"), "y").first()["impurity"] == 0.0
    assert metrics.variance_impurity(df.filter("y > 9"), "y").first()["impurity"] == 0.0
    assert np.isclose(metrics.variance_impurity(df, "y").first()["impurity"], np.var([1, 1, 2, 2, 5]))
    probs = spark.createDataFrame([([0.2, 0.8], 1), ([0.5, 0.5], 0)], "p array<double>, y int")
    assert np.isclose(metrics.cross_entropy(probs, "p", "y").first()[0], -np.log(0.8 + 1e-7) - np.log(0.5 + 1e-7))
