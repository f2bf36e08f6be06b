import numpy as np
import pytest

from frameml.operators import clustering as K, decomposition as D, mixture as G
from frameml.plans import reduce

RNG = np.random.default_rng(2)


@pytest.mark.parametrize("method", ["gram", "qr"])
def test_svd_rebuilds(make, method):
    a = RNG.normal(size=(60, 5))
    df = make(a).repartition(6)
    model = D.svd(df, "x", method=method)
    assert np.allclose(model.s, np.linalg.svd(a, compute_uv=False))
    got = D.svd_left(df, model, "x").orderBy("id").collect()
    u = np.array([r["u"] for r in got])
    assert np.allclose(u @ np.diag(model.s) @ np.array(model.v), a, atol=1e-8)
    assert np.allclose(u.T @ u, np.eye(5), atol=1e-8)


@pytest.mark.parametrize("blocks", [2_000_000, 20])
def test_svd_of_wide_tables(make, monkeypatch, blocks):
    """Fewer rows than columns: values, right angles and the table itself, also without full rank."""
    monkeypatch.setattr(D, "BLOCK_CELLS", blocks)
    rng = np.random.default_rng(8)
    for a in (np.array([[3.0, 2, 2], [2, 3, -2]]), rng.normal(size=(4, 23)), np.outer([1.0, 2, 0], rng.normal(size=19))):
        df = make(a)
        for method in ("gram", "qr"):
            model = D.svd(df, "x", method=method)
            v = np.array(model.v)
            assert v.shape == a.shape and np.allclose(v @ v.T, np.eye(len(a)), atol=1e-7)
            assert np.allclose(model.s, np.linalg.svd(a, compute_uv=False), atol=1e-7)
            left = D.svd_left(df, model, "x").orderBy("id").collect()
            assert np.allclose(np.array([r["u"] for r in left]) * model.s @ v, a, atol=1e-7)
    assert len(D.svd(make(a), "x", k=2).s) == 2
    with pytest.raises(ValueError):
        D.svd(make(a), "x", k=4)


def test_svd_of_the_small_fixture(make):
    a = np.array([[3.0, 2, 2], [2, 3, -2]]).T
    assert np.allclose(D.svd(make(a), "x").s, [5, 3])
    with pytest.raises(ValueError):
        D.svd(make(a), "x", k=3)


def test_qr_keeps_small_singular_values(make):
    q, _ = np.linalg.qr(RNG.normal(size=(50, 3)))
    a = q @ np.diag([1.0, 1e-4, 1e-9]) @ np.linalg.qr(RNG.normal(size=(3, 3)))[0]
    assert np.allclose(D.svd(make(a), "x", method="qr").s, [1, 1e-4, 1e-9], rtol=1e-5)


def test_pca(make):
    x1 = np.arange(10.0)
    x = np.c_[x1, x1 + RNG.uniform(0, 0.2, 10)]
    df = make(x)
    model = D.pca_fit(df, "x", 1)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.isclose(model.explained_variance[0], values[-1])
    assert np.allclose(np.abs(model.components[0]), np.abs(vectors[:, -1]))
    assert max(model.components[0], key=abs) > 0
    back = D.pca_inverse_transform(D.pca_transform(df, model, "x"), model, "z").orderBy("id").collect()
    assert ((np.array([r["x_hat"] for r in back]) - x) ** 2).mean() < 0.1
    with pytest.raises(ValueError):
        D.pca_fit(df, "x", 3)


def blobs():
    r = np.random.default_rng(3)
    return np.r_[r.uniform(0, 2, (20, 2)), 10 + r.uniform(0, 2, (20, 2))]


def lloyd(x, centres, rounds):
    c = np.array(centres, dtype=float)
    near = None
    for _ in range(rounds):
        new = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        if near is not None and (new == near).all():
            break
        near = new
        c = np.array([x[near == k].mean(0) if (near == k).any() else c[k] for k in range(len(c))])
    return c


def test_kmeans_blobs(make):
    df = make(blobs())
    model = K.kmeans_fit(df, ["x0", "x1"], 2, id="id", seed=1)
    low, high = sorted(model.centres)
    assert low[0] < 3 and high[0] > 8 and model.converged
    got = [r["cluster"] for r in K.kmeans_predict(df, model, "x").orderBy("id").collect()]
    assert len(set(got[:20])) == 1 and len(set(got[20:])) == 1 and got[0] != got[-1]


@pytest.mark.parametrize("limit", [2000, 1])
def test_kmeans_forms_match_numpy(make, monkeypatch, limit):
    monkeypatch.setattr(K, "MAX_LITERAL_TERMS", limit)
    x = RNG.normal(size=(150, 4))
    init = [*x[:4], [50.0] * 4]
    df = make(x)
    for rounds in (1, 4, 100):
        model = K.kmeans_fit(df, "x", 5, max_iters=rounds, init=init)
        assert np.allclose(model.centres, lloyd(x, init, rounds))
    assert model.converged and tuple(model.centres[4]) == (50.0,) * 4


def test_kmeans_start(make):
    x = np.r_[np.zeros((30, 2)), np.ones((2, 2)) * 9, [[0.0, 30.0]]]
    df = make(x)
    a = K.kmeans_init_pp(df, ["x0", "x1"], 3, "id", seed=4)
    assert len({tuple(c) for c in a}) == 3
    b = K.kmeans_init_pp(df.repartition(7), ["x0", "x1"], 3, "id", seed=4)
    assert np.array_equal(a, b)
    same = K.kmeans_init_pp(make(np.ones((6, 2))), ["x0", "x1"], 3, "id")
    assert np.array_equal(same, np.ones((3, 2)))
    with pytest.raises(ValueError):
        K.kmeans_init_pp(make(np.ones((2, 2))), ["x0", "x1"], 3, "id")


def test_kmeans_start_follows_squared_distance(spark):
    """Second centre given the first: share of picks close to d^2 weights."""
    from pyspark.sql import functions as F
    from frameml.plans.randomness import uniform
    weights = [1.0, 4.0, 5.0]
    rows = spark.range(3).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("id") + 1).cast("int")))
    draws = rows.crossJoin(spark.range(6000).withColumnRenamed("id", "draw"))
    keyed = draws.withColumn("key", -F.log(uniform("id", "draw", seed=1)) / F.col("w"))
    picks = keyed.groupBy("draw").agg(F.min_by("id", "key").alias("id")).groupBy("id").count().collect()
    share = {r["id"]: r["count"] / 6000 for r in picks}
    assert all(abs(share[i] - w / 10) < 0.03 for i, w in enumerate(weights))


def em(x, means, k, rounds):
    d = x.shape[1]
    means, covs, weights = np.array(means, float), np.array([np.eye(d)] * k), np.full(k, 1 / k)
    for _ in range(rounds):
        dens = np.stack([weights[j] * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - means[j], np.linalg.inv(covs[j]), x - means[j]))
                         / np.sqrt((2 * np.pi) ** d * max(np.linalg.det(covs[j]), 1e-9)) for j in range(k)], 1)
        r = dens / dens.sum(1, keepdims=True)
        nk = r.sum(0)
        means = (r.T @ x) / nk[:, None]
        covs = np.array([((x - means[j]).T * r[:, j]) @ (x - means[j]) / nk[j] + 1e-5 * np.eye(d) for j in range(k)])
        weights = nk / len(x)
    return weights, means, covs


@pytest.mark.parametrize("limit", [2000, 1])
def test_mixture_matches_numpy(make, monkeypatch, limit):
    monkeypatch.setattr(G, "MAX_LITERAL_TERMS", limit)
    x = np.r_[RNG.normal(size=(60, 3)), RNG.normal(size=(40, 3)) * 0.5 + 3]
    df, start = make(x), [x[0], x[-1]]
    history = []
    model = G.gmm_fit(df, "x", 2, max_iters=6, init=start, history=history)
    weights, means, covs = em(x, start, 2, 6)
    assert np.allclose(model.weights, weights) and np.allclose(model.means, means)
    assert np.allclose(model.covariances, covs)
    assert all(b >= a - 1e-6 for a, b in zip(history, history[1:]))
    probs = np.array([r["probability"] for r in G.gmm_predict_proba(df, model, "x").orderBy("id").collect()])
    assert np.allclose(probs.sum(1), 1)
    got = [r["component"] for r in G.gmm_predict(df, model, "x").orderBy("id").collect()]
    assert np.array_equal(got, probs.argmax(1))


def test_mixture_from_kmeans(make):
    r = np.random.default_rng(5)
    x = np.r_[np.c_[r.uniform(2, 4, 50), r.uniform(2, 4, 50)], r.uniform(8, 10, (50, 2))]
    model = G.gmm_fit(make(x), "x", 2, max_iters=10, id="id", seed=1)
    low, high = sorted(model.means)
    assert max(low) < 5 < min(high)


def test_far_points_keep_finite_probabilities(make):
    model = G.MixtureModel((0.5, 0.5), ((0.0, 0.0), (1.0, 1.0)), (((1.0, 0.0), (0.0, 1.0)),) * 2)
    got = G.gmm_predict_proba(make([[500.0, 500.0]]), model, "x").first()["probability"]
    assert np.isfinite(got).all() and abs(sum(got) - 1) < 1e-12 and got[1] > 0.99


def test_gaussian_pdf_floors_the_determinant(make):
    df = make([[0.0, 0.0], [1.0, 2.0]])
    cov = [[0.5, 0.1], [0.1, 0.3]]
    got = [r[0] for r in df.orderBy("id").select(G.gaussian_pdf(df, "x", [0.0, 0.0], cov)).collect()]
    x = np.array([[0, 0], [1, 2.0]])
    quad = np.einsum("ij,jk,ik->i", x, np.linalg.inv(cov), x)
    assert np.allclose(got, np.exp(-quad / 2) / (2 * np.pi * np.sqrt(np.linalg.det(cov))))
    tiny = df.select(G.gaussian_pdf(df, "x", [0.0, 0.0], [[1e-6, 0], [0, 1e-6]])).first()[0]
    assert np.isclose(tiny, 1 / (2 * np.pi * np.sqrt(1e-9)))


def test_partitioning_does_not_change_fits(make):
    x = RNG.normal(size=(90, 3))
    df = make(x)
    for frame in (df.repartition(1), df.repartition(7)):
        assert np.allclose(K.kmeans_fit(frame, "x", 3, init=x[:3]).centres, lloyd(x, x[:3], 100))
        assert np.allclose(D.pca_fit(frame, "x", 2).explained_variance,
                           np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1][:2])


def test_invalid_input(make):
    df = make(np.ones((4, 2)))
    with pytest.raises(ValueError):
        K.kmeans_fit(df, "x", 2)
    with pytest.raises(ValueError):
        K.kmeans_fit(df, "x", 2, init=[[1.0, 2.0]])
    with pytest.raises(ValueError):
        K.kmeans_fit(df.filter("id < 0"), ["x0", "x1"], 1, init=[[0.0, 0.0]])
    with pytest.raises(ValueError):
        G.gmm_fit(df, "x", 2, init=[[1.0, 2.0]])
    assert reduce.MAX_LITERAL_TERMS > 1
