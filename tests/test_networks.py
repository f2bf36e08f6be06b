import numpy as np
import pytest

from frameml.operators import neural as N

XOR, XOR_Y = np.array([[0.0, 0], [0, 1], [1, 0], [1, 1]]), np.array([0.0, 1, 1, 0])


def outputs(df, net, **options):
    got = N.mlp_predict(df, net, "x", **options).orderBy("id").collect()
    return np.array([r["out"] for r in got])


def test_xor(make):
    df = make(XOR, XOR_Y).repartition(1)
    net = N.mlp_fit(df, "x", "y", hidden=[8], loss="mse", optimizer="adam", lr=0.05, epochs=200, clip=1.0, seed=0)
    assert np.abs(outputs(df, net)[:, 0] - XOR_Y).max() <= 0.1
    losses = [v for _, v in net.history]
    assert len(losses) == 200 and losses[-1] < losses[0]


def test_three_classes(make):
    df = make([[1.0, 0], [0, 1], [1, 1]], [0, 1, 2]).repartition(1)
    net = N.mlp_fit(df, "x", "y", hidden=[5], outputs=3, loss="ce", optimizer="adam", lr=0.05, epochs=120, seed=1)
    probs = outputs(df, net, probabilities=True)
    assert probs.argmax(1).tolist() == [0, 1, 2] and np.allclose(probs.sum(1), 1)


def loss_of(net, x, y, loss):
    out, _ = N._forward(x, net.layers)
    return N._loss_and_grad(out, y, loss)[0] / len(x)


@pytest.mark.parametrize("hidden,loss", [("relu", "mse"), ("tanh", "ce"), ("sigmoid", "ce")])
def test_one_step_follows_the_numeric_gradient(make, hidden, loss):
    r = np.random.default_rng(6)
    x, y = r.normal(size=(40, 3)), r.integers(0, 4, 40).astype(float)
    start = N.mlp(3, [5, 1 if loss == "mse" else 4], seed=2, hidden=hidden)
    moved = N.mlp_fit(make(x, y).repartition(3), "x", "y", start, loss=loss, lr=1.0)
    h = 1e-5
    for k, layer in enumerate(start.layers):
        if layer.kind != "linear":
            continue
        for at in [(0, 0), (2, 0)]:
            def shifted(e):
                w = layer.w.copy()
                w[at] += e
                return N.Network((*start.layers[:k], N.Layer("linear", w, layer.b), *start.layers[k + 1:]))
            slope = (loss_of(shifted(h), x, y, loss) - loss_of(shifted(-h), x, y, loss)) / (2 * h)
            assert np.isclose(layer.w[at] - moved.layers[k].w[at], slope, atol=1e-5)


def test_partitioning_and_batches(make):
    r = np.random.default_rng(7)
    df = make(r.normal(size=(60, 2)), r.integers(0, 2, 60))
    fit = lambda d, **o: N.mlp_fit(d, "x", "y", hidden=[4], outputs=2, loss="ce", lr=0.1, momentum=0.9, epochs=3, **o)
    a, b = fit(df.repartition(1)), fit(df.repartition(7))
    assert np.allclose(a.layers[0].w, b.layers[0].w)
    c = fit(df.repartition(1), batches=3, id="id")
    d = fit(df.repartition(5), batches=3, id="id")
    assert np.allclose(c.layers[0].w, d.layers[0].w) and len(c.history) == 9
    assert not np.allclose(a.layers[0].w, c.layers[0].w)


def test_dropout_trains_reproducibly_and_is_off_when_scoring(make):
    r = np.random.default_rng(8)
    df = make(r.normal(size=(50, 2)), r.integers(0, 2, 50))
    net = N.mlp(2, [6, 2], seed=3, dropout=0.5)
    assert [l.kind for l in net.layers] == ["linear", "relu", "dropout", "linear"]
    fit = lambda d: N.mlp_fit(d, "x", "y", net, loss="ce", lr=0.1, epochs=2, id="id", seed=3)
    a, b = fit(df.repartition(1)), fit(df.repartition(6))
    assert np.allclose(a.layers[0].w, b.layers[0].w)
    plain = N.Network(tuple(l for l in a.layers if l.kind != "dropout"))
    assert np.allclose(outputs(df, a), outputs(df, plain))
    mask = N._mask(np.arange(5000), 8, 0.3, np.uint64(12345))
    assert abs((mask == 0).mean() - 0.3) < 0.01 and np.allclose(mask[mask > 0], 1 / 0.7)
    with pytest.raises(ValueError):
        N.mlp_fit(df, "x", "y", net, loss="ce")


def test_optimizer_rules():
    g = np.array([1.0, -2.0])
    sgd = N._Sgd(0.1, 0.9)
    assert np.allclose(sgd.delta(g), -0.1 * g) and np.allclose(sgd.delta(g), -0.19 * g)
    adam = N._Adam(0.001)
    assert np.allclose(adam.delta(g), -0.001 * np.sign(g), atol=1e-8)


def test_start_weights():
    net = N.mlp(400, [300], seed=9)
    assert abs(net.layers[0].w.std() - np.sqrt(2 / 400)) < 1e-3 and not net.layers[0].b.any()


def test_bad_arguments(make):
    df = make(XOR, XOR_Y)
    for options in ({"loss": "hinge"}, {"optimizer": "lbfgs"}, {"batches": 2}):
        with pytest.raises(ValueError):
            N.mlp_fit(df, "x", "y", **options)
    with pytest.raises(ValueError):
        N.mlp_fit(df, "x", "y", N.mlp(3, [2]))
    with pytest.raises(ValueError):
        N.mlp_fit(make(XOR, [0, 1, 2, 3]), "x", "y", outputs=3, loss="ce")
