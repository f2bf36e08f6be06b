import numpy as np
import pytest
from pyspark.sql import functions as F

from frameml.operators import boosting as B, metrics, trees as T
from frameml.plans import lineage, splits

RNG = np.random.default_rng(4)


def impurity(y, classes):
    if classes is None:
        return y.var() if len(y) else 0.0
    return 1 - sum(((y == c).mean()) ** 2 for c in classes) if len(y) else 0.0


def search(x, y, classes=None):
    """Every feature and observed threshold; gain, then feature, then value."""
    parent, best = impurity(y, classes), None
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f]):
            left = x[:, f] <= v
            if left.all():
                continue
            after = (left.sum() * impurity(y[left], classes) + (~left).sum() * impurity(y[~left], classes)) / len(y)
            gain = parent - after
            share = round(gain / parent, 9) if parent > 0 else 0.0
            if best is None or share > best[0]:
                best = (share, f, v, gain)
    return best


def grow(x, y, depth, classes=None):
    """Predictions of a recursive tree on its own rows."""
    if classes is None:
        leaf, stop = y.mean(), len(y) < 2
    else:
        counts = [(y == c).sum() for c in classes]
        leaf, stop = classes[int(np.argmax(counts))], impurity(y, classes) < 1e-6 or len(y) < 2
    best = None if depth == 0 or stop else search(x, y, classes)
    if best is None or (classes is None and best[3] < 1e-5):
        return np.full(len(y), leaf)
    left = x[:, best[1]] <= best[2]
    out = np.empty(len(y))
    out[left] = grow(x[left], y[left], depth - 1, classes)
    out[~left] = grow(x[~left], y[~left], depth - 1, classes)
    return out


@pytest.fixture(params=["whole", "binned", "many open bins"])
def bins(request, monkeypatch):
    """The same answers without bins, with bins, and without the broadcast of
    open bins."""
    if request.param != "whole":
        monkeypatch.setattr(splits, "ROWS_PER_BIN", 12)
        monkeypatch.setattr(splits, "FEW_VALUES", 1)
    if request.param == "many open bins":
        monkeypatch.setattr(lineage, "BROADCAST_ROWS", 0)
    return request.param


def data(n=150, ties=True):
    x = RNG.normal(size=(n, 3))
    if ties:
        x[:, 1] = np.round(x[:, 1])
        x[: n // 3, 2] = 0.25
    return x, np.round(x[:, 0] * 2 + (x[:, 1] > 0) + RNG.normal(size=n), 2)


def test_variance_split(make, bins):
    for ties in (False, True):
        x, y = data(ties=ties)
        got = T.best_split_variance(make(x, y), "x", "y").first()
        share, f, v, gain = search(x, y)
        assert (got["feature"], got["threshold"]) == (f, v) and np.isclose(got["gain"], gain)
        assert got["n"] == len(x) and got["n_left"] == (x[:, f] <= v).sum()


def test_gini_split(make, bins):
    x, y = data()
    c = (np.digitize(y, [-1, 1])).astype(float)
    got = T.best_split_gini(make(x, c), "x", "y").first()
    share, f, v, gain = search(x, c, [0.0, 1.0, 2.0])
    assert (got["feature"], got["threshold"]) == (f, v) and np.isclose(got["gain"], gain)


def test_split_by_group(make, bins):
    x, y = data()
    g = (np.arange(len(x)) % 5 == 0).astype(int)
    df = make(x, y).withColumn("g", F.when(F.col("id") % 5 == 0, 1).otherwise(0))
    for r in T.best_split_variance(df, "x", "y", by="g").collect():
        _, f, v, gain = search(x[g == r["node"]], y[g == r["node"]])
        assert (r["feature"], r["threshold"]) == (f, v) and np.isclose(r["gain"], gain)


def test_offset_labels_keep_their_gain(make):
    x, y = data()
    far = T.best_split_variance(make(x, y + 1e7), "x", "y").first()
    near = T.best_split_variance(make(x, y), "x", "y").first()
    assert far["threshold"] == near["threshold"] and np.isclose(far["gain"], near["gain"], rtol=1e-6)


def test_regressor_matches_recursion(make, bins):
    x, y = data()
    df = make(x, y)
    model = T.tree_regressor_fit(df, "x", "y", max_depth=3)
    got = [r["prediction"] for r in T.tree_predict(df, model, "x").orderBy("id").collect()]
    assert np.allclose(got, grow(x, y, 3))


def test_classifier_matches_recursion(make, bins):
    x, y = data()
    c = (np.digitize(y, [-1, 1])).astype(float)
    df = make(x, c)
    model = T.tree_classifier_fit(df, "x", "y", max_depth=3)
    got = [r["prediction"] for r in T.tree_predict(df, model, "x").orderBy("id").collect()]
    assert np.array_equal(got, grow(x, c, 3, [0.0, 1.0, 2.0]))


def test_bins_rule_out_rows(make, monkeypatch):
    """With a clear best split few bins stay open."""
    x = np.arange(600.0).reshape(-1, 1)
    y = (x[:, 0] > 299).astype(float) * 10
    monkeypatch.setattr(splits, "ROWS_PER_BIN", 12)
    monkeypatch.setattr(splits, "FEW_VALUES", 1)
    seen = {}
    original = splits._by_value

    def spy(long, keys, k):
        seen["rows"] = long.count()
        return original(long, keys, k)

    monkeypatch.setattr(splits, "_by_value", spy)
    got = T.best_split_variance(make(x, y), "x", "y").first()
    assert got["threshold"] == 299.0 and seen["rows"] < 60


def test_square_regression_tree(make):
    x = -5 + 0.5 * np.arange(20)
    df = make(x.reshape(-1, 1), x * x)
    model = T.tree_regressor_fit(df, ["x0"], "y", max_depth=5)
    assert metrics.mse(T.tree_predict(df, model, ["x0"]), "prediction", "y").first()["mse"] < 1.0


def test_xor_needs_a_split_without_gain(make):
    x, y = np.array([[0.0, 0], [0, 1], [1, 0], [1, 1]]), np.array([0.0, 1, 1, 0])
    df = make(x, y)
    model = T.tree_classifier_fit(df, "x", "y", max_depth=4)
    got = [r["prediction"] for r in T.tree_predict(df, model, "x").orderBy("id").collect()]
    assert got == [0.0, 1.0, 1.0, 0.0]
    assert len(T.tree_regressor_fit(df, "x", "y", max_depth=4).nodes) == 1


def test_stopping_rules(make):
    x, y = data(60)
    df = make(x, y)
    assert len(T.tree_regressor_fit(df, "x", "y", max_depth=0).nodes) == 1
    assert len(T.tree_regressor_fit(df, "x", "y", min_samples_split=61).nodes) == 1
    assert len(T.tree_regressor_fit(make(x, np.ones(60)), "x", "y").nodes) == 1
    assert len(T.tree_classifier_fit(make(np.ones((6, 2)), [0, 0, 1, 1, 2, 2]), "x", "y").nodes) == 1
    assert T.tree_classifier_fit(make(np.ones((6, 2)), [2, 2, 1, 1, 0, 0]), "x", "y").nodes[0].value == 0.0


def test_batch_walk_equals_case(make, monkeypatch):
    x, y = data(80)
    df = make(x, y)
    model = T.tree_regressor_fit(df, "x", "y", max_depth=4)
    by_case = [r["prediction"] for r in T.tree_predict(df, model, "x").orderBy("id").collect()]
    monkeypatch.setattr(T, "MAX_CASE_LEAVES", 1)
    walked = [r["prediction"] for r in T.tree_predict(df, model, "x").orderBy("id").collect()]
    assert by_case == walked
    assert T.tree_regressor_fit(df, "x", "y", max_depth=4) == model


def boost(x, y, n, lr, depth):
    f = np.full(len(y), y.mean())
    for _ in range(n):
        f = f + lr * grow(x, y - f, depth)
    return f


def test_boosting_matches_recursion(make, monkeypatch):
    monkeypatch.setattr(B, "TREES_PER_CHECKPOINT", 2)
    monkeypatch.setattr(B, "TREES_PER_PROJECTION", 2)
    x, y = data(100, ties=False)
    df = make(x, y)
    model = B.gbt_fit(df, "x", "y", n_estimators=5, lr=0.3, max_depth=2)
    got = [r["prediction"] for r in B.gbt_predict(df, model, "x").orderBy("id").collect()]
    assert np.allclose(got, boost(x, y, 5, 0.3, 2))
    assert np.isclose(model.history[0][1], ((y - boost(x, y, 1, 0.3, 2)) ** 2).mean())


def test_boosting_square(make):
    x = -5 + 0.2 * np.arange(50)
    df = make(x.reshape(-1, 1), x * x)
    model = B.gbt_fit(df, ["x0"], "y", n_estimators=50, lr=0.1, max_depth=2)
    error = metrics.mse(B.gbt_predict(df, model, ["x0"]), "prediction", "y").first()["mse"]
    assert error < 0.5 and [t for t, _ in model.history] == [0, 10, 20, 30, 40]
    assert model.history[-1][1] < model.history[0][1]


def test_invalid_rows(make):
    x, y = data(20)
    broken = make(x, y).withColumn("y", F.when(F.col("id") == 3, F.lit(None)).otherwise(F.col("y")))
    with pytest.raises(ValueError):
        T.tree_regressor_fit(broken, ["x0", "x1"], "y")
    assert T.tree_regressor_fit(broken, ["x0", "x1"], "y", handle_invalid="skip").nodes


def test_long_gini_equals_columns(make, monkeypatch):
    """The search over (value, class) lines gives the splits of the search over class columns."""
    monkeypatch.setattr(splits, "FEW_CLASSES", 1)
    x, y = data()
    c = (np.digitize(y, [-1, 1])).astype(float)
    df = make(x, c)
    got = T.best_split_gini(df, "x", "y").first()
    share, f, v, gain = search(x, c, [0.0, 1.0, 2.0])
    assert (got["feature"], got["threshold"]) == (f, v) and np.isclose(got["gain"], gain)
    model = T.tree_classifier_fit(df, "x", "y", max_depth=3)
    got = [r["prediction"] for r in T.tree_predict(df, model, "x").orderBy("id").collect()]
    assert np.array_equal(got, grow(x, c, 3, [0.0, 1.0, 2.0]))


def test_more_classes_than_rows_of_any(make):
    """40 classes in 120 rows, groups with text keys, one of them pure."""
    x, _ = data(120)
    c = np.arange(120) % 40.0
    g = np.arange(120) % 3
    c[g == 2] = 5.0
    df = make(x, c).withColumn("g", F.concat(F.lit("k"), (F.col("id") % 3).cast("string")))
    got = {r["node"]: r for r in T.best_split_gini(df, "x", "y", by="g").collect()}
    for k in (0, 1):
        share, f, v, gain = search(x[g == k], c[g == k], sorted(set(c)))
        r = got[f"k{k}"]
        assert (r["feature"], r["threshold"]) == (f, v) and np.isclose(r["gain"], gain)
    assert got["k2"]["gain"] == 0.0


def test_running_sums_over_many_partitions(spark):
    from frameml.plans.running import running_sums

    rows = [(g, o, float(o % 7), 1.0) for g, n in ((None, 40), ("a", 3), ("big", 3000), ("c", 1)) for o in range(n)]
    df = spark.createDataFrame(rows, "g string, o int, u double, w double").repartition(5)
    want, total = {}, {}
    for g, o, u, w in rows:
        total[g] = total.get(g, 0.0) + u
        want[g, o] = (total[g], o + 1.0)
    got = running_sums(df, ["g"], ["o"], ["u", "w"])
    assert {(r["g"], r["o"]): (r["run_u"], r["run_w"]) for r in got.collect()} == want
    assert got.select(F.spark_partition_id().alias("p")).where("g = 'big'").distinct().count() > 1
    assert running_sums(df.limit(0), ["g"], ["o"], ["u"]).count() == 0
