import numpy as np
import pytest
from pyspark.sql import functions as F

from frameml.operators import boosting as B, clustering as K, decomposition as D, logistic as L, mixture as G
from frameml.operators import neural as N, regression as R, trees as T
from frameml.plans.lineage import cut_lineage, join_summary
from frameml.sources.models import load_model, save_model
from frameml.sources.tables import read_table
from frameml.streaming.scoring import read_stream, score_available

RNG = np.random.default_rng(9)


@pytest.fixture(scope="module")
def fitted(make):
    x = RNG.normal(size=(80, 3))
    df = make(x, (x[:, 0] > 0).astype(float))
    xs = ["x0", "x1", "x2"]
    models = [
        (R.LinearModel, R.linear_fit(df, xs, "y"), R.linear_predict, {}),
        (L.LogisticModel, L.logistic_fit(df, xs, "y", 3), L.logistic_predict, {}),
        (L.LogisticModel, L.logistic_fit(df, xs, "y", 3), L.logistic_predict_proba, {}),
        (K.KMeansModel, K.kmeans_fit(df, xs, 2, init=x[:2]), K.kmeans_predict, {}),
        (G.MixtureModel, G.gmm_fit(df, xs, 2, 2, init=x[:2]), G.gmm_predict_proba, {}),
        (G.MixtureModel, G.gmm_fit(df, xs, 2, 2, init=x[:2]), G.gmm_predict, {}),
        (D.PcaModel, D.pca_fit(df, xs, 2), D.pca_transform, {}),
        (D.SvdModel, D.svd(df, xs), D.svd_left, {}),
        (T.TreeModel, T.tree_regressor_fit(df, xs, "y", 2), T.tree_predict, {"d": 3}),
        (B.BoostingModel, B.gbt_fit(df, xs, "y", 2, max_depth=1), B.gbt_predict, {"d": 3}),
        (N.Network, N.mlp(3, [4, 2], seed=1), N.mlp_predict, {}),
    ]
    return df.drop("x"), xs, models


def rows(df):
    return sorted(map(str, df.collect()))


def test_saved_models_score_alike(spark, fitted, tmp_path):
    df, xs, models = fitted
    for k, (kind, model, score, options) in enumerate(models):
        path = str(tmp_path / f"m{k}")
        save_model(spark, model, path)
        assert rows(score(df, load_model(spark, kind, path, **options), xs)) == rows(score(df, model, xs))


def test_scoring_a_stream_equals_batch(spark, fitted, tmp_path):
    df, xs, models = fitted
    source = str(tmp_path / "in")
    df.repartition(3).write.parquet(source)
    for k, (_, model, score, _) in enumerate(models):
        stream = read_stream(spark, source, df.schema, pattern="*.parquet", files_per_trigger=1)
        assert stream.isStreaming
        out, state = str(tmp_path / f"out{k}"), str(tmp_path / f"state{k}")
        score_available(stream, lambda s: score(s, model, xs), out, state)
        assert rows(spark.read.parquet(out)) == rows(score(df, model, xs))


def test_scoring_needs_no_shuffle(fitted):
    df, xs, models = fitted
    for _, model, score, _ in models:
        plan = score(df, model, xs)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_batch_scoring_of_null_arrays(spark, monkeypatch):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [3.0, 4.0])], "id long, x array<double>").coalesce(1)
    from frameml.operators import scoring
    monkeypatch.setattr(scoring, "MAX_LITERAL_TERMS", 0)
    out = scoring.dense_layer(df, ("x", 2), [[1.0], [10.0]], [0.5]).orderBy("id").collect()
    assert [r["out"] for r in out] == [[21.5], None, [43.5]]
    one = R.linear_predict(df, R.LinearModel((1.0, 10.0)), ("x", 2)).orderBy("id").collect()
    assert [r["prediction"] for r in one] == [21.0, None, 43.0]


def test_only_needed_columns_are_read(spark):
    table = read_table(spark, "/root/testdata/sf0.001", "lineitem")
    model = R.LinearModel((1.0, 2.0))
    plan = R.linear_predict(table, model, ["l_quantity", "l_discount"]).select("prediction").filter(
        F.col("l_quantity") > 10)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_discount:double>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan
    with pytest.raises(ValueError):
        read_table(spark, "/root/testdata/sf0.001", "lineitems")


def test_summary_join_with_and_without_broadcast(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 4)
    small = spark.range(4).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    a = join_summary(big, small, "k")
    b = join_summary(big, small, "k", limit=2)
    assert rows(a) == rows(b)


def test_lineage_cut_keeps_rows(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    cut = cut_lineage(df)
    assert rows(cut) == rows(df)
    assert "Range" not in cut._jdf.queryExecution().executedPlan().toString()


def test_entry_contract(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
