"""Broadcast bounds, rolling copies, and the rule for invalid rows in the metrics."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameml.operators import boosting, clustering as K, metrics
from frameml.plans import lineage
from frameml.plans.reduce import as_numpy


def test_a_broadcast_is_bounded_in_bytes(spark, monkeypatch):
    """Few rows of wide arrays are as large as many narrow ones."""
    wide = spark.range(50).select("id", F.array_repeat(F.lit(1.5), 1000).alias("x"), F.lit("abc").alias("s"))
    assert wide.agg(F.sum(lineage.row_bytes(wide))).first()[0] == 50 * (8 + 8008 + 11)
    rows = spark.range(500).select((F.col("id") % 50).alias("id"))
    hinted = lambda df: "BroadcastHashJoin" in df._jdf.queryExecution().optimizedPlan().toString() or "strategy=broadcast" in (
        df._jdf.queryExecution().optimizedPlan().toString())
    assert hinted(lineage.join_summary(rows, wide, "id"))
    monkeypatch.setattr(lineage, "BROADCAST_BYTES", 100_000)
    assert not hinted(lineage.join_summary(rows, wide, "id"))
    assert hinted(lineage.join_summary(rows, wide.select("id"), "id"))
    assert not hinted(lineage.join_summary(rows, wide.select("id"), "id", limit=49))
    nested = spark.createDataFrame([(1, [("a", 2)], {"k": 1}, None)], "id int, a array<struct<s:string,n:int>>, m map<string,int>, d double")
    assert nested.agg(F.sum(lineage.row_bytes(nested))).first()[0] > 32


def local(folder):
    return folder.removeprefix("file:")


def test_one_live_copy(spark):
    rolling = lineage.Rolling(spark)
    for n in range(4):
        got = rolling.keep(spark.range(n + 3).withColumn("x", F.array(F.lit(float(n)))))
        assert got.count() == n + 3 and os.listdir(local(rolling.folder)) == [str(n)]
    rolling.close()
    assert not os.path.exists(local(rolling.folder))


def test_fits_leave_no_copies(spark, make, monkeypatch):
    made = []

    class Spy(lineage.Rolling):
        def keep(self, df):
            out = super().keep(df)
            made.append((local(self.folder), len(os.listdir(local(self.folder)))))
            return out

    monkeypatch.setattr(boosting, "Rolling", Spy)
    monkeypatch.setattr(boosting, "TREES_PER_CHECKPOINT", 2)
    monkeypatch.setattr(K, "Rolling", Spy)
    monkeypatch.setattr(K, "ROUNDS_PER_COPY", 2)
    x = np.random.default_rng(0).normal(size=(60, 2))
    boosting.gbt_fit(make(x, x[:, 0] ** 2), "x", "y", 7, max_depth=1)
    K.kmeans_init_pp(make(x), "x", 7, "id")
    assert len(made) == 6 and {n for _, n in made} == {1}
    assert not any(os.path.exists(folder) for folder, _ in made)


def test_kmeans_start_equals_a_plain_one(spark, make):
    """Carried distances give the draws of distances to all centres."""
    x = np.round(np.random.default_rng(1).normal(size=(80, 3)), 1)
    df = make(x)
    got = K.kmeans_init_pp(df, "x", 6, "id", seed=5)
    u = np.array([[r[f"u{s}"] for s in range(6)] for r in df.select("id", *(
        K.uniform("id", F.lit(s).cast("long"), seed=5).alias(f"u{s}") for s in range(6))).orderBy("id").collect()])
    centres = [x[np.argmin(-np.log(u[:, 0]))]]
    for s in range(1, 6):
        gap = np.min([((x - c) ** 2).sum(axis=1) for c in centres], axis=0)
        with np.errstate(divide="ignore"):
            centres.append(x[np.argmin(np.where(gap > 0, -np.log(u[:, s]) / gap, np.inf))])
    assert np.allclose(got, centres)


NULLED = [("a", 1.0, 2.0, [0.5, 0.5]), ("a", None, 9.0, [0.9, 0.1]), ("b", 3.0, float("nan"), None), (None, 4.0, 4.0, [0.2, 0.8])]


@pytest.mark.parametrize("metric, columns, skipped", [
    (metrics.mse, ("p", "y"), {"a": 1.0, None: 0.0}), (metrics.half_mse, ("p", "y"), {"a": 0.5, None: 0.0}),
    (metrics.variance_impurity, ("p",), {"a": 0.0, "b": 0.0, None: 0.0}), (metrics.gini, ("p",), {"a": 0.0, "b": 0.0, None: 0.0}),
    (metrics.majority_class, ("y",), {"a": 2.0, None: 4.0}),
    (metrics.cross_entropy, ("q", "c"), {"a": -np.log(0.5 + 1e-7) - np.log(0.1 + 1e-7), None: -np.log(0.8 + 1e-7)})])
def test_metrics_refuse_or_skip_invalid_rows(spark, metric, columns, skipped):
    df = spark.createDataFrame(NULLED, "g string, p double, y double, q array<double>").withColumn("c", F.lit(1))
    with pytest.raises(Exception, match="1 rows hold a null or NaN"):
        metric(df, *columns, by="g").collect()
    got = {r["g"]: r[1] for r in metric(df, *columns, by="g", handle_invalid="skip").collect()}
    assert got.keys() == skipped.keys() and all(np.isclose(got[k], v) for k, v in skipped.items())
    assert metric(df.filter("g is null"), *columns, by="g").count() == 1
    with pytest.raises(ValueError):
        metric(df, *columns, handle_invalid="drop")


def test_means_refuse_or_skip(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 9.0)], "a double, b double")
    with pytest.raises(Exception, match="1 rows hold"):
        metrics.column_means(df, ["a", "b"]).collect()
    assert tuple(metrics.column_means(df, ["a", "b"], handle_invalid="skip").first()) == (1.0, 2.0)


def test_labels_outside_the_probabilities(spark):
    df = spark.createDataFrame([([0.5, 0.5], 2), ([0.5, 0.5], -1), ([1.0], 0)], "q array<double>, c int")
    with pytest.raises(Exception, match="2 rows hold"):
        metrics.cross_entropy(df, "q", "c").collect()


def test_ragged_arrays_are_refused():
    import pyarrow as pa

    assert as_numpy(pa.array([[1.0, 2], [3, 4]])).shape == (2, 2)
    with pytest.raises(ValueError, match="1 to 3"):
        as_numpy(pa.array([[1.0], [2, 3, 4]]))


def test_cut_lineage_drops_the_shuffle_files(spark):
    import time

    from frameml.plans.lineage import cut_lineage

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = {f.getName() for f in _java_list(spark, disk.getAllFiles())}
    rows = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
    cut = cut_lineage(rows)
    for _ in range(100):
        left = [f.getName() for f in _java_list(spark, disk.getAllFiles())]
        left = [name for name in left if name.startswith("shuffle_") and name not in before]
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(setting) == "false"
    # Neither the frame that was cut nor what was cut from it needs those files.
    assert cut.agg({"count": "sum"}).first()[0] == rows.agg({"count": "sum"}).first()[0] == 1000


def _java_list(spark, files):
    return list(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files))
