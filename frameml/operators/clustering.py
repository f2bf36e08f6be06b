"""k-means: k-means++ start, Lloyd iterations, assignment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.functions.vectors import argmin, squared_distance
from frameml.operators.scoring import batch_map
from frameml.plans.features import Features, bad_count, prepare, raise_on_bad, resolve
from frameml.plans.lineage import Rolling
from frameml.plans.randomness import uniform
from frameml.plans.reduce import MAX_LITERAL_TERMS, partition_sums, persisted


# Rounds of the start between two copies of the carried distances in the shared folder.
ROUNDS_PER_COPY = 16


@dataclass(frozen=True)
class KMeansModel:
    centres: tuple[tuple[float, ...], ...]
    iterations: int = 0
    converged: bool = False

    def to_df(self, spark) -> DataFrame:
        rows = [(k, j, float(v)) for k, c in enumerate(self.centres) for j, v in enumerate(c)]
        return spark.createDataFrame(rows, "cluster int, j int, centre double")

    @staticmethod
    def from_df(df: DataFrame) -> "KMeansModel":
        rows = df.orderBy("cluster", "j").collect()
        k = max(r["cluster"] for r in rows) + 1
        return KMeansModel(tuple(tuple(r["centre"] for r in rows if r["cluster"] == c) for c in range(k)))


def _distances(x: Sequence[Column], centres: np.ndarray) -> list[Column]:
    return [squared_distance(x, c) for c in centres]


def _nearest(z: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances without the |x|^2 - 2xc + |c|^2 shortcut, which loses
    digits; one centre at a time keeps memory at the size of the batch."""
    return np.stack([((z - c) ** 2).sum(axis=1) for c in centres], axis=1)


def nearest_distance(df: DataFrame, xs, centres) -> Column:
    """Squared distance to the closest centre."""
    c = np.asarray(centres, dtype=float)
    feats = resolve(df, xs, c.shape[1])
    if c.size <= MAX_LITERAL_TERMS:
        gaps = _distances(feats.columns(), c)
        return feats.guarded(gaps[0] if len(gaps) == 1 else F.least(*gaps))
    return batch_map(feats, lambda z, s: _nearest(z, s).min(axis=1), c, "double")


def assignment(df: DataFrame, xs, centres) -> Column:
    """Position of the closest centre; ties go to the lowest."""
    c = np.asarray(centres, dtype=float)
    feats = resolve(df, xs, c.shape[1])
    if feats.d != c.shape[1]:
        raise ValueError(f"{feats.d} features but centres of width {c.shape[1]}")
    if c.size <= MAX_LITERAL_TERMS:
        return feats.guarded(argmin(_distances(feats.columns(), c)))
    return batch_map(feats, lambda z, s: _nearest(z, s).argmin(axis=1).astype(np.int32), c, "int")


def _start_pass(rows: DataFrame, feats: Features, step: int, seed: int):
    """The row with the smallest -ln(u)/weight is a draw with probability
    proportional to its weight, the carried distance ``gap``; ``min_by`` finds it with a partial
    aggregation, so no row is sorted or shuffled."""
    key = -F.log(uniform("row_id", F.lit(step).cast("long"), seed=seed))
    if step:
        key = F.when(F.col("gap") > 0, key / F.col("gap")).otherwise(F.lit(float("inf")))
    pick = F.min_by(feats.array(), F.struct(key, F.col("row_id")))
    return rows.agg(pick.alias("pick"), F.count(F.lit(1)).alias("n"), bad_count(rows).alias("bad")).first()


def kmeans_init_pp(df: DataFrame, xs, k: int, id: str, seed: int = 0,
                   handle_invalid: str = "error") -> np.ndarray:
    """k-means++ start: the first centre uniform, each next one with
    probability proportional to the squared distance to the nearest chosen
    centre (the smallest id when every distance is 0).  ``id`` must be unique;
    the draw depends on it and the seed only, not on partitioning."""
    if k < 1:
        raise ValueError("k must be at least 1")
    feats = resolve(df, xs)
    wide = k * feats.d > MAX_LITERAL_TERMS
    rows, inner, _ = prepare(df, feats, keep={"row_id": id}, handle_invalid=handle_invalid, as_array=wide)
    with persisted(rows) as data:
        return _init_pp(data, inner, k, seed)


def _init_pp(data: DataFrame, feats: Features, k: int, seed: int) -> np.ndarray:
    """Every row keeps its distance to the nearest centre so far, so a round measures one new centre only."""
    centres, carried, copies = [], None, Rolling(data.sparkSession)
    rows = data
    try:
        for step in range(k):
            if step:
                new = nearest_distance(rows, feats, [centres[-1]])
                rows = rows.withColumn("gap", new if step == 1 else F.least("gap", new))
                rows = rows if step % ROUNDS_PER_COPY else copies.keep(rows)
                rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            got = _start_pass(rows, feats, step, seed)
            if carried is not None:
                carried.unpersist()
            carried = rows if step else None
            raise_on_bad(got["bad"], got["n"])
            if k > got["n"]:
                raise ValueError(f"{k} clusters from {got['n']} rows")
            centres.append(got["pick"])
    finally:
        if carried is not None:
            carried.unpersist()
        copies.close()
    return np.array(centres)


def _lloyd_kernel(cols, state):
    old, new = state
    z = cols["x"]
    near = _nearest(z, new).argmin(axis=1)
    k, d = new.shape
    sums = np.zeros((k, d + 1))
    np.add.at(sums[:, :d], near, z)
    sums[:, d] = np.bincount(near, minlength=k)
    moved = len(z) if old is None else (near != _nearest(z, old).argmin(axis=1)).sum()
    return np.concatenate([sums.ravel(), [float(moved)]])


def _lloyd_pass(data: DataFrame, feats: Features, old, new, wide: bool):
    """Sums and counts per cluster under ``new``, and how many rows changed
    cluster since ``old``; no assignment column is stored."""
    k, d = new.shape
    if wide:
        got = partition_sums(data, _lloyd_kernel, k * (d + 1) + 1, (old, new))
        table = got[:-1].reshape(k, d + 1)
        return table[:, :d], table[:, d], got[-1]
    x = feats.columns()
    near = argmin(_distances(x, new))
    moved = F.lit(1.0) if old is None else (near != argmin(_distances(x, old))).cast("double")
    tagged = data.select(*x, near.alias("cluster"), moved.alias("moved"))
    got = tagged.groupBy("cluster").agg(
        *[F.sum(c).alias(f"s{j}") for j, c in enumerate(x)],
        F.count(F.lit(1)).alias("n"), F.sum("moved").alias("moved")).collect()
    sums, counts, changed = np.zeros((k, d)), np.zeros(k), 0.0
    for r in got:
        sums[r["cluster"]] = [r[f"s{j}"] for j in range(d)]
        counts[r["cluster"]] = r["n"]
        changed += r["moved"]
    return sums, counts, changed


def kmeans_fit(df: DataFrame, xs, k: int = 3, max_iters: int = 100, init=None, id: str | None = None,
               seed: int = 0, handle_invalid: str = "error") -> KMeansModel:
    """Lloyd's algorithm.  Ties go to the lowest cluster, an empty cluster
    keeps its centre, and the fit stops when no row changes cluster.  Pass
    start centres as ``init``, or a unique ``id`` column for k-means++."""
    if init is None and id is None:
        raise ValueError("pass init centres, or id for a k-means++ start")
    feats = resolve(df, xs)
    if init is not None and np.asarray(init).shape != (k, feats.d):
        raise ValueError(f"init of shape {np.asarray(init).shape}, expected {(k, feats.d)}")
    wide = k * feats.d > MAX_LITERAL_TERMS
    keep = {} if id is None else {"row_id": id}
    rows, inner, _ = prepare(df, feats, keep=keep, handle_invalid=handle_invalid, as_array=wide)
    with persisted(rows) as data:
        if init is None:
            new = _init_pp(data, inner, k, seed)
        else:
            seen = data.agg(bad_count(data).alias("bad"), F.count(F.lit(1)).alias("n")).first()
            raise_on_bad(seen["bad"], seen["n"])
            if k > seen["n"]:
                raise ValueError(f"{k} clusters from {seen['n']} rows")
            new = np.array(init, dtype=float)
        points = data.select("x") if wide else data
        old, converged, done = None, False, 0
        for done in range(1, max_iters + 1):
            sums, counts, changed = _lloyd_pass(points, inner, old, new, wide)
            if not changed:
                converged, done = True, done - 1
                break
            filled = np.where(counts > 0, counts, 1.0)[:, None]
            old, new = new, np.where(counts[:, None] > 0, sums / filled, new)
    return KMeansModel(tuple(tuple(map(float, c)) for c in new), done, converged)


def kmeans_predict(df: DataFrame, model: KMeansModel, xs, output: str = "cluster") -> DataFrame:
    """Add the nearest centre's position; batch or streaming."""
    return df.withColumn(output, assignment(df, xs, model.centres))
