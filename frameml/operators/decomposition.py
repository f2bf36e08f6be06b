"""Singular values and principal components.

A tall table is reduced to the d x d Gram of its columns or to a triangle.  One of
fewer rows than columns is reduced to the n x n Gram of its rows, added up over
blocks of columns; the right vectors follow from it block by block.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameml.operators.scoring import affine
from frameml.plans.features import Features, bad_count, prepare, raise_on_bad, resolve
from frameml.plans.lineage import cut_lineage
from frameml.plans.moments import NARROW, centred_moments, moments
from frameml.plans.reduce import as_numpy

# Triangles meeting on the driver after the second QR round.
QR_FAN = 32
# Cells of one block of columns of a wide table, about, and rows whose Gram the driver takes apart.
BLOCK_CELLS, MAX_SIDE = 2_000_000, 20_000


@dataclass(frozen=True)
class SvdModel:
    """Singular values (descending) and right vectors, one row per component."""

    s: tuple[float, ...]
    v: tuple[tuple[float, ...], ...]

    def to_df(self, spark) -> DataFrame:
        rows = [(k, float(s), [float(x) for x in row]) for k, (s, row) in enumerate(zip(self.s, self.v))]
        return spark.createDataFrame(rows, "component int, s double, v array<double>")

    @staticmethod
    def from_df(df: DataFrame) -> "SvdModel":
        rows = df.orderBy("component").collect()
        return SvdModel(tuple(r["s"] for r in rows), tuple(tuple(r["v"]) for r in rows))


@dataclass(frozen=True)
class PcaModel:
    mean: tuple[float, ...]
    components: tuple[tuple[float, ...], ...]
    explained_variance: tuple[float, ...]

    def to_df(self, spark) -> DataFrame:
        rows = [(k, float(e), [float(x) for x in c], [float(x) for x in self.mean])
                for k, (e, c) in enumerate(zip(self.explained_variance, self.components))]
        return spark.createDataFrame(
            rows, "component int, explained_variance double, loading array<double>, mean array<double>")

    @staticmethod
    def from_df(df: DataFrame) -> "PcaModel":
        rows = df.orderBy("component").collect()
        return PcaModel(tuple(rows[0]["mean"]), tuple(tuple(r["loading"]) for r in rows),
                        tuple(r["explained_variance"] for r in rows))


def fix_signs(rows: np.ndarray) -> np.ndarray:
    """Make each vector's entry of largest magnitude positive."""
    at = np.argmax(np.abs(rows), axis=1)
    return rows * np.where(rows[np.arange(len(rows)), at] < 0, -1.0, 1.0)[:, None]


def _leading(sym: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(sym)
    order = np.argsort(values)[::-1][:k]
    return np.clip(values[order], 0.0, None), fix_signs(vectors[:, order].T)


def _check_rank(k: int, n: float, d: int) -> None:
    if not 1 <= k <= min(n, d):
        raise ValueError(f"asked for {k} components of a {int(n)} x {d} table")


def _triangle(batches: Iterable[pa.RecordBatch], d: int):
    """Fold any number of rows into one d x d triangle of the same Gram."""
    r = np.zeros((0, d))
    for batch in batches:
        if batch.num_rows:
            r = np.linalg.qr(np.vstack([r, as_numpy(batch.column(0))]), mode="r")
    if len(r):
        ends = pa.array(np.arange(0, r.size + 1, d), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(r.ravel()))], ["x"])


def _tsqr(df: DataFrame, feats: Features, handle_invalid: str) -> tuple[np.ndarray, int]:
    d = feats.d
    rows, _, _ = prepare(df, feats, handle_invalid=handle_invalid, as_array=True)
    seen = rows.agg(bad_count(rows).alias("bad"), F.count(F.lit(1)).alias("n")).first()
    raise_on_bad(seen["bad"], seen["n"])
    fold = lambda batches: _triangle(batches, d)
    first = rows.select("x").mapInArrow(fold, "x array<double>")
    second = first.repartition(QR_FAN).mapInArrow(fold, "x array<double>")
    stacked = as_numpy(second.toArrow()["x"])
    return np.linalg.qr(stacked, mode="r"), int(seen["n"])


def _complete(v: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Rows of ``v`` that are not found become unit vectors at right angles to the others."""
    at = 0
    for row in np.flatnonzero(~found):
        while True:
            unit = np.zeros(v.shape[1])
            unit[at] = 1.0
            at += 1
            for _ in range(2):
                unit -= v[found].T @ (v[found] @ unit)
            if np.linalg.norm(unit) > 1e-3 / np.sqrt(v.shape[1]):
                break
        v[row], found[row] = unit / np.linalg.norm(unit), True
    return v


def _dual_svd(df: DataFrame, feats: Features, k: int | None, handle_invalid: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and right vectors of a table of n < d rows from the eigenvectors of XX'."""
    rows, _, _ = prepare(df, feats, handle_invalid=handle_invalid, as_array=True)
    rows = cut_lineage(rows.withColumn("id", F.monotonically_increasing_id()))
    seen = rows.agg(bad_count(rows).alias("bad"), F.count(F.lit(1)).alias("n")).first()
    raise_on_bad(seen["bad"], seen["n"])
    n, d = int(seen["n"]), feats.d
    if n > MAX_SIDE:
        raise ValueError(f"{n} x {d}: the smaller side may have {MAX_SIDE} at most")
    k = min(n, d) if k is None else k
    _check_rank(k, n, d)
    width = max(1, BLOCK_CELLS // n)
    blocks = F.sequence(F.lit(0), F.lit((d - 1) // width))
    cut = F.transform(blocks, lambda b: F.struct(b.alias("block"), F.slice("x", b * width + 1, F.lit(width)).alias("x")))
    parts = rows.select("id", F.explode(cut).alias("c")).select("id", "c.block", "c.x")

    def part(table):
        return as_numpy(table["x"])[np.argsort(table["id"].to_numpy())]

    def gram(table):
        x = part(table)
        up = np.triu_indices(n)
        return pa.table({"at": pa.array(np.arange(len(up[0]))), "v": pa.array((x @ x.T)[up])})

    got = parts.groupBy("block").applyInArrow(gram, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    sym = np.zeros((n, n))
    up = np.triu_indices(n)
    at = got["at"].to_numpy()
    sym[up[0][at], up[1][at]] = got["v"].to_numpy()
    values, vectors = np.linalg.eigh(sym + np.triu(sym, 1).T)
    order = np.argsort(values)[::-1][:k]
    s, u = np.sqrt(np.clip(values[order], 0.0, None)), vectors[:, order]
    # Below this the squared value is rounding of the largest.
    found = s > s[0] * np.sqrt(n * np.finfo(float).eps)
    s = np.where(found, s, 0.0)
    scaled = u * np.divide(1.0, s, out=np.zeros_like(s), where=found)

    def right(key, table):
        v = part(table).T @ scaled
        ends = pa.array(np.arange(0, v.size + 1, k), pa.int32())
        first = key[0].as_py() * width
        return pa.table({"j": pa.array(np.arange(first, first + len(v))), "v": pa.ListArray.from_arrays(ends, pa.array(v.ravel()))})

    got = parts.groupBy("block").applyInArrow(right, "j long, v array<double>").toArrow()
    v = np.zeros((k, d))
    v[:, got["j"].to_numpy()] = as_numpy(got["v"]).T
    return s, fix_signs(_complete(v, found.copy()))


def svd(df: DataFrame, xs, k: int | None = None, method: str = "gram",
        handle_invalid: str = "error") -> SvdModel:
    """Top ``k`` (default: all min(n, d)) singular values and right vectors of the rows (uncentred).

    ``gram`` takes the eigenvectors of X'X from one pass.  That squares the
    condition number, so for singular values under 1e-6 of the largest use
    ``qr``: a QR per partition, folded in two rounds, then the SVD of R.  With
    fewer rows than columns ``gram`` takes the eigenvectors of XX' instead.
    """
    feats = resolve(df, xs)
    if method == "gram":
        # Wide Grams are worth a look at the number of rows first.
        m = None if feats.d > NARROW and df.limit(feats.d).count() < feats.d else moments(df, feats, handle_invalid=handle_invalid)
        if m is None or m.n < feats.d:
            s, v = _dual_svd(df, feats, k, handle_invalid)
        else:
            k = feats.d if k is None else k
            _check_rank(k, m.n, feats.d)
            values, v = _leading(m.gram, k)
            s = np.sqrt(values)
    elif method == "qr":
        r, n = _tsqr(df, feats, handle_invalid)
        k = min(n, feats.d) if k is None else k
        _check_rank(k, n, feats.d)
        _, s, vt = np.linalg.svd(r, full_matrices=False)
        s, v = s[:k], fix_signs(vt[:k])
    else:
        raise ValueError(f"unknown method {method!r}")
    return SvdModel(tuple(map(float, s)), tuple(tuple(map(float, row)) for row in v))


def svd_left(df: DataFrame, model: SvdModel, xs, output: str = "u") -> DataFrame:
    """Add the row of thin U = X V S^-1 (0 where a singular value is 0)."""
    s = np.array(model.s)
    scale = np.divide(1.0, s, out=np.zeros_like(s), where=s > 0)
    return df.withColumn(output, affine(df, xs, np.array(model.v).T * scale))


def pca_fit(df: DataFrame, xs, n: int = 2, handle_invalid: str = "error") -> PcaModel:
    """Leading ``n`` principal components; explained variance is s^2/(m-1)."""
    m = centred_moments(df, xs, handle_invalid)
    _check_rank(n, m.n, m.d)
    if m.n < 2:
        raise ValueError("principal components need two rows")
    values, components = _leading(m.covariance(), n)
    return PcaModel(tuple(map(float, m.mean)), tuple(tuple(map(float, c)) for c in components),
                    tuple(map(float, values)))


def pca_transform(df: DataFrame, model: PcaModel, xs, output: str = "z") -> DataFrame:
    """Add the scores (x - mean) C' as an array."""
    return df.withColumn(output, affine(df, xs, np.array(model.components).T, centre=model.mean))


def pca_inverse_transform(df: DataFrame, model: PcaModel, zs, output: str = "x_hat") -> DataFrame:
    """Add z C + mean as an array; ``zs`` are the score columns."""
    return df.withColumn(output, affine(df, (zs, len(model.components)) if isinstance(zs, str) else zs,
                                        np.array(model.components), np.array(model.mean)))
