"""Small dense solves, one per group of rows or one for the whole table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameml.functions.vectors import dot, total
from frameml.operators.regression import PIVOT_TOLERANCE, cholesky
from frameml.operators.scoring import affine
from frameml.plans.features import balanced_sum, resolve
from frameml.plans.lineage import cut_lineage, join_summary
from frameml.plans.moments import SUMS, centred_moments, column_shift, grouped_moments, packed_pairs
from frameml.plans.reduce import MAX_LITERAL_TERMS


def _unstack(packed: pd.Series, p: int) -> np.ndarray:
    """Stack of symmetric matrices from packed upper triangles."""
    flat = np.stack(packed.to_numpy())
    out = np.zeros((len(flat), p, p))
    for k, (a, b) in enumerate(packed_pairs(p)):
        out[:, a, b] = out[:, b, a] = flat[:, k]
    return out


def _covariances(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, means and sample covariances from stacked [1, x] sums."""
    n = z[:, 0, 0]
    mean = z[:, 0, 1:] / n[:, None]
    centred = z[:, 1:, 1:] - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return n, mean, centred / (n - 1)[:, None, None]


def generalized_variance(df: DataFrame, by, xs, handle_invalid: str = "error") -> DataFrame:
    """Determinant of each group's sample covariance: columns ``n`` and
    ``det`` (0 when singular, null for a group of one row)."""
    feats = resolve(df, xs)
    shift = column_shift(df, feats, handle_invalid)
    packed, p = grouped_moments(df, by, feats, shift=shift, handle_invalid=handle_invalid)

    @F.pandas_udf("n bigint, det double")
    def determinant(m: pd.Series) -> pd.DataFrame:
        n, _, cov = _covariances(_unstack(m, p))
        single = n < 2
        cov[single] = np.eye(cov.shape[1])
        return pd.DataFrame({"n": n.astype("int64"), "det": pd.Series(np.linalg.det(cov)).mask(single)})

    return packed.withColumn("__r", determinant(SUMS)).select(*_keys(by), "__r.n", "__r.det")


def linear_fit_by_group(df: DataFrame, by, xs, y, reg: float = 0.0, handle_invalid: str = "error") -> DataFrame:
    """Ridge or ordinary least squares per group: ``n``, ``theta`` (array) and
    ``status``, 'ok' or 'singular' (theta null)."""
    packed, p = grouped_moments(df, by, xs, y, handle_invalid=handle_invalid)
    d = p - 2

    @F.pandas_udf("n bigint, theta array<double>, status string")
    def solve(m: pd.Series) -> pd.DataFrame:
        z = _unstack(m, p)
        gram = z[:, 1:1 + d, 1:1 + d] + reg * np.eye(d)
        theta, status = [], []
        for a, b in zip(gram, z[:, 1:1 + d, -1]):
            try:
                low = cholesky(a)
                theta.append(np.linalg.solve(low.T, np.linalg.solve(low, b)))
                status.append("ok")
            except ValueError:
                theta.append(None)
                status.append("singular")
        return pd.DataFrame({"n": z[:, 0, 0].astype("int64"), "theta": theta, "status": status})

    return packed.withColumn("__r", solve(SUMS)).select(*_keys(by), "__r.n", "__r.theta", "__r.status")


def whiten(df: DataFrame, xs, output: str = "w", handle_invalid: str = "error") -> DataFrame:
    """Add ``w0..``: L^-1 (x - mean) with L the Cholesky factor of the sample
    covariance, so the outputs have identity covariance."""
    feats = resolve(df, xs)
    m = centred_moments(df, feats, handle_invalid)
    inverse = np.linalg.inv(cholesky(m.covariance()))
    centred = [c - F.lit(float(mu)) for c, mu in zip(feats.columns(), m.mean)]
    rows = df if handle_invalid == "error" else df.filter(feats.valid())
    if m.d ** 2 > MAX_LITERAL_TERMS:
        made = rows.withColumn("__w", affine(rows, feats, inverse.T, centre=m.mean))
        return made.withColumns({f"{output}{k}": F.col("__w")[k] for k in range(m.d)}).drop("__w")
    return rows.withColumns({f"{output}{k}": dot(centred[:k + 1], inverse[k, :k + 1]) for k in range(m.d)})


def mahalanobis(df: DataFrame, xs, by, output: str = "distance_sq", handle_invalid: str = "error") -> DataFrame:
    """Add (x - mean) S^-1 (x - mean)' with the mean and sample covariance of
    the row's own group; null where the group's covariance is singular."""
    feats = resolve(df, xs)
    shift = column_shift(df, feats, handle_invalid)
    packed, p = grouped_moments(df, by, feats, shift=shift, handle_invalid=handle_invalid)
    d = p - 1

    @F.pandas_udf("mu array<double>, inv array<double>")
    def invert(m: pd.Series) -> pd.DataFrame:
        _, mean, cov = _covariances(_unstack(m, p))
        inv = []
        for s in cov:
            sizes = np.linalg.svd(s, compute_uv=False) if np.all(np.isfinite(s)) else np.zeros(1)
            inv.append(np.linalg.inv(s).ravel() if sizes[-1] > PIVOT_TOLERANCE * max(sizes[0], 1e-300) else None)
        return pd.DataFrame({"mu": list(mean + shift), "inv": inv})

    keys = _keys(by)
    summary = cut_lineage(packed.withColumn("__r", invert(SUMS)).select(*keys, F.col("__r.mu").alias("__mu"), F.col("__r.inv").alias("__inv")))
    rows = df if handle_invalid == "error" else df.filter(feats.valid())
    gaps = [c - F.col("__mu")[j] for j, c in enumerate(feats.columns())]
    joined = join_summary(rows, summary, keys, "left")
    if d * d > MAX_LITERAL_TERMS:
        # One term per row of the inverse: the plan does not grow with d.
        gap, inv = F.col("__gap"), F.col("__inv")
        part = F.transform(gap, lambda g, a: g * total(F.zip_with(gap, F.slice(inv, a * d + 1, d), lambda h, v: h * v)))
        wide = joined.withColumn("__gap", F.zip_with(feats.array(), "__mu", lambda x, m: x - m))
        return wide.withColumn(output, total(part)).drop("__mu", "__inv", "__gap")
    terms = [gaps[a] * gaps[b] * F.col("__inv")[a * d + b] for a in range(d) for b in range(d)]
    return joined.withColumn(output, balanced_sum(terms)).drop("__mu", "__inv")


def _keys(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)
