"""Linear regression: closed form, gradient descent, lasso.

All three read the rows once.  What they need from the data is the moments
X'X, X'y, y'y; every later step works on those d x d numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameml.operators.scoring import linear_score
from frameml.plans.features import prepare, resolve
from frameml.plans.moments import Moments, moments
from frameml.plans.reduce import partition_sums, persisted

# Fixed values of the lasso sweep: smallest step applied, stopping step.
LASSO_MIN_STEP = 1e-5
LASSO_STOP = 1e-4

# A squared Cholesky pivot below d * this * (largest diagonal) means singular.
PIVOT_TOLERANCE = 1e-12

# Beyond this width one gradient pass per epoch beats forming X'X.
GRAM_WIDTH = 2000


class SingularMatrixError(ValueError):
    """The matrix is not positive definite."""


@dataclass(frozen=True)
class LinearModel:
    theta: tuple[float, ...]
    history: tuple[tuple[int, float], ...] = field(default=())

    def to_df(self, spark) -> DataFrame:
        return spark.createDataFrame([(j, float(t)) for j, t in enumerate(self.theta)], "j int, theta double")

    @staticmethod
    def from_df(df: DataFrame) -> "LinearModel":
        return LinearModel(tuple(r["theta"] for r in df.orderBy("j").collect()))

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame([(int(e), float(v)) for e, v in self.history], "epoch int, loss double")


def cholesky(a: np.ndarray, tolerance: float = PIVOT_TOLERANCE) -> np.ndarray:
    """Lower factor, refusing numerically singular input that plain double
    precision would let through."""
    a = np.asarray(a, dtype=float)
    try:
        low = np.linalg.cholesky(a)
    except np.linalg.LinAlgError:
        raise SingularMatrixError("matrix is not positive definite") from None
    floor = len(a) * tolerance * np.max(np.diag(a))
    if np.min(np.diag(low)) ** 2 <= floor:
        raise SingularMatrixError("matrix is singular to working precision")
    return low


def solve_spd(a: np.ndarray, b: np.ndarray, tolerance: float = PIVOT_TOLERANCE) -> np.ndarray:
    low = cholesky(a, tolerance)
    return np.linalg.solve(low.T, np.linalg.solve(low, b))


def _start(theta0, d: int) -> np.ndarray:
    theta = np.zeros(d) if theta0 is None else np.array(theta0, dtype=float)
    if len(theta) != d:
        raise ValueError(f"theta0 has {len(theta)} values for {d} features")
    return theta


def linear_fit(df: DataFrame, xs, y, reg: float = 0.0, handle_invalid: str = "error") -> LinearModel:
    """Solve (X'X + reg I) theta = X'y.  ``reg`` is not scaled by the row
    count, and a bias column is penalised like any other."""
    m = moments(df, xs, y, handle_invalid=handle_invalid)
    return LinearModel(tuple(solve_spd(m.gram + reg * np.eye(m.d), m.xy)))


def linear_fit_gd(df: DataFrame, xs, y, epochs: int, lr: float, reg: float = 0.0, theta0=None,
                  handle_invalid: str = "error") -> LinearModel:
    """Full-batch gradient descent on the half mean squared error; the
    gradient adds ``reg * theta``.  The history holds the loss before the
    update, every max(1, epochs // 10) epochs."""
    feats = resolve(df, xs)
    theta = _start(theta0, feats.d)
    every = max(1, epochs // 10)
    if feats.d > GRAM_WIDTH:
        return _gd_passes(df, feats, y, epochs, lr, reg, theta, every, handle_invalid)
    m = moments(df, feats, y, handle_invalid=handle_invalid)
    history = []
    for epoch in range(epochs):
        g_theta = m.gram @ theta
        if epoch % every == 0:
            history.append((epoch, float(theta @ g_theta - 2 * theta @ m.xy + m.yy) / (2 * m.n)))
        theta = theta - lr * ((g_theta - m.xy) / m.n + reg * theta)
    return LinearModel(tuple(theta), tuple(history))


def _gradient_kernel(cols, theta):
    gap = cols["x"] @ theta - cols["y"]
    return np.concatenate([cols["x"].T @ gap, [gap @ gap, float(len(gap))]])


def _gd_passes(df, feats, y, epochs, lr, reg, theta, every, handle_invalid):
    rows, _, _ = prepare(df, feats, {"y": y}, handle_invalid=handle_invalid, as_array=True)
    if "bad" in rows.columns:
        message = F.lit("null or NaN feature or label")
        rows = rows.withColumn("y", F.when(F.col("bad"), F.raise_error(message).cast("double"))
                               .otherwise(F.col("y"))).drop("bad")
    history = []
    with persisted(rows) as data:
        for epoch in range(epochs):
            got = partition_sums(data, _gradient_kernel, feats.d + 2, theta)
            grad, loss, n = got[:-2], got[-2], got[-1]
            if not n:
                raise ValueError("empty input")
            if epoch % every == 0:
                history.append((epoch, loss / (2 * n)))
            theta = theta - lr * (grad / n + reg * theta)
    return LinearModel(tuple(theta), tuple(history))


def lasso_from_moments(m: Moments, reg: float, epochs: int, theta: np.ndarray) -> np.ndarray:
    """Coordinate sweeps on the Gram matrix, threshold reg * n."""
    gamma = reg * m.n
    for _ in range(epochs):
        largest = 0.0
        for j in range(m.d):
            z = m.gram[j, j]
            if z <= 0.0:
                continue
            rho = m.xy[j] - m.gram[j] @ theta + z * theta[j]
            step = np.sign(rho) * max(abs(rho) - gamma, 0.0) / z - theta[j]
            if abs(step) > LASSO_MIN_STEP:
                theta[j] += step
                largest = max(largest, abs(step))
        if largest < LASSO_STOP:
            break
    return theta


def lasso_fit(df: DataFrame, xs, y, reg: float, epochs: int = 100, theta0=None,
              handle_invalid: str = "error") -> LinearModel:
    """L1-penalised least squares by coordinate descent.  Steps up to 1e-5
    are not applied, a sweep whose largest step is under 1e-4 is the last,
    and an all-zero column keeps its start weight."""
    m = moments(df, xs, y, handle_invalid=handle_invalid)
    return LinearModel(tuple(lasso_from_moments(m, reg, epochs, _start(theta0, m.d))))


def linear_predict(df: DataFrame, model: LinearModel, xs, output: str = "prediction") -> DataFrame:
    """Add ``output`` = x . theta; batch or streaming."""
    return df.withColumn(output, linear_score(df, xs, model.theta))
