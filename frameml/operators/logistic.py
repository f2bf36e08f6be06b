"""Logistic regression by damped Newton steps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.functions.activations import sigmoid
from frameml.functions.vectors import dot
from frameml.operators.regression import SingularMatrixError, solve_spd
from frameml.operators.scoring import linear_score
from frameml.plans.features import bad_count, prepare, raise_on_bad, resolve
from frameml.plans.moments import NARROW, packed_pairs, unpack
from frameml.plans.reduce import partition_sums, persisted, sum_exprs

# Fixed value: added to the Hessian diagonal before each solve.
HESSIAN_DAMPING = 1e-4


@dataclass(frozen=True)
class LogisticModel:
    theta: tuple[float, ...]
    history: tuple[tuple[int, float], ...] = ()

    def to_df(self, spark) -> DataFrame:
        return spark.createDataFrame([(j, float(t)) for j, t in enumerate(self.theta)], "j int, theta double")

    @staticmethod
    def from_df(df: DataFrame) -> "LogisticModel":
        return LogisticModel(tuple(r["theta"] for r in df.orderBy("j").collect()))

    def history_df(self, spark) -> DataFrame:
        """Squared gradient norm at the start of each step."""
        return spark.createDataFrame([(int(e), float(v)) for e, v in self.history], "step int, gradient_sq double")


def _newton_kernel(cols, theta):
    x, y = cols["x"], cols["y"]
    h = 1.0 / (1.0 + np.exp(-(x @ theta)))
    hessian = x.T @ (x * (h * (1.0 - h)).reshape(-1, 1))
    return np.concatenate([x.T @ (h - y), hessian[np.triu_indices(x.shape[1])]])


def logistic_fit(df: DataFrame, xs, y, max_iters: int = 10, theta0=None,
                 handle_invalid: str = "error") -> LogisticModel:
    """Newton: H = X' diag(h(1-h)) X + 1e-4 I, theta -= H^-1 X'(h - y), for
    exactly ``max_iters`` rounds; a failed solve keeps theta and stops.  Each
    round is one aggregation returning d + d(d+1)/2 sums."""
    feats = resolve(df, xs)
    d = feats.d
    theta = np.zeros(d) if theta0 is None else np.array(theta0, dtype=float)
    if len(theta) != d:
        raise ValueError(f"theta0 has {len(theta)} values for {d} features")
    wide = d > NARROW
    rows, inner, _ = prepare(df, feats, {"y": y}, handle_invalid=handle_invalid, as_array=wide)
    history = []
    with persisted(rows) as cached:
        row = cached.agg(bad_count(cached).alias("bad"), F.count(F.lit(1)).alias("n")).first()
        raise_on_bad(row["bad"], row["n"])
        data = cached.drop("bad")
        for step in range(max_iters):
            if wide:
                got = partition_sums(data, _newton_kernel, d + d * (d + 1) // 2, theta)
            else:
                got = _newton_sums(data, inner.columns(), theta)
            grad, hessian = got[:d], unpack(got[d:], d)
            history.append((step, float(grad @ grad)))
            try:
                theta = theta - solve_spd(hessian + HESSIAN_DAMPING * np.eye(d), grad, tolerance=0.0)
            except SingularMatrixError:
                break
    return LogisticModel(tuple(theta), tuple(history))


def _newton_sums(data: DataFrame, x: list[Column], theta) -> np.ndarray:
    scored = data.withColumn("h", sigmoid(dot(x, theta)))
    gap, weight = F.col("h") - F.col("y"), F.col("h") * (F.lit(1.0) - F.col("h"))
    exprs = [c * gap for c in x] + [weight * x[a] * x[b] for a, b in packed_pairs(len(x))]
    return sum_exprs(scored, exprs)


def logistic_predict_proba(df: DataFrame, model: LogisticModel, xs, output: str = "probability") -> DataFrame:
    """Add sigmoid(x . theta)."""
    return df.withColumn(output, sigmoid(linear_score(df, xs, model.theta)))


def logistic_predict(df: DataFrame, model: LogisticModel, xs, threshold: float = 0.5,
                     output: str = "prediction") -> DataFrame:
    """Add 1.0 where the probability reaches ``threshold``, else 0.0; null without a probability."""
    p = sigmoid(linear_score(df, xs, model.theta))
    return df.withColumn(output, F.when(p >= F.lit(float(threshold)), F.lit(1.0)).when(p.isNotNull(), F.lit(0.0)))
