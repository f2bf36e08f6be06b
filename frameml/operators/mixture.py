"""Gaussian mixtures by expectation-maximisation."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.functions.activations import softmax
from frameml.functions.vectors import argmax, dot
from frameml.operators.clustering import kmeans_fit
from frameml.operators.scoring import batch_map
from frameml.plans.features import Features, balanced_sum, prepare, resolve
from frameml.plans.moments import column_shift, packed_pairs, unpack
from frameml.plans.reduce import MAX_LITERAL_TERMS, partition_sums, persisted, sum_exprs

# Determinant floor, covariance ridge, k-means rounds of the start.
DET_FLOOR = 1e-9
COVARIANCE_RIDGE = 1e-5
START_ROUNDS = 10

# A component holding less total responsibility keeps its old parameters.
MIN_RESPONSIBILITY = 1e-12


@dataclass(frozen=True)
class MixtureModel:
    weights: tuple[float, ...]
    means: tuple[tuple[float, ...], ...]
    covariances: tuple[tuple[tuple[float, ...], ...], ...]
    kept: tuple[int, ...] = ()

    @property
    def k(self) -> int:
        return len(self.weights)

    def to_df(self, spark) -> DataFrame:
        rows = [(k, float(self.weights[k]), [float(v) for v in self.means[k]],
                 [[float(v) for v in r] for r in self.covariances[k]]) for k in range(self.k)]
        return spark.createDataFrame(rows, "k int, weight double, mean array<double>, cov array<array<double>>")

    @staticmethod
    def from_df(df: DataFrame) -> "MixtureModel":
        rows = df.orderBy("k").collect()
        return MixtureModel(tuple(r["weight"] for r in rows), tuple(tuple(r["mean"]) for r in rows),
                            tuple(tuple(tuple(c) for c in r["cov"]) for r in rows))


def _log_constants(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """Inverse and -(d ln 2 pi + ln det)/2, the determinant floored."""
    det = max(float(np.linalg.det(cov)), DET_FLOOR)
    try:
        inverse = np.linalg.inv(cov)
    except np.linalg.LinAlgError:
        raise ValueError("singular covariance") from None
    return inverse, -0.5 * (len(cov) * math.log(2 * math.pi) + math.log(det))


def _log_density(x: list[Column], mean, cov) -> Column:
    inverse, constant = _log_constants(np.asarray(cov, dtype=float))
    gap = [c - F.lit(float(m)) for c, m in zip(x, mean)]
    quad = [gap[a] * dot(gap, inverse[a]) for a in range(len(gap))]
    return F.lit(constant) - F.lit(0.5) * balanced_sum(quad)


def gaussian_pdf(df: DataFrame, xs, mean, cov) -> Column:
    """Density of each row; the determinant is floored at 1e-9."""
    feats = resolve(df, xs, len(mean))
    if len(mean) != feats.d or np.shape(cov) != (feats.d, feats.d):
        raise ValueError(f"{feats.d} features, mean of {len(mean)}, covariance {np.shape(cov)}")
    if feats.d ** 2 > MAX_LITERAL_TERMS:
        inverse, constant = _log_constants(np.asarray(cov, dtype=float))
        return batch_map(feats, _density_batch, (np.asarray(mean, dtype=float), inverse, constant), "double")
    return feats.guarded(F.exp(_log_density(feats.columns(), mean, cov)))


def _density_batch(z: np.ndarray, state) -> np.ndarray:
    mean, inverse, constant = state
    gap = z - mean
    return np.exp(constant - 0.5 * ((gap @ inverse) * gap).sum(axis=1))


def _terms(k: int, d: int) -> int:
    return k * (d * d + d)


def _log_joint(x: list[Column], model: MixtureModel) -> list[Column]:
    out = []
    for w, mean, cov in zip(model.weights, model.means, model.covariances):
        log_w = math.log(w) if w > 0 else -math.inf
        out.append(F.lit(log_w) + _log_density(x, mean, cov))
    return out


def _shares(z: np.ndarray, model: MixtureModel) -> tuple[np.ndarray, np.ndarray]:
    """Responsibilities and row log-likelihoods, in log space."""
    logs = np.empty((len(z), model.k))
    for k in range(model.k):
        inverse, constant = _log_constants(np.array(model.covariances[k]))
        gap = z - np.array(model.means[k])
        w = model.weights[k]
        logs[:, k] = constant - 0.5 * ((gap @ inverse) * gap).sum(axis=1) + (math.log(w) if w > 0 else -math.inf)
    top = logs.max(axis=1, keepdims=True)
    raised = np.exp(logs - top)
    total = raised.sum(axis=1, keepdims=True)
    return raised / total, (top + np.log(total)).ravel()


def _em_kernel(cols, state):
    model, shift = state
    z = cols["x"]
    share, ll = _shares(z, model)
    gap = z - shift
    up = np.triu_indices(z.shape[1])
    out = []
    for k in range(model.k):
        weighted = gap * share[:, k:k + 1]
        out += [[share[:, k].sum()], weighted.sum(axis=0), (weighted.T @ gap)[up]]
    return np.concatenate(out + [[ll.sum(), float(len(z))]])


def _em_exprs(data: DataFrame, feats: Features, model: MixtureModel, shift: np.ndarray) -> np.ndarray:
    x = feats.columns()
    logs = data.select(*x, *[lp.alias(f"l{k}") for k, lp in enumerate(_log_joint(x, model))])
    lk = [F.col(f"l{k}") for k in range(model.k)]
    top = lk[0] if model.k == 1 else F.greatest(*lk)
    topped = logs.withColumn("top", top)
    total = F.log(balanced_sum([F.exp(v - F.col("top")) for v in lk]))
    scored = topped.withColumn("ll", F.col("top") + total)
    shared = scored.select(*x, "ll", *[F.exp(v - F.col("ll")).alias(f"r{k}") for k, v in enumerate(lk)])
    gap = [c - F.lit(float(s)) for c, s in zip(x, shift)]
    exprs = []
    for k in range(model.k):
        r = F.col(f"r{k}")
        exprs += [r] + [r * g for g in gap] + [r * gap[a] * gap[b] for a, b in packed_pairs(len(gap))]
    return sum_exprs(shared, exprs + [F.col("ll"), F.lit(1.0)])


def _maximise(sums: np.ndarray, model: MixtureModel, shift: np.ndarray) -> MixtureModel:
    d = len(shift)
    size = 1 + d + d * (d + 1) // 2
    n = sums[-1]
    weights, means, covs, kept = [], [], [], []
    for k in range(model.k):
        part = sums[k * size:(k + 1) * size]
        nk = part[0]
        if nk < MIN_RESPONSIBILITY:
            kept.append(k)
            weights.append(model.weights[k])
            means.append(model.means[k])
            covs.append(model.covariances[k])
            continue
        mu = part[1:1 + d] / nk
        cov = unpack(part[1 + d:], d) / nk - np.outer(mu, mu) + COVARIANCE_RIDGE * np.eye(d)
        weights.append(float(nk / n))
        means.append(tuple(map(float, mu + shift)))
        covs.append(tuple(tuple(map(float, r)) for r in cov))
    return MixtureModel(tuple(weights), tuple(means), tuple(covs), tuple(kept))


def gmm_fit(df: DataFrame, xs, k: int = 3, max_iters: int = 100, init=None, id: str | None = None,
            seed: int = 0, handle_invalid: str = "error", history: list | None = None) -> MixtureModel:
    """Exactly ``max_iters`` rounds of EM from identity covariances and equal
    weights.  The means start at ``init`` or at ten rounds of k-means (needs a
    unique ``id``).  Each round is one aggregation; responsibilities are never
    stored.  Covariances get 1e-5 on the diagonal.  ``history`` collects the
    log-likelihood before each update."""
    feats = resolve(df, xs)
    d = feats.d
    shift = column_shift(df, feats, handle_invalid)
    if init is None:
        init = kmeans_fit(df, feats, k, START_ROUNDS, id=id, seed=seed, handle_invalid=handle_invalid).centres
    if np.shape(init) != (k, d):
        raise ValueError(f"init of shape {np.shape(init)}, expected {(k, d)}")
    eye = tuple(tuple(map(float, r)) for r in np.eye(d))
    model = MixtureModel((1.0 / k,) * k, tuple(tuple(map(float, c)) for c in init), (eye,) * k)
    wide = _terms(k, d) > MAX_LITERAL_TERMS // 2
    rows, inner, _ = prepare(df, feats, handle_invalid=handle_invalid, as_array=wide)
    size = k * (1 + d + d * (d + 1) // 2) + 2
    with persisted(rows.drop("bad")) as data:
        for _ in range(max_iters):
            if wide:
                sums = partition_sums(data, _em_kernel, size, (model, shift))
            else:
                sums = _em_exprs(data, inner, model, shift)
            if history is not None:
                history.append(float(sums[-2]))
            model = _maximise(sums, model, shift)
    return model


def mixture_shares(df: DataFrame, model: MixtureModel, xs) -> Column:
    """Array of component probabilities, normalised in log space."""
    feats = resolve(df, xs, len(model.means[0]))
    if feats.d != len(model.means[0]):
        raise ValueError(f"{feats.d} features but means of width {len(model.means[0])}")
    if _terms(model.k, feats.d) > MAX_LITERAL_TERMS // 2:
        return batch_map(feats, lambda z, s: _shares(z, s)[0], model)
    return feats.guarded(softmax(F.array(*_log_joint(feats.columns(), model))))


def gmm_predict_proba(df: DataFrame, model: MixtureModel, xs, output: str = "probability") -> DataFrame:
    return df.withColumn(output, mixture_shares(df, model, xs))


def gmm_predict(df: DataFrame, model: MixtureModel, xs, output: str = "component") -> DataFrame:
    """Add the most probable component; ties go to the lowest."""
    feats = resolve(df, xs, len(model.means[0]))
    if _terms(model.k, feats.d) > MAX_LITERAL_TERMS // 2:
        pick = batch_map(feats, lambda z, s: _shares(z, s)[0].argmax(axis=1).astype(np.int32), model, "int")
    else:
        pick = feats.guarded(argmax(_log_joint(feats.columns(), model)))
    return df.withColumn(output, pick)
