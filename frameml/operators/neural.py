"""Small neural networks trained data-parallel.

One optimiser step is one pass over the batch's rows: every Arrow batch runs
forward and backward in NumPy with broadcast weights, partial gradient sums
are added up by a Spark aggregation, and the driver updates the weights.
Updates are therefore per batch of rows, not per row: the gradient is the
batch mean, clipped per component after averaging.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.functions.activations import activation, softmax
from frameml.functions.vectors import dot
from frameml.operators.scoring import batch_map
from frameml.plans.features import bad_count, prepare, raise_on_bad, resolve
from frameml.plans.reduce import MAX_LITERAL_TERMS, partition_sums, persisted

# Offset in the cross-entropy logarithm, Adam constants, default rates.
CE_EPS = 1e-7
ADAM_BETAS = (0.9, 0.999)
ADAM_EPS = 1e-8
DEFAULT_LR = {"sgd": 0.01, "adam": 0.001}

ACTIVATIONS = ("relu", "tanh", "sigmoid")


@dataclass(frozen=True)
class Layer:
    """``linear`` with weights w (n_in x n_out) and bias b, an activation, or
    ``dropout`` with rate p."""

    kind: str
    w: np.ndarray | None = None
    b: np.ndarray | None = None
    p: float = 0.0


@dataclass(frozen=True)
class Network:
    layers: tuple[Layer, ...]
    history: tuple[tuple[int, float], ...] = ()

    @property
    def linear(self) -> list[Layer]:
        return [l for l in self.layers if l.kind == "linear"]

    def to_df(self, spark) -> DataFrame:
        rows = [(k, l.kind, None if l.w is None else [[float(v) for v in r] for r in l.w],
                 None if l.b is None else [float(v) for v in l.b], float(l.p)) for k, l in enumerate(self.layers)]
        return spark.createDataFrame(rows, "layer int, kind string, w array<array<double>>, b array<double>, p double")

    @staticmethod
    def from_df(df: DataFrame) -> "Network":
        return Network(tuple(Layer(r["kind"], None if r["w"] is None else np.array(r["w"]),
                                   None if r["b"] is None else np.array(r["b"]), r["p"])
                             for r in df.orderBy("layer").collect()))

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame([(int(e), float(v)) for e, v in self.history], "step int, loss double")


def linear_layer(n_in: int, n_out: int, rng: np.random.Generator) -> Layer:
    """Kaiming start: N(0, 1) * sqrt(2 / n_in), bias 0."""
    return Layer("linear", rng.standard_normal((n_in, n_out)) * np.sqrt(2.0 / n_in), np.zeros(n_out))


def mlp(n_in: int, widths: Sequence[int], seed: int = 0, hidden: str = "relu", dropout: float = 0.0) -> Network:
    """Linear layers with ``hidden`` activations (and dropout) between them
    and nothing after the last."""
    if hidden not in ACTIVATIONS:
        raise ValueError(f"unknown activation {hidden!r}; choose from {ACTIVATIONS}")
    if not 0.0 <= dropout < 1.0:
        raise ValueError("dropout needs 0 <= p < 1")
    rng = np.random.default_rng(seed)
    layers = []
    for k, width in enumerate(widths):
        layers.append(linear_layer(n_in, width, rng))
        if k < len(widths) - 1:
            layers.append(Layer(hidden))
            if dropout:
                layers.append(Layer("dropout", p=dropout))
        n_in = width
    return Network(tuple(layers))


def _mask(ids: np.ndarray, width: int, p: float, key) -> np.ndarray:
    """Dropout mask from a hash of (row id, unit, step): the same on a retry."""
    grid = ids.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(width, dtype=np.uint64)
    h = grid ^ np.uint64(key)
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mult)
    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53
    return (u < 1.0 - p) / (1.0 - p)


def _forward(z: np.ndarray, layers, ids=None, step: int = 0, seed: int = 0):
    """Output and what the backward pass needs from each layer."""
    saved = []
    for k, layer in enumerate(layers):
        if layer.kind == "linear":
            saved.append(z)
            z = z @ layer.w + layer.b
        elif layer.kind == "dropout":
            if ids is None:
                saved.append(None)
                continue
            key = np.random.SeedSequence([seed, step, k]).generate_state(1, np.uint64)[0]
            mask = _mask(ids, z.shape[1], layer.p, key)
            saved.append(mask)
            z = z * mask
        else:
            z = {"relu": lambda v: np.maximum(v, 0.0), "tanh": np.tanh,
                 "sigmoid": lambda v: 1.0 / (1.0 + np.exp(-v))}[layer.kind](z)
            saved.append(z)
    return z, saved


def _backward(grad: np.ndarray, layers, saved) -> list[np.ndarray]:
    """Gradients of all linear parameters, flattened in layer order."""
    out = []
    for layer, kept in zip(reversed(layers), reversed(saved)):
        if layer.kind == "linear":
            out += [grad.sum(axis=0), (kept.T @ grad).ravel()]
            grad = grad @ layer.w.T
        elif layer.kind == "dropout":
            grad = grad if kept is None else grad * kept
        elif layer.kind == "relu":
            grad = grad * (kept > 0)
        elif layer.kind == "tanh":
            grad = grad * (1.0 - kept * kept)
        else:
            grad = grad * kept * (1.0 - kept)
    return out[::-1]


def _softmax_rows(z: np.ndarray) -> np.ndarray:
    raised = np.exp(z - z.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _loss_and_grad(out: np.ndarray, y: np.ndarray, loss: str) -> tuple[float, np.ndarray]:
    if loss == "mse":
        gap = out - y.reshape(len(out), -1)
        return float((gap * gap).sum()), 2.0 * gap
    p = _softmax_rows(out)
    at = (np.arange(len(p)), y.astype(int))
    value = float(-np.log(p[at] + CE_EPS).sum())
    p[at] -= 1.0
    return value, p


def _step_kernel(cols, state):
    layers, loss, step, seed = state
    ids = cols.get("row_id")
    out, saved = _forward(cols["x"], layers, ids, step, seed)
    value, grad = _loss_and_grad(out, cols["y"], loss)
    return np.concatenate(_backward(grad, layers, saved) + [[value, float(len(out))]])


class _Sgd:
    """v = momentum * v - lr * g; p += v."""

    def __init__(self, lr: float, momentum: float):
        self.lr, self.momentum, self.v = lr, momentum, 0.0

    def delta(self, g: np.ndarray) -> np.ndarray:
        self.v = self.momentum * self.v - self.lr * g
        return self.v


class _Adam:
    """First and second moment averages with bias correction."""

    def __init__(self, lr: float, betas: tuple[float, float] = ADAM_BETAS):
        self.lr, self.betas, self.m, self.v, self.t = lr, betas, 0.0, 0.0, 0

    def delta(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        first, second = self.betas
        self.m = first * self.m + (1.0 - first) * g
        self.v = second * self.v + (1.0 - second) * g * g
        m_hat = self.m / (1.0 - first**self.t)
        v_hat = self.v / (1.0 - second**self.t)
        return -self.lr * m_hat / (np.sqrt(v_hat) + ADAM_EPS)


def _moved(layers, delta: np.ndarray) -> tuple[Layer, ...]:
    out, at = [], 0
    for layer in layers:
        if layer.kind == "linear":
            w = layer.w + delta[at:at + layer.w.size].reshape(layer.w.shape)
            at += layer.w.size
            b = layer.b + delta[at:at + layer.b.size]
            at += layer.b.size
            layer = Layer("linear", w, b)
        out.append(layer)
    return tuple(out)


def mlp_fit(df: DataFrame, xs, y, network: Network | None = None, hidden: Sequence[int] = (8,),
            outputs: int = 1, loss: str = "mse", optimizer: str = "sgd", lr: float | None = None,
            momentum: float = 0.0, betas: tuple[float, float] = ADAM_BETAS, epochs: int = 1, batches: int = 1, id: str | None = None,
            clip: float | None = None, seed: int = 0, handle_invalid: str = "error") -> Network:
    """Train ``network`` (or a new one with ``hidden`` layers and ``outputs``).

    ``loss``: 'mse' (2(p - y) at the output) or 'ce' (softmax minus one-hot at
    the logits, y a class number).  ``optimizer``: 'sgd' (``momentum``, rate 0.01
    unless given) or 'adam' (``betas``, 0.001).  With
    ``batches`` > 1 the rows fall into hash buckets of the unique ``id`` and
    every epoch steps through them; one full batch is the default.  ``clip``
    bounds each component of the mean gradient.  Dropout layers need ``id``.
    The history holds the mean loss before each step.
    """
    if loss not in ("mse", "ce"):
        raise ValueError(f"unknown loss {loss!r}")
    if optimizer not in ("sgd", "adam"):
        raise ValueError(f"unknown optimizer {optimizer!r}")
    if not all(0.0 <= b < 1.0 for b in betas):
        raise ValueError("betas need 0 <= beta < 1")
    feats = resolve(df, xs)
    network = network or mlp(feats.d, [*hidden, outputs], seed)
    layers = network.layers
    if network.linear[0].w.shape[0] != feats.d:
        raise ValueError(f"{feats.d} features for a network of {network.linear[0].w.shape[0]} inputs")
    drops = any(l.kind == "dropout" for l in layers)
    if id is None and (drops or batches > 1):
        raise ValueError("dropout and batches need a unique id column")
    rows, _, _ = prepare(df, feats, {"y": y}, keep={} if id is None else {"key": id},
                         handle_invalid=handle_invalid, as_array=True)
    if id is not None:
        rows = rows.withColumns({"bucket": F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(batches)).cast("int"),
                                 "row_id": F.xxhash64("key")})
    if batches > 1:
        # Cached blocks then hold few buckets each, and a step skips the
        # others by their min/max statistics.  No shuffle is needed for it.
        rows = rows.sortWithinPartitions("bucket")
    size = sum(l.w.size + l.b.size for l in network.linear) + 2
    rate = DEFAULT_LR[optimizer] if lr is None else lr
    rule = _Adam(rate, betas) if optimizer == "adam" else _Sgd(rate, momentum)
    history = []
    with persisted(rows) as cached:
        seen = cached.agg(bad_count(cached).alias("bad"), F.count(F.lit(1)).alias("n"),
                          F.min("y").alias("lo"), F.max("y").alias("hi")).first()
        raise_on_bad(seen["bad"], seen["n"])
        width = network.linear[-1].w.shape[1]
        if loss == "ce" and not (seen["lo"] >= 0 and seen["hi"] < width):
            raise ValueError(f"class numbers must lie in 0..{width - 1}")
        needed = ["x", "y"] + (["row_id"] if drops else [])
        step = 0
        for _ in range(epochs):
            for part in range(batches):
                data = cached if batches == 1 else cached.filter(F.col("bucket") == part)
                got = partition_sums(data.select(*needed), _step_kernel, size, (layers, loss, step, seed))
                n = got[-1]
                if not n:
                    continue
                history.append((step, got[-2] / n))
                grad = got[:-2] / n
                if clip is not None:
                    grad = np.clip(grad, -clip, clip)
                layers = _moved(layers, rule.delta(grad))
                step += 1
    return Network(tuple(layers), tuple(history))


def _forward_columns(x: list[Column], network: Network) -> list[Column]:
    for layer in network.layers:
        if layer.kind == "linear":
            x = [dot(x, layer.w[:, k], float(layer.b[k])) for k in range(layer.w.shape[1])]
        elif layer.kind in ACTIVATIONS:
            x = [activation(c, layer.kind) for c in x]
    return x


def network_output(df: DataFrame, network: Network, xs) -> Column:
    """Forward pass as an array column; dropout is off.  One linear layer with
    few weights stays in generated code (a second one would repeat the first
    layer's expressions per output), anything else goes through Arrow."""
    linear = network.linear
    feats = resolve(df, xs, linear[0].w.shape[0])
    if linear[0].w.shape[0] != feats.d:
        raise ValueError(f"{feats.d} features for a network of {linear[0].w.shape[0]} inputs")
    terms = 1
    for layer in linear:
        terms *= layer.w.size
    if terms <= MAX_LITERAL_TERMS:
        return feats.guarded(F.array(*_forward_columns(feats.columns(), network)))
    return batch_map(feats, lambda z, layers: _forward(z, layers)[0], network.layers)


def mlp_predict(df: DataFrame, network: Network, xs, output: str = "out", probabilities: bool = False) -> DataFrame:
    """Add the outputs as an array (softmax probabilities on request)."""
    out = df.withColumn(output, network_output(df, network, xs))
    return out.withColumn(output, softmax(F.col(output))) if probabilities else out
