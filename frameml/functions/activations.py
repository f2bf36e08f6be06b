"""Activations, their gradients, softmax and dropout as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from frameml.functions.vectors import bind, total
from frameml.plans.randomness import uniform

# Fixed value: offset inside ln(x + eps) and its derivative.
LOG_EPS = 1e-8

KINDS = ("relu", "tanh", "sigmoid", "exp", "log", "pow", "neg")


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def activation(x: Column, kind: str, exponent: float = 2.0) -> Column:
    """relu, tanh, sigmoid, exp, log (of x + 1e-8), pow (x ** exponent), neg.
    A null gives null and NaN stays NaN."""
    if kind == "relu":
        return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))
    if kind == "tanh":
        return F.tanh(x)
    if kind == "sigmoid":
        return sigmoid(x)
    if kind == "exp":
        return F.exp(x)
    if kind == "log":
        return F.log(x + F.lit(LOG_EPS))
    if kind == "pow":
        return F.pow(x, F.lit(float(exponent)))
    if kind == "neg":
        return -x
    raise ValueError(f"unknown activation {kind!r}; choose from {KINDS}")


def activation_grad(x: Column, kind: str, upstream: Column | float = 1.0, exponent: float = 2.0) -> Column:
    """Derivative of ``activation`` at the input ``x``, times ``upstream``."""
    up = upstream if isinstance(upstream, Column) else F.lit(float(upstream))
    if kind == "relu":
        return F.when(x > 0, up).when(x.isNotNull(), F.lit(0.0))
    if kind == "tanh":
        t = F.tanh(x)
        return (F.lit(1.0) - t * t) * up
    if kind == "sigmoid":
        s = sigmoid(x)
        return s * (F.lit(1.0) - s) * up
    if kind == "exp":
        return F.exp(x) * up
    if kind == "log":
        return F.pow(x + F.lit(LOG_EPS), F.lit(-1.0)) * up
    if kind == "pow":
        return F.lit(float(exponent)) * F.pow(x, F.lit(float(exponent) - 1.0)) * up
    if kind == "neg":
        return -up
    raise ValueError(f"unknown activation {kind!r}; choose from {KINDS}")


def softmax(arr: Column) -> Column:
    """Softmax of every row's array, shifted by its maximum."""
    def raised(s):
        return F.transform(s["x"], lambda v: F.exp(v - s["top"]))

    def shares(e):
        return bind(F.struct(e.alias("e"), total(e).alias("sum")),
                    lambda t: F.transform(t["e"], lambda v: v / t["sum"]))

    shifted = bind(F.struct(arr.alias("x"), F.array_max(arr).alias("top")), raised)
    return bind(shifted, shares)


def softmax_grad(s: Column, g: Column) -> Column:
    """Gradient through a softmax output ``s``: s * (g - sum(s * g))."""
    inner = total(F.zip_with(s, g, lambda a, b: a * b))
    return bind(F.struct(s.alias("s"), g.alias("g"), inner.alias("inner")),
                lambda t: F.zip_with(t["s"], t["g"], lambda a, b: a * (b - t["inner"])))


def keep_mask(p: float, *keys, seed: int = 0) -> Column:
    """1/(1-p) for kept units and 0 for dropped ones, from a hash of ``keys``
    (row id, unit, step): the backward pass sees the same mask."""
    if not 0.0 <= p < 1.0:
        raise ValueError("dropout needs 0 <= p < 1")
    scale = F.lit(1.0 / (1.0 - p))
    return F.when(uniform(*keys, seed=seed) < F.lit(1.0 - p), scale).otherwise(F.lit(0.0))


def dropout(x: Column, p: float, *keys, seed: int = 0, training: bool = True) -> Column:
    """Inverted dropout of one value; the identity when not training."""
    if not training:
        if not 0.0 <= p < 1.0:
            raise ValueError("dropout needs 0 <= p < 1")
        return x
    return x * keep_mask(p, *keys, seed=seed)


def dropout_array(arr: Column, p: float, *keys, seed: int = 0, training: bool = True) -> Column:
    """Inverted dropout of each unit of an array column."""
    if not training:
        return dropout(arr, p, training=False)
    return F.transform(arr, lambda v, unit: v * keep_mask(p, *keys, unit.cast("long"), seed=seed))
