"""Small vector functions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from frameml.plans.features import balanced_sum


def soft_threshold(z: Column, gamma) -> Column:
    """Shrink towards zero by ``gamma``: sign(z) * max(|z| - gamma, 0)."""
    g = gamma if isinstance(gamma, Column) else F.lit(float(gamma))
    return F.signum(z) * F.greatest(F.abs(z) - g, F.lit(0.0))


def squared_distance(a: Sequence[Column] | Column, b) -> Column:
    """Squared Euclidean distance.  Lists of columns (or literals) stay in
    generated code; two array columns use higher-order functions."""
    if isinstance(a, Column):
        return total(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)))
    b = [v if isinstance(v, Column) else F.lit(float(v)) for v in b]
    if len(a) != len(b):
        raise ValueError(f"vectors of width {len(a)} and {len(b)}")
    gaps = [p - q for p, q in zip(a, b)]
    return balanced_sum([g * g for g in gaps])


def dot(a: Sequence[Column], weights: Sequence[float], bias: float = 0.0) -> Column:
    """Weighted sum of columns with literal weights."""
    if len(a) != len(weights):
        raise ValueError(f"{len(a)} features but {len(weights)} weights")
    total = balanced_sum([c * F.lit(float(w)) for c, w in zip(a, weights)])
    return total + F.lit(float(bias)) if bias else total


def bind(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once.  A lambda body is evaluated
    anew for every element, so anything it shares must be bound outside."""
    return F.transform(F.array(value), f)[0]


def total(arr: Column) -> Column:
    """Sum of an array."""
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def argmin(values: Sequence[Column]) -> Column:
    """Zero-based position of the smallest value; ties go to the lowest."""
    arr = F.array(*values)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def argmax(values) -> Column:
    """Zero-based position of the largest value; ties go to the lowest."""
    arr = values if isinstance(values, Column) else F.array(*values)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")
