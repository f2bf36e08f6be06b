"""Linear maps of feature rows: generated code for small weights, Arrow
batches with broadcast weights for large ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.functions.vectors import dot
from frameml.plans.features import Features, resolve
from frameml.plans.reduce import MAX_LITERAL_TERMS, as_numpy


EMPTY = {"array<double>": pa.list_(pa.float64()), "double": pa.float64(), "int": pa.int32()}


def batch_map(features: Features, fn, state, returns: str = "array<double>") -> Column:
    """``fn(X, state)`` on Arrow batches of the feature array.  Only that
    column crosses to Python, the other columns stay in the JVM.  A null array,
    one of another width and one with a null or NaN give null."""
    width = features.d

    @F.arrow_udf(returns)
    def apply(x: pa.Array) -> pa.Array:
        fits = pc.equal(pc.list_value_length(x), width).fill_null(False)
        seen = np.array(fits.to_numpy(zero_copy_only=False), dtype=bool)
        if seen.any():
            z = as_numpy(x.filter(fits))
            whole = ~np.isnan(z).any(axis=1)
            seen[seen] = whole
        if not seen.any():
            return pa.nulls(len(x), EMPTY[returns])
        out = fn(z[whole], state)
        if out.ndim == 1:
            made = pa.array(out)
        else:
            ends = pa.array(np.arange(0, out.size + 1, out.shape[1]), pa.int32())
            made = pa.ListArray.from_arrays(ends, pa.array(out.ravel()))
        if seen.all():
            return made
        return made.take(pa.array(np.cumsum(seen) - 1, mask=~seen))

    return apply(features.array())


def affine(df: DataFrame, xs, weights, bias=None, centre=None) -> Column:
    """Array column (x - centre) W + b for a (d, m) weight matrix."""
    w = np.asarray(weights, dtype=float)
    feats = resolve(df, xs, w.shape[0])
    if w.shape[0] != feats.d:
        raise ValueError(f"{feats.d} features but weights of shape {w.shape}")
    b = np.zeros(w.shape[1]) if bias is None else np.asarray(bias, dtype=float).ravel()
    if len(b) != w.shape[1]:
        raise ValueError(f"bias of width {len(b)} for {w.shape[1]} outputs")
    c = np.zeros(feats.d) if centre is None else np.asarray(centre, dtype=float)
    if w.size <= MAX_LITERAL_TERMS:
        cols = [x - F.lit(float(m)) if m else x for x, m in zip(feats.columns(), c)]
        return feats.guarded(F.array(*[dot(cols, w[:, k], b[k]) for k in range(w.shape[1])]))
    return batch_map(feats, lambda x, s: (x - s[2]) @ s[0] + s[1], (w, b, c))


def linear_score(df: DataFrame, xs, theta) -> Column:
    """Scalar column x . theta."""
    feats = resolve(df, xs, len(theta))
    if len(theta) != feats.d:
        raise ValueError(f"{feats.d} features but {len(theta)} weights")
    if len(theta) <= MAX_LITERAL_TERMS:
        return feats.guarded(dot(feats.columns(), theta))
    return batch_map(feats, lambda x, s: x @ s, np.asarray(theta, dtype=float), "double")


def dense_layer(df: DataFrame, xs, weights, bias, output: str = "out") -> DataFrame:
    """Add ``output`` = x W + b."""
    return df.withColumn(output, affine(df, xs, weights, bias))
