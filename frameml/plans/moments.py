"""Second moments of [1, x, y] in one pass over the rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameml.plans.features import bad_count, prepare, raise_on_bad, resolve
from frameml.plans.reduce import as_numpy, partition_sums

# Up to this width the sums are generated code; wider rows use NumPy Grams.
NARROW = 16

# Column of packed sums; user columns keep their names beside it.
SUMS = "__sums"


@dataclass(frozen=True)
class Moments:
    """Weighted sums about ``shift``: n rows, weight w, sx, gram, sy, xy, yy."""

    n: float
    w: float
    sx: np.ndarray
    gram: np.ndarray
    sy: float
    xy: np.ndarray
    yy: float
    shift: np.ndarray

    @property
    def d(self) -> int:
        return len(self.sx)

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.sx / self.w

    def covariance(self, ddof: int = 1) -> np.ndarray:
        centred = self.gram - np.outer(self.sx, self.sx) / self.w
        return centred / (self.w - ddof)

    def to_df(self, spark) -> DataFrame:
        """Cells (name, i, j, value) of every sum."""
        rows = [("n", 0, 0, float(self.n)), ("w", 0, 0, float(self.w)),
                ("sy", 0, 0, float(self.sy)), ("yy", 0, 0, float(self.yy))]
        rows += [("sx", j, 0, float(v)) for j, v in enumerate(self.sx)]
        rows += [("xy", j, 0, float(v)) for j, v in enumerate(self.xy)]
        rows += [("gram", i, j, float(self.gram[i, j])) for i in range(self.d) for j in range(i, self.d)]
        return spark.createDataFrame(rows, "name string, i int, j int, value double")


def packed_pairs(p: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(p) for b in range(a, p)]


def unpack(values, p: int) -> np.ndarray:
    """Packed upper triangle to a symmetric matrix."""
    z = np.zeros((p, p))
    up = np.triu_indices(p)
    z[up] = values
    return z + np.triu(z, 1).T


def _bad_rows(cols) -> float:
    """Rows marked by the projection and rows with a null or NaN element."""
    if "bad" not in cols:
        return 0.0
    return float((cols["bad"].astype(bool) | np.isnan(cols["x"]).any(axis=1)).sum())


def _gram_kernel(cols, state):
    shift, has_y, has_w = state
    x = cols["x"] - shift
    z = [np.ones((len(x), 1)), x]
    if has_y:
        z.append(cols["y"].reshape(-1, 1))
    z = np.hstack(z)
    wz = z * cols["weight"].reshape(-1, 1) if has_w else z
    up = np.triu_indices(z.shape[1])
    return np.concatenate([(wz.T @ z)[up], [float(len(x)), _bad_rows(cols)]])


def moments(df: DataFrame, xs, y=None, weight=None, shift=None, handle_invalid: str = "error",
            method: str = "auto") -> Moments:
    """Sums behind every linear model: one job, (d+2)^2/2 numbers collected."""
    labels = {}
    if y is not None:
        labels["y"] = y
    if weight is not None:
        labels["weight"] = weight
    feats = resolve(df, xs)
    d = feats.d
    wide = d > NARROW if method == "auto" else method == "wide"
    shift = np.zeros(d) if shift is None else np.asarray(shift, dtype=float)
    p = 1 + d + (y is not None)
    rows, inner, _ = prepare(df, feats, labels, handle_invalid=handle_invalid, as_array=wide, nan_later=True)
    if wide:
        got = partition_sums(_harmless(rows, d, labels), _gram_kernel, p * (p + 1) // 2 + 2,
                             (shift, y is not None, weight is not None))
        sums, n, bad = got[:-2], got[-2], got[-1]
    else:
        z = [F.lit(1.0)] + [c - F.lit(float(s)) if s else c for c, s in zip(inner.columns(), shift)]
        if y is not None:
            z.append(F.col("y"))
        w = [F.col("weight")] if weight is not None else []
        exprs = []
        for a, b in packed_pairs(p):
            term = z[b] if a == 0 else z[a] * z[b]
            exprs.append(F.sum(w[0] * term if w else term))
        row = rows.agg(*[e.alias(f"s{k}") for k, e in enumerate(exprs)],
                       F.count(F.lit(1)).alias("n"), bad_count(rows).alias("bad")).first()
        n, bad = row["n"], row["bad"]
        sums = [0.0 if v is None else v for v in row[:-2]]
    raise_on_bad(bad, n)
    z = unpack(np.asarray(sums, dtype=float), p)
    xi = slice(1, 1 + d)
    has_y = y is not None
    return Moments(float(n), float(z[0, 0]), z[0, xi], z[xi, xi],
                   float(z[0, -1]) if has_y else 0.0,
                   z[xi, -1] if has_y else np.zeros(d),
                   float(z[-1, -1]) if has_y else 0.0, shift)


def centred_moments(df: DataFrame, xs, handle_invalid: str = "error") -> Moments:
    """Moments about the means: a cheap first pass finds them, so the second
    one does not lose digits when a mean is large next to its spread."""
    feats = resolve(df, xs)
    return moments(df, feats, shift=column_shift(df, feats, handle_invalid), handle_invalid=handle_invalid)


def _mean_kernel(cols, _):
    return np.concatenate([cols["x"].sum(axis=0), [float(len(cols["x"])), _bad_rows(cols)]])


def column_shift(df: DataFrame, xs, handle_invalid: str = "error") -> np.ndarray:
    """Column means, used as a shift."""
    feats = resolve(df, xs)
    wide = feats.d > NARROW
    rows, inner, _ = prepare(df, feats, handle_invalid=handle_invalid, as_array=wide, nan_later=True)
    if wide:
        got = partition_sums(_harmless(rows, feats.d), _mean_kernel, feats.d + 2)
        raise_on_bad(got[-1], got[-2])
        return got[:-2] / got[-2]
    row = rows.agg(*[F.avg(c).alias(f"m{j}") for j, c in enumerate(inner.columns())],
                   F.count(F.lit(1)).alias("n"), bad_count(rows).alias("bad")).first()
    raise_on_bad(row["bad"], row["n"])
    return np.array(row[:feats.d], dtype=float)


def _harmless(rows: DataFrame, d: int, labels=()) -> DataFrame:
    """Nulls cannot enter NumPy arrays: rows marked bad get zeros.  They are
    counted and reported before any sum is used."""
    if "bad" not in rows.columns:
        return rows
    zeros = F.array_repeat(F.lit(0.0), d)
    cleared = {"x": F.when(F.col("bad"), zeros).otherwise(F.col("x"))}
    cleared |= {c: F.when(F.col("bad"), F.lit(0.0)).otherwise(F.col(c)) for c in labels}
    return rows.withColumns(cleared)


def grouped_moments(df: DataFrame, by, xs, y=None, shift=None,
                    handle_invalid: str = "error") -> tuple[DataFrame, int]:
    """One line per group: the ``by`` columns and ``SUMS``, the packed upper
    triangle of the sums of [1, x - shift, y].  Partial sums form before the
    shuffle, so a group holding a third of the rows costs one line per task."""
    by = [by] if isinstance(by, str) else list(by)
    feats = resolve(df, xs)
    wide = feats.d > NARROW
    labels = {"y": y} if y is not None else {}
    keys = {f"by{k}": c for k, c in enumerate(by)}
    rows, inner, _ = prepare(df, feats, labels, keep=keys, handle_invalid=handle_invalid, as_array=wide)
    back = [F.col(k).alias(c) for k, c in keys.items()]
    p = 1 + feats.d + (y is not None)
    if "bad" in rows.columns:
        message = F.lit("null or NaN feature or label; clean it or pass handle_invalid='skip'")
        one = F.when(F.col("bad"), F.raise_error(message).cast("double")).otherwise(F.lit(1.0))
    else:
        one = F.lit(1.0)
    shift = np.zeros(feats.d) if shift is None else np.asarray(shift, dtype=float)
    if wide:
        found = _grouped_wide(rows.withColumn("one", one).drop("bad"), list(keys), shift, y is not None)
        return found.select(*back, SUMS), p
    x = [c - F.lit(float(s)) if s else c for c, s in zip(inner.columns(), shift)]
    z = [one] + x + ([F.col("y")] if y is not None else [])
    sums = [F.sum(z[b] if a == 0 else z[a] * z[b]).alias(f"s{a}_{b}") for a, b in packed_pairs(p)]
    packed = rows.groupBy(*keys).agg(*sums)
    names = [f"s{a}_{b}" for a, b in packed_pairs(p)]
    return packed.select(*back, F.array(*names).alias(SUMS)), p


def _grouped_wide(rows: DataFrame, by: list[str], shift: np.ndarray, has_y: bool) -> DataFrame:
    """NumPy Grams per Arrow batch and group, added up by (group, slot); a
    group then gathers its fixed number of slots."""
    schema = T.StructType([*(rows.schema[c] for c in by), T.StructField("slot", T.IntegerType()),
                           T.StructField("part", T.DoubleType())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.select(by)
            codes = keys.to_pandas().groupby(by, dropna=False, sort=False).ngroup().to_numpy()
            z = [as_numpy(batch["one"]).reshape(-1, 1), as_numpy(batch["x"]) - shift]
            if has_y:
                z.append(as_numpy(batch["y"]).reshape(-1, 1))
            z = np.hstack(z)
            up = np.triu_indices(z.shape[1])
            order = np.argsort(codes, kind="stable")
            starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
            for at, end in zip(starts, [*starts[1:], len(order)]):
                mine = z[order[at:end]]
                packed = (mine.T @ mine)[up]
                same = keys.take(pa.array(np.full(len(packed), order[at])))
                yield pa.RecordBatch.from_arrays(
                    [*same.columns, pa.array(np.arange(len(packed)), pa.int32()), pa.array(packed)],
                    [*by, "slot", "part"])

    parts = rows.mapInArrow(run, schema)
    summed = parts.groupBy(*by, "slot").agg(F.sum("part").alias("part"))
    slots = F.sort_array(F.collect_list(F.struct("slot", "part")))
    return summed.groupBy(*by).agg(slots.alias("s")).select(*by, F.col("s.part").alias(SUMS))
