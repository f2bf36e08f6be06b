"""One-pass statistics of columns and predictions.

Rows with a null or NaN value follow one rule, that of the fits: under
``handle_invalid='error'`` (default) the query fails when it runs, with the
number of such rows; ``'skip'`` leaves them out.  A null group key is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.plans.features import check_policy, finite, resolve

# Fixed value: offset inside the cross-entropy logarithm.
CE_EPS = 1e-7

# Mark of rows that the default policy refuses; user columns keep their names beside it.
BAD = "__bad"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keys(by) -> list[str]:
    return [] if by is None else [by] if isinstance(by, str) else list(by)


def _policy(df: DataFrame, ok: Column, handle_invalid: str) -> DataFrame:
    """Rows with ``ok``; the others are left out or, under 'error', marked for ``_or_fail``."""
    check_policy(handle_invalid)
    if handle_invalid == "skip":
        return df.filter(ok)
    return df.withColumn(BAD, ~ok)


def _or_fail(df: DataFrame, value: Column) -> Column:
    """``value``, or a failure when a marked row was seen."""
    if BAD not in df.columns:
        return value
    bad = F.count_if(F.col(BAD))
    message = F.concat(bad.cast("string"), F.lit(" rows hold a null or NaN value; clean them or pass handle_invalid='skip'"))
    return F.when(bad > 0, F.raise_error(message)).otherwise(value)


def column_means(df: DataFrame, xs, handle_invalid: str = "error") -> DataFrame:
    """One row ``mean_0..`` of feature means."""
    feats = resolve(df, xs)
    rows = _policy(df, feats.valid(), handle_invalid)
    return rows.agg(*[_or_fail(rows, F.avg(c)).alias(f"mean_{j}") for j, c in enumerate(feats.columns())])


def variance_impurity(df: DataFrame, y, by=None, handle_invalid: str = "error") -> DataFrame:
    """Population variance of ``y`` per group, 0 for an empty input."""
    c = _col(y).cast("double")
    rows = _policy(df, finite(c), handle_invalid)
    value = F.coalesce(F.var_pop(c), F.lit(0.0))
    return rows.groupBy(*_keys(by)).agg(_or_fail(rows, value).alias("impurity"))


def _class_counts(df: DataFrame, y, by, handle_invalid: str) -> DataFrame:
    """Rows of every (group, class); the marks of invalid rows count per class."""
    check_policy(handle_invalid)
    c = _col(y)
    counts = df.groupBy(*_keys(by), c.alias("y")).agg(F.count(F.lit(1)).alias("n"))
    number = counts.schema["y"].dataType.simpleString() in ("double", "float")
    ok = F.col("y").isNotNull() & (~F.isnan("y") if number else F.lit(True))
    return counts.filter(ok) if handle_invalid == "skip" else counts.withColumn(BAD, F.when(~ok, F.col("n")))


def _or_fail_counts(counts: DataFrame, value: Column) -> Column:
    if BAD not in counts.columns:
        return value
    bad = F.coalesce(F.sum(BAD), F.lit(0))
    message = F.concat(bad.cast("string"), F.lit(" rows hold a null or NaN label; clean them or pass handle_invalid='skip'"))
    return F.when(bad > 0, F.raise_error(message)).otherwise(value)


def gini(df: DataFrame, y, by=None, handle_invalid: str = "error") -> DataFrame:
    """Gini impurity 1 - sum(p^2) per group, 0 for an empty input.  Counting
    by (group, class) first keeps a hot group to one line per class."""
    n = F.col("n").cast("double")
    total = F.sum(n)
    value = F.coalesce(F.lit(1.0) - F.sum(n * n) / (total * total), F.lit(0.0))
    counts = _class_counts(df, y, by, handle_invalid)
    return counts.groupBy(*_keys(by)).agg(_or_fail_counts(counts, value).alias("impurity"))


def majority_class(df: DataFrame, y, by=None, handle_invalid: str = "error") -> DataFrame:
    """Most frequent class per group; the smallest class wins a tie."""
    best = F.min_by(F.col("y"), F.struct(-F.col("n"), F.col("y")))
    counts = _class_counts(df, y, by, handle_invalid)
    return counts.groupBy(*_keys(by)).agg(_or_fail_counts(counts, best).alias("majority"), F.max("n").alias("votes"))


def _gap(df: DataFrame, prediction, label, handle_invalid: str) -> tuple[DataFrame, Column]:
    p, y = _col(prediction).cast("double"), _col(label).cast("double")
    return _policy(df, finite(p) & finite(y), handle_invalid), p - y


def mse(df: DataFrame, prediction, label, by=None, handle_invalid: str = "error") -> DataFrame:
    """Mean squared error."""
    rows, gap = _gap(df, prediction, label, handle_invalid)
    return rows.groupBy(*_keys(by)).agg(_or_fail(rows, F.avg(gap * gap)).alias("mse"))


def half_mse(df: DataFrame, prediction, label, by=None, handle_invalid: str = "error") -> DataFrame:
    """The 1/(2m) form of the squared error."""
    rows, gap = _gap(df, prediction, label, handle_invalid)
    return rows.groupBy(*_keys(by)).agg(_or_fail(rows, F.avg(gap * gap) / 2).alias("half_mse"))


def cross_entropy(df: DataFrame, probs, label, by=None, handle_invalid: str = "error") -> DataFrame:
    """Sum over rows of -ln(p + 1e-7), p the probability of the true class
    (``label`` is a zero-based position in the ``probs`` array; one outside it makes the row invalid)."""
    at, size = _col(label).cast("int"), F.size(_col(probs))
    p = F.when(at.between(0, size - 1), F.get(_col(probs), at)).cast("double")
    rows = _policy(df, finite(p), handle_invalid)
    return rows.groupBy(*_keys(by)).agg(_or_fail(rows, F.sum(-F.log(p + F.lit(CE_EPS)))).alias("cross_entropy"))
