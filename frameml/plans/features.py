"""Feature lists: either several numeric columns or one array column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def balanced_sum(terms: Sequence[Column]) -> Column:
    """Add many columns as a shallow tree; a left-deep chain of thousands of
    additions would overflow the analyzer's stack."""
    terms = list(terms)
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        paired = [a + b for a, b in zip(terms[::2], terms[1::2])]
        if len(terms) % 2:
            paired.append(terms[-1])
        terms = paired
    return terms[0]


def finite(col: Column) -> Column:
    """True for a usable number: not null and not NaN."""
    return col.isNotNull() & ~F.isnan(col)


@dataclass(frozen=True)
class Features:
    """A resolved feature list of width ``d``."""

    d: int
    source: str | None
    scalars: tuple[Column, ...]

    def columns(self) -> list[Column]:
        if self.source is not None:
            return [F.col(self.source)[j].cast("double") for j in range(self.d)]
        return [c.cast("double") for c in self.scalars]

    def guarded(self, value: Column) -> Column:
        """``value`` where the features are valid, else null."""
        return F.when(self.valid(), value)

    def array(self) -> Column:
        if self.source is not None:
            return F.col(self.source).cast("array<double>")
        return F.array(*self.columns())

    def valid(self) -> Column:
        if self.source is not None:
            arr = F.col(self.source).cast("array<double>")
            ok = (F.size(arr) == self.d) & F.forall(arr, finite)
            return F.coalesce(ok, F.lit(False))
        ok = F.lit(True)
        for c in self.columns():
            ok = ok & finite(c)
        return ok


def _width(df: DataFrame, name: str) -> int:
    """The one width of an array column, from all its rows; null arrays have none."""
    if df.isStreaming:
        raise ValueError(f"the width of {name!r} must be given on a stream")
    size = F.when(F.col(name).isNotNull(), F.size(name))
    low, high = df.agg(F.min(size), F.max(size)).first()
    if low is None:
        raise ValueError("empty input")
    if low != high:
        raise ValueError(f"arrays of {low} to {high} elements in {name!r}; give ({name!r}, width)")
    return int(low)


def resolve(df: DataFrame, xs, width: int | None = None) -> Features:
    """``xs`` is a list of names/Columns, the name of an array column, or
    ``(array column, width)``.  A model's ``width`` goes for an array column
    by name; without it all rows are looked at."""
    if isinstance(xs, Features):
        return xs
    if isinstance(xs, tuple) and len(xs) == 2 and isinstance(xs[0], str) and isinstance(xs[1], int):
        return Features(xs[1], xs[0], ())
    if isinstance(xs, str):
        if xs not in df.columns:
            raise ValueError(f"no column {xs!r}")
        if isinstance(df.schema[xs].dataType, T.ArrayType):
            return Features(_width(df, xs) if width is None else width, xs, ())
        xs = [xs]
    if not xs:
        raise ValueError("no feature columns")
    missing = [x for x in xs if isinstance(x, str) and x not in df.columns]
    if missing:
        raise ValueError(f"no columns {missing}")
    return Features(len(xs), None, tuple(F.col(x) if isinstance(x, str) else x for x in xs))


def check_policy(handle_invalid: str) -> None:
    if handle_invalid not in ("error", "skip"):
        raise ValueError("handle_invalid must be 'error' or 'skip'")


def prepare(df: DataFrame, xs, labels: dict[str, object] | None = None, keep: dict[str, str] | None = None,
            handle_invalid: str = "error", as_array: bool = False,
            nan_later: bool = False) -> tuple[DataFrame, Features, list[str]]:
    """Project to the columns a fit needs: features as ``x0..`` (or one array
    ``x``), labels under their given names, ``keep`` (new name: column), and ``bad`` when
    invalid rows must be reported.  With ``nan_later`` the caller looks for
    null and NaN elements of ``x`` itself (NumPy does it faster than a lambda
    per element).  Returns (frame, features, label names)."""
    check_policy(handle_invalid)
    feats = resolve(df, xs)
    cols = [F.col(source).alias(name) for name, source in (keep or {}).items()]
    if nan_later and as_array and handle_invalid == "error":
        ok = F.size(feats.array()).eqNullSafe(F.lit(feats.d))
    else:
        ok = feats.valid()
    names = []
    for name, source in (labels or {}).items():
        c = (F.col(source) if isinstance(source, str) else source).cast("double")
        ok = ok & finite(c)
        cols.append(c.alias(name))
        names.append(name)
    if as_array:
        cols.append(feats.array().alias("x"))
        out_feats = Features(feats.d, "x", ())
    else:
        xnames = [f"x{j}" for j in range(feats.d)]
        cols += [c.alias(n) for c, n in zip(feats.columns(), xnames)]
        out_feats = Features(feats.d, None, tuple(F.col(n) for n in xnames))
    if handle_invalid == "skip":
        return df.filter(ok).select(*cols), out_feats, names
    return df.select(*cols, (~ok).alias("bad")), out_feats, names


def bad_count(df: DataFrame) -> Column:
    """How many rows ``prepare`` marked as invalid (0 under ``skip``)."""
    if "bad" in df.columns:
        return F.sum(F.col("bad").cast("double"))
    return F.sum(F.lit(0.0))


def raise_on_bad(bad, n) -> None:
    if bad:
        raise ValueError(f"{int(bad)} rows hold a null or NaN feature or label; "
                         "clean them or pass handle_invalid='skip'")
    if not n:
        raise ValueError("empty input")
