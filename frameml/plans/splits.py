"""Exact best-split search over every observed threshold.

Impurity is the sum of the population variances of one or more target
columns: a single numeric target gives variance splits, 0/1 indicators of the
classes give Gini splits, since 1 - sum(p^2) = sum(p (1 - p)).

With sums (n, s) left of a threshold and (N, S) in the node,

    gain = (sum_t s_t^2 / n + (S_t - s_t)^2 / (N - n) - S_t^2 / N) / N.

The plan for large inputs has two steps.  First the rows are summed by (node,
feature, bin), which combines on the map side to a size set by the bins and
not by the rows.  That gives every gain at a bin's end and, because the gain
is convex in (n, s), a bound on any gain inside a bin: the largest value at
the corners of the region the bin's row count, target sum, minimum and
maximum allow.  Second, only rows of bins whose bound reaches the best gain so
far are summed by distinct value and searched.  Bins decide cost, never the
answer.

Indicators are one column per class.  With more classes than ``FEW_CLASSES`` the
Gini search works on lines (node, feature, value, class) instead, whose number and
width do not depend on how many classes there are.  All it needs of the classes at a
threshold are sum(l_c^2) and sum(T_c l_c), for left counts l_c and totals T_c.  A line
of m rows adds (l_c + m)^2 - l_c^2 to the first and T_c m to the second, so both
are running sums of running sums.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.plans.lineage import BROADCAST_BYTES, cut_lineage, is_small, join_summary
from frameml.plans.reduce import MAX_LITERAL_TERMS, as_numpy
from frameml.plans.running import running_sums

# Gains closer than this share of the parent impurity are ties.
TIE_DIGITS = 9
# Slack when bins are ruled out: wider than the tie rule.
BOUND_SLACK = 1e-8

# About one bin per this many rows, and at most MAX_BINS per feature.
ROWS_PER_BIN = 50_000
MAX_BINS = 4096
# Features with at most this many distinct values need no bins.
FEW_VALUES = 4096
# Gini searches of at most this many classes hold one column for each.
FEW_CLASSES = 32


@dataclass(frozen=True)
class Binning:
    """Upper edges per feature, ascending; bin b holds (edge[b-1], edge[b]]."""

    edges: tuple[np.ndarray, ...]

    @property
    def trivial(self) -> bool:
        return all(len(e) == 0 for e in self.edges)


def choose_bins(rows: DataFrame, n: float, d: int) -> Binning:
    """Quantile edges per feature from one sketch aggregation.  No bins are
    needed when every feature has few distinct values: summing by value is
    then as small as summing by bin."""
    none = Binning(tuple(np.empty(0) for _ in range(d)))
    bins = int(min(MAX_BINS, n // ROWS_PER_BIN))
    if bins < 2:
        return none
    probs = F.array(*[F.lit(b / bins) for b in range(1, bins)])
    long = rows.select(F.posexplode("x").alias("f", "v"))
    got = long.groupBy("f").agg(F.percentile_approx("v", probs, 10 * bins).alias("q"),
                                F.approx_count_distinct("v").alias("different")).collect()
    if max(r["different"] for r in got) <= FEW_VALUES:
        return none
    edges = {r["f"]: np.unique(np.array(r["q"], dtype=float)) for r in got}
    return Binning(tuple(edges[f] for f in range(d)))


def with_bins(rows: DataFrame, binning: Binning) -> DataFrame:
    """Add ``b``, the bin of every feature; nothing for a trivial binning."""
    if binning.trivial:
        return rows
    edges = binning.edges

    @F.arrow_udf("array<int>")
    def locate(x: pa.Array) -> pa.Array:
        z = as_numpy(x)
        out = np.empty(z.shape, dtype=np.int32)
        for f, e in enumerate(edges):
            out[:, f] = np.searchsorted(e, z[:, f], side="left")
        ends = pa.array(np.arange(0, out.size + 1, out.shape[1]), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    return rows.withColumn("b", locate("x"))


# Expressions below are SQL text: a level's plan is rebuilt for every tree
# level, and one parsed string is far cheaper than a chain of column calls.


def sql_sum(terms) -> str:
    return "(" + " + ".join(terms) + ")"


def _names(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{t}" for t in range(k)]


def _square_sum(terms) -> str:
    return sql_sum(f"{t} * {t}" for t in terms)


def _score(n: str, s: list[str], big_n: str, big_s: list[str]) -> str:
    """sum_t s^2/n + (S-s)^2/(N-n); a side without rows counts 0."""
    left = _square_sum(f"({t})" for t in s)
    right = _square_sum(f"({b} - ({t}))" for t, b in zip(s, big_s))
    m = f"({big_n} - ({n}))"
    return (f"(if({n} > 0, {left} / nullif({n}, 0D), 0D) + if({m} > 0, {right} / nullif({m}, 0D), 0D))")


def _impurity(k: int) -> str:
    return f"((all_q - {_square_sum(_names('all_s', k))} / all_n) / all_n)"


def _gain(k: int) -> str:
    """Gain from the left sums nl, sl0.. and the node's totals all_n, all_s0.. ."""
    totals = _names("all_s", k)
    return f"(({_score('nl', _names('sl', k), 'all_n', totals)} - {_square_sum(totals)} / all_n) / all_n)"


def _corner_bound(k: int) -> str:
    """Largest gain any threshold inside the bin can reach.

    Within the bin, m rows with target sum t go left.  Given the bin's count
    n, sum s and target range [lo, hi], (m, t) lies in a parallelogram with
    corners (0, 0), (n, s), the lowest targets first and the highest first.
    Each target is bounded on its own, which can only raise the bound.
    """
    parts = []
    for t in range(k):
        high = f"coalesce((s{t} - n * lo{t}) / nullif(hi{t} - lo{t}, 0D), 0D)"
        low = f"(n - {high})"
        corners = [("0D", "0D"), ("n", f"s{t}"), (high, f"{high} * hi{t}"), (low, f"{low} * lo{t}")]
        values = [_score(f"n_before + {m}", [f"s_before{t} + {v}"], "all_n", [f"all_s{t}"]) for m, v in corners]
        parts.append(f"greatest({', '.join(values)})")
    return f"(({sql_sum(parts)} - {_square_sum(_names('all_s', k))} / all_n) / all_n)"


@dataclass(frozen=True)
class Targets:
    """What to sum of the label column ``t``: SQL expressions, the sum of
    their squares, and their smallest and largest values when known."""

    exprs: tuple[str, ...]
    square: str
    bounds: tuple[float, float] | None = None

    @property
    def k(self) -> int:
        return len(self.exprs)

    def sums(self, prefix: str = "") -> list[Column]:
        return [F.expr("cast(count(1) as double)").alias(f"{prefix}n"),
                *[F.expr(f"sum({e})").alias(f"{prefix}s{i}") for i, e in enumerate(self.exprs)],
                F.expr(f"sum({self.square})").alias(f"{prefix}q")]

    def ranges(self) -> list[Column]:
        if self.bounds is not None:
            return []
        return [F.expr(f"{fn}({e})").alias(f"{name}{i}") for i, e in enumerate(self.exprs)
                for fn, name in (("min", "lo"), ("max", "hi"))]

    def known_ranges(self) -> list[str]:
        if self.bounds is None:
            return []
        return [f"{b!r}D as {name}{i}" for i in range(self.k) for b, name in zip(self.bounds, ("lo", "hi"))]


NUMERIC = Targets(("t",), "t * t")


def class_targets(classes) -> Targets:
    """One 0/1 indicator per class value; a row's squares add up to 1."""
    return Targets(tuple(f"if(t = {float(c)!r}D, 1D, 0D)" for c in classes), "1D", (0.0, 1.0))


def node_totals(rows: DataFrame, targets: Targets) -> DataFrame:
    """Per node: all_n, all_s0.., all_q (sum of squared targets)."""
    return rows.groupBy("node").agg(*targets.sums("all_"))


class KnownTotals:
    """Totals the caller holds: {node: (n, [s..], q)}.  A few nodes become CASE
    literals, more become a broadcast table of one line per node."""

    def __init__(self, by_node: dict, k: int):
        self.by_node, self.k = by_node, k
        self.names = ["all_n", *_names("all_s", k), "all_q"]

    def add(self, df: DataFrame) -> DataFrame:
        lines = [(node, float(n), *map(float, s), float(q)) for node, (n, s, q) in self.by_node.items()]
        if len(lines) * (self.k + 2) <= MAX_LITERAL_TERMS:
            cases = []
            for at, name in enumerate(self.names, start=1):
                whens = " ".join(f"when {line[0]} then {line[at]!r}D" for line in lines)
                cases.append(f"case node {whens} end as {name}")
            return df.selectExpr("*", *cases)
        schema = "node int, " + ", ".join(f"{n} double" for n in self.names)
        table = df.sparkSession.createDataFrame(lines, schema)
        small = 8 * len(lines) * (self.k + 3) <= BROADCAST_BYTES
        return df.join(F.broadcast(table) if small else table, "node")


class TableTotals:
    """Totals in a table of ``node_totals``; broadcast when it is known to be
    small."""

    def __init__(self, totals: DataFrame, small: bool):
        self.totals = F.broadcast(totals) if small else totals

    def add(self, df: DataFrame) -> DataFrame:
        return df.join(self.totals, "node")


def _long(rows: DataFrame, binned: bool) -> DataFrame:
    """One line per row and feature: node, t, f, v and, when binned, bin."""
    if not binned:
        return rows.selectExpr("node", "t", "posexplode(x) as (f, v)")
    pairs = rows.selectExpr("node", "t", "posexplode(arrays_zip(b, x)) as (f, e)")
    return pairs.selectExpr("node", "t", "f", "e.b as bin", "e.x as v")


def _best(k: int, *sources: DataFrame) -> DataFrame:
    """One split per node: largest gain, then feature, then smallest threshold.

    Each source is reduced on its own first: its rows arrive sorted by node
    from the window, so that reduction needs no sort and passes on one line
    per node and task."""
    share = f"if({_impurity(k)} > 0, gain / nullif({_impurity(k)}, 0D), 0D)"
    ranked = (f"struct(0D - round({share}, {TIE_DIGITS}) as rank, f, v, gain, nl, "
              f"array({', '.join(_names('sl', k))}) as sl, ql, all_n as n)")
    found = [c.groupBy("node").agg(F.expr(f"min({ranked})").alias("best")) for c in sources]
    if len(found) > 1:
        found = [functools.reduce(DataFrame.unionAll, found).groupBy("node").agg(F.expr("min(best)").alias("best"))]
    return found[0].selectExpr("node", "best.f as feature", "best.v as threshold", "best.gain as gain",
                               "cast(best.n as bigint) as n", "cast(best.nl as bigint) as n_left",
                               "best.sl as sum_left", "best.ql as square_left")


def class_totals(rows: DataFrame) -> DataFrame:
    """Rows of every (node, class): node, t, total."""
    return rows.groupBy("node", "t").agg(F.expr("cast(count(1) as double)").alias("total"))


def class_node_totals(classes: DataFrame) -> DataFrame:
    """Per node, from its class totals: rows, sum of squared class totals, largest class (the smallest on a tie)."""
    return classes.groupBy("node").agg(F.sum("total").alias("all_n"), F.sum(F.col("total") * F.col("total")).alias("all_tt"),
                                       F.min(F.struct((-F.col("total")).alias("n"), F.col("t"))).getField("t").alias("major"))


def best_splits_by_class(rows: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Best Gini split per node of ``rows`` (node, x, t), any number of classes: node, feature, threshold,
    gain, n, n_left.  ``classes`` and ``nodes`` are the totals above."""
    lines = _long(rows, False).groupBy("node", "f", "t", "v").agg(F.expr("cast(count(1) as double)").alias("m"))
    lines = join_summary(running_sums(lines, ["node", "f", "t"], ["v"], ["m"]), classes, ["node", "t"])
    grown = "sum(run_m * run_m - (run_m - m) * (run_m - m))"
    by_value = lines.groupBy("node", "f", "v").agg(F.sum("m").alias("n"), F.expr(grown).alias("ll"),
                                                   F.expr("sum(total * m)").alias("tl"))
    swept = join_summary(running_sums(by_value, ["node", "f"], ["v"], ["n", "ll", "tl"]), nodes, "node").filter("run_n < all_n")
    # Right counts are T_c - l_c, so their squares add up to tt - 2 tl + ll.
    right = "(all_tt - 2D * run_tl + run_ll)"
    gains = swept.selectExpr("node", "f", "v", "run_n as nl", "all_n", "1D - all_tt / (all_n * all_n) as impurity",
                             f"(run_ll / run_n + {right} / (all_n - run_n) - all_tt / all_n) / all_n as gain")
    share = "if(impurity > 0, gain / impurity, 0D)"
    ranked = f"struct(0D - round({share}, {TIE_DIGITS}) as rank, f, v, gain, nl, all_n as n)"
    best = gains.groupBy("node").agg(F.expr(f"min({ranked})").alias("best"))
    return best.selectExpr("node", "best.f as feature", "best.v as threshold", "best.gain as gain", "cast(best.n as bigint) as n",
                           "cast(best.nl as bigint) as n_left")


def _by_value(long: DataFrame, keys: list[str], targets: Targets) -> DataFrame:
    """Sums by (keys, v): heavy duplicate values collapse on the map side."""
    return long.groupBy(*keys, "v").agg(*targets.sums())


def _with_left(c: DataFrame, k: int, parts: list[str], order: str, offsets: bool) -> DataFrame:
    """Running sums nl, sl0.., ql within ``parts`` by ``order``."""
    over = f"over (partition by {', '.join(parts)} order by {order} rows unbounded preceding)"

    def left(name, before, out):
        shift = f" + {before}" if offsets else ""
        return f"sum({name}) {over}{shift} as {out}"

    return c.selectExpr("*", left("n", "n_before", "nl"),
                        *[left(f"s{i}", f"s_before{i}", f"sl{i}") for i in range(k)],
                        left("q", "q_before", "ql"))


def best_splits(rows: DataFrame, totals: KnownTotals | TableTotals, targets: Targets, binned: bool,
                few_nodes: bool = True) -> DataFrame:
    """Best split per node of ``rows`` (node, x, t and, when binned, b).
    ``few_nodes`` says the number of nodes is known to be small."""
    k = targets.k
    long = _long(rows, binned)
    if not binned:
        swept = totals.add(_with_left(_by_value(long, ["node", "f"], targets), k, ["node", "f"], "v", offsets=False))
        return _best(k, swept.filter("nl < all_n").selectExpr("*", f"{_gain(k)} as gain"))

    hist = long.groupBy("node", "f", "bin").agg(*targets.sums(), F.expr("min(v)").alias("v_min"),
                                                F.expr("max(v)").alias("v"), *targets.ranges())
    ends = totals.add(_with_left(hist, k, ["node", "f"], "bin", offsets=False))
    ends = ends.selectExpr("*", "nl - n as n_before", *[f"sl{i} - s{i} as s_before{i}" for i in range(k)],
                           "ql - q as q_before", *targets.known_ranges())
    ends = cut_lineage(ends.selectExpr("*", f"if(nl < all_n, {_gain(k)}, null) as gain",
                                       f"{_corner_bound(k)} as bound"))
    floors = ends.groupBy("node").agg(F.expr("max(gain)").alias("floor"))
    reach = f"coalesce(floor, double('-inf')) - {BOUND_SLACK!r}D * abs({_impurity(k)})"
    marked = ends.join(F.broadcast(floors) if few_nodes else floors, "node").selectExpr(
        "*", f"v_min < v and bound >= {reach} as open")
    at_ends = marked.filter("nl < all_n")
    keys = ["node", "f", "bin"]
    carried = ["n_before", *_names("s_before", k), "q_before", "all_n", *_names("all_s", k), "all_q"]
    open_bins = marked.filter("open").select(*keys, *carried)
    if is_small(open_bins):
        mask = F.broadcast(open_bins.select(*keys))
        counted = _by_value(long.join(mask, keys, "left_semi"), keys, targets).join(F.broadcast(open_bins), keys)
    else:
        counted = _by_value(long, keys, targets).join(open_bins, keys)
    inside = _with_left(counted, k, keys, "v", offsets=True).filter("nl < all_n")
    inside = inside.selectExpr("*", f"{_gain(k)} as gain")
    return _best(k, at_ends, inside)
