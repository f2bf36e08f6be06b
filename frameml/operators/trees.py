"""Exact regression and classification trees, grown level by level."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.operators.scoring import batch_map
from frameml.plans.features import Features, bad_count, prepare, raise_on_bad, resolve
from frameml.plans import splits
from frameml.plans.lineage import cut_lineage, is_small
from frameml.plans.reduce import persisted
from frameml.plans.splits import (NUMERIC, KnownTotals, TableTotals, Targets, best_splits, best_splits_by_class,
                                  choose_bins, class_node_totals, class_targets, class_totals, node_totals,
                                  with_bins)

# Smallest useful variance gain, impurity that counts as pure.
MIN_VARIANCE_GAIN = 1e-5
PURE_GINI = 1e-6

# More leaves than this make too much generated code; rows then walk the
# nodes in Arrow batches.
MAX_CASE_LEAVES = 255

NODE_SCHEMA = ("tree int, node int, is_leaf boolean, value double, feature int, threshold double, "
               "left int, right int")


@dataclass(frozen=True)
class Node:
    node: int
    value: float
    feature: int = -1
    threshold: float = 0.0
    left: int = -1
    right: int = -1

    @property
    def is_leaf(self) -> bool:
        return self.feature < 0


@dataclass(frozen=True)
class TreeModel:
    nodes: tuple[Node, ...]
    d: int

    def to_df(self, spark, tree: int = 0) -> DataFrame:
        return spark.createDataFrame(node_rows(self, tree), NODE_SCHEMA)

    @staticmethod
    def from_rows(rows, d: int) -> "TreeModel":
        nodes = [Node(r["node"], r["value"]) if r["is_leaf"] else
                 Node(r["node"], r["value"], r["feature"], r["threshold"], r["left"], r["right"])
                 for r in sorted(rows, key=lambda r: r["node"])]
        return TreeModel(tuple(nodes), d)

    @staticmethod
    def from_df(df: DataFrame, d: int, tree: int = 0) -> "TreeModel":
        return TreeModel.from_rows(df.filter(F.col("tree") == tree).collect(), d)


def node_rows(model: TreeModel, tree: int) -> list[tuple]:
    """Leaves carry null split columns."""
    return [(tree, n.node, n.is_leaf, float(n.value), *((None,) * 4 if n.is_leaf else
             (n.feature, float(n.threshold), n.left, n.right))) for n in model.nodes]


@dataclass
class _Open:
    """A node whose split is still to be searched: its sums."""

    node: int
    n: float
    s: np.ndarray
    q: float
    depth: int = 0


def leaf_expression(nodes, x: list[Column], pick) -> Column:
    """Nested CASE that sends a row to its leaf; ``pick(node)`` is the literal
    put there."""
    def walk(k: int) -> Column:
        node = nodes[k]
        if node.is_leaf:
            return pick(node)
        return F.when(x[node.feature] <= F.lit(float(node.threshold)), walk(node.left)).otherwise(walk(node.right))

    return walk(0)


def leaf_sql(nodes, array: str, values) -> str:
    """The same CASE as SQL text over an array<double> column."""
    def walk(k: int) -> str:
        node = nodes[k]
        if node.is_leaf:
            v = values[node.node]
            return "null" if v is None else f"{v!r}D" if isinstance(v, float) else str(v)
        return f"if({array}[{node.feature}] <= {float(node.threshold)!r}D, {walk(node.left)}, {walk(node.right)})"

    return walk(0)


def _walk_batch(x: np.ndarray, table) -> np.ndarray:
    """Vectorised descent: all rows step down one level at a time."""
    feature, threshold, left, right, out = table
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        f = feature[at]
        active = np.flatnonzero(f >= 0)
        if not len(active):
            return out[at]
        rows = at[active]
        goes_left = x[active, f[active]] <= threshold[rows]
        at[active] = np.where(goes_left, left[rows], right[rows])


def _leaf_column(df: DataFrame, nodes, feats: Features, values, returns: str) -> Column:
    """Value at each row's leaf, by generated code or by Arrow batches."""
    if sum(n.is_leaf for n in nodes) <= MAX_CASE_LEAVES:
        if feats.source is not None and df.schema[feats.source].dataType.simpleString() == "array<double>":
            return F.expr(f"cast({leaf_sql(nodes, feats.source, values)} as {returns})")
        return leaf_expression(nodes, feats.columns(), lambda n: F.lit(values[n.node]).cast(returns))
    table = (np.array([n.feature for n in nodes]), np.array([n.threshold for n in nodes]),
             np.array([n.left for n in nodes]), np.array([n.right for n in nodes]),
             np.array([-1 if v is None else v for v in values], dtype=float))
    return batch_map(feats, _walk_batch, table, "double").cast(returns)


def grow(data: DataFrame, feats: Features, root: _Open, targets: Targets, binned: bool, max_depth: int,
         min_samples_split: int, leaf_value, stops, accepts) -> tuple[TreeModel, dict[int, _Open]]:
    """Level-wise growth over ``data`` (x, t and, when binned, b).  One search per level
    covers all open nodes.  A child's sums follow from its parent's split, so
    no extra pass computes leaf values.  Returns the model and each leaf's
    sums."""
    nodes = [Node(0, leaf_value(root))]
    sums = {0: root}
    level = [root]
    while True:
        open_nodes = [o for o in level if o.depth < max_depth and o.n >= min_samples_split and not stops(o)]
        if not open_nodes:
            break
        tags = [None] * len(nodes)
        for o in open_nodes:
            tags[o.node] = o.node
        tagged = data.withColumn("node", _leaf_column(data, nodes, feats, tags, "int"))
        tagged = tagged.filter(F.col("node") >= 0)
        totals = KnownTotals({o.node: (o.n, o.s, o.q) for o in open_nodes}, targets.k)
        found = best_splits(tagged, totals, targets, binned).collect()
        level = []
        for r in sorted(found, key=lambda r: r["node"]):
            if not accepts(r["gain"]):
                continue
            parent = sums.pop(r["node"])
            left_id = len(nodes)
            left = _Open(left_id, float(r["n_left"]), np.array(r["sum_left"]), r["square_left"], parent.depth + 1)
            right = _Open(left_id + 1, parent.n - left.n, parent.s - left.s, parent.q - left.q, parent.depth + 1)
            nodes[parent.node] = replace(nodes[parent.node], feature=r["feature"], threshold=r["threshold"],
                                         left=left_id, right=left_id + 1)
            for child in (left, right):
                nodes.append(Node(child.node, leaf_value(child)))
                sums[child.node] = child
                level.append(child)
        if not level:
            break
    return TreeModel(tuple(nodes), feats.d), sums


def training_table(df: DataFrame, xs, y, handle_invalid: str) -> tuple[DataFrame, Features]:
    """Projection to (x, y, bad)."""
    rows, feats, _ = prepare(df, xs, {"y": y}, handle_invalid=handle_invalid, as_array=True)
    return rows, feats


def label_stats(rows: DataFrame) -> tuple[float, float]:
    """Row count and label mean; raises on invalid or empty input."""
    got = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), bad_count(rows).alias("bad")).first()
    raise_on_bad(got["bad"], got["n"])
    return float(got["n"]), float(got["mean"])


def tree_regressor_fit(df: DataFrame, xs, y, max_depth: int = 5, min_samples_split: int = 2,
                       handle_invalid: str = "error") -> TreeModel:
    """Variance splits; a leaf holds the mean.  A node is a leaf at
    ``max_depth``, under ``min_samples_split`` rows, with a single row, or when
    the best gain is below 1e-5."""
    rows, feats = training_table(df, xs, y, handle_invalid)
    n, mean = label_stats(rows)
    binning = choose_bins(rows, n, feats.d)
    data = with_bins(rows.select("x", (F.col("y") - F.lit(mean)).alias("t")), binning)
    with persisted(data) as ready:
        got = ready.agg(F.sum("t"), F.sum(F.col("t") * F.col("t"))).first()
        root = _Open(0, n, np.array([got[0]]), got[1])
        model, _ = grow(ready, feats, root, NUMERIC, not binning.trivial, max_depth, min_samples_split,
                        leaf_value=lambda o: mean + float(o.s[0] / o.n), stops=lambda o: o.n <= 1,
                        accepts=lambda gain: gain >= MIN_VARIANCE_GAIN)
    return model


def class_counts(rows: DataFrame) -> tuple[list[float], np.ndarray] | None:
    """Class values in ascending order and their row counts; None when there are
    more than the split search holds as columns."""
    got = rows.groupBy("y").count().limit(splits.FEW_CLASSES + 1).collect()
    if len(got) > splits.FEW_CLASSES:
        return None
    pairs = sorted((r["y"], r["count"]) for r in got)
    return [y for y, _ in pairs], np.array([n for _, n in pairs], dtype=float)


def tree_classifier_fit(df: DataFrame, xs, y, max_depth: int = 5, min_samples_split: int = 2,
                        handle_invalid: str = "error") -> TreeModel:
    """Gini splits; a leaf holds its majority class (the smallest on a tie).
    A node is a leaf at ``max_depth``, under ``min_samples_split`` rows or when
    its Gini impurity is below 1e-6; a split without any gain is accepted.  Any
    number of classes: few are counted in columns, many in lines of their own."""
    rows, feats = training_table(df, xs, y, handle_invalid)
    n, _ = label_stats(rows)
    few = class_counts(rows)
    if few is None:
        with persisted(rows.select("x", F.col("y").alias("t"))) as ready:
            return grow_by_class(ready, feats, max_depth, min_samples_split)
    classes, counts = few
    binning = choose_bins(rows, n, feats.d)
    data = with_bins(rows.select("x", F.col("y").alias("t")), binning)
    with persisted(data) as ready:
        root = _Open(0, n, counts, n)
        model, _ = grow(ready, feats, root, class_targets(classes), not binning.trivial, max_depth, min_samples_split,
                        leaf_value=lambda o: float(classes[int(np.argmax(np.round(o.s)))]),
                        stops=lambda o: 1.0 - float(np.sum((o.s / o.n) ** 2)) < PURE_GINI,
                        accepts=lambda gain: True)
    return model


def grow_by_class(data: DataFrame, feats: Features, max_depth: int, min_samples_split: int) -> TreeModel:
    """Level-wise growth over ``data`` (x, t) when a node's class counts are too many to hold here.

    The driver sees one line per open node: its rows, largest class and squared counts;
    the counts stay in a table that the search joins."""
    nodes, level, depth = [Node(0, 0.0)], [0], 0
    while level:
        tags = [None] * len(nodes)
        for node in level:
            tags[node] = node
        tagged = data.withColumn("node", _leaf_column(data, nodes, feats, tags, "int")).filter(F.col("node") >= 0)
        classes = cut_lineage(class_totals(tagged))
        totals = cut_lineage(class_node_totals(classes))
        open_nodes = []
        for r in totals.collect():
            nodes[r["node"]] = replace(nodes[r["node"]], value=float(r["major"]))
            gini = 1.0 - r["all_tt"] / r["all_n"] ** 2
            if depth < max_depth and r["all_n"] >= min_samples_split and gini >= PURE_GINI:
                open_nodes.append(r["node"])
        if not open_nodes:
            break
        found = best_splits_by_class(tagged.filter(F.col("node").isin(open_nodes)), classes, totals).collect()
        level, depth = [], depth + 1
        for r in sorted(found, key=lambda r: r["node"]):
            left = len(nodes)
            nodes[r["node"]] = replace(nodes[r["node"]], feature=r["feature"], threshold=r["threshold"], left=left, right=left + 1)
            nodes += [Node(left, 0.0), Node(left + 1, 0.0)]
            level += [left, left + 1]
    return TreeModel(tuple(nodes), feats.d)


def _split_table(df: DataFrame, xs, y, by, handle_invalid):
    keep = {} if by is None else {"node": by}
    rows, feats, _ = prepare(df, xs, {"y": y}, keep=keep, handle_invalid=handle_invalid, as_array=True)
    return (rows.withColumn("node", F.lit(0)) if by is None else rows), feats


def _one_level(rows: DataFrame, n: float, feats: Features, label: Column, targets: Targets) -> DataFrame:
    binning = choose_bins(rows, n, feats.d)
    data = with_bins(rows.select("node", "x", label.alias("t")), binning)
    totals = cut_lineage(node_totals(data, targets))
    few = is_small(totals)
    found = best_splits(data, TableTotals(totals, few), targets, not binning.trivial, few)
    return found.drop("sum_left", "square_left")


def best_split_variance(df: DataFrame, xs, y, by=None, handle_invalid: str = "error") -> DataFrame:
    """Best variance split per group: node, feature, threshold, gain, n, n_left.
    Groups without a valid split are absent."""
    rows, feats = _split_table(df, xs, y, by, handle_invalid)
    n, mean = label_stats(rows)
    return _one_level(rows, n, feats, F.col("y") - F.lit(mean), NUMERIC)


def best_split_gini(df: DataFrame, xs, y, by=None, handle_invalid: str = "error") -> DataFrame:
    """Best Gini split per group, gain 0 allowed, any number of classes."""
    rows, feats = _split_table(df, xs, y, by, handle_invalid)
    n, _ = label_stats(rows)
    few = class_counts(rows)
    if few is not None:
        return _one_level(rows, n, feats, F.col("y"), class_targets(few[0]))
    data = rows.select("node", "x", F.col("y").alias("t"))
    classes = cut_lineage(class_totals(data))
    return best_splits_by_class(data, classes, cut_lineage(class_node_totals(classes)))


def tree_column(df: DataFrame, model: TreeModel, xs) -> Column:
    feats = resolve(df, xs, model.d)
    if feats.d != model.d:
        raise ValueError(f"{feats.d} features for a tree grown on {model.d}")
    return feats.guarded(leaf_values(df, model, feats))


def leaf_values(df: DataFrame, model: TreeModel, feats: Features) -> Column:
    """Value at each row's leaf; the caller guards it against invalid rows."""
    return _leaf_column(df, model.nodes, feats, [float(n.value) for n in model.nodes], "double")


def tree_predict(df: DataFrame, model: TreeModel, xs, output: str = "prediction") -> DataFrame:
    """Add the value of each row's leaf (``<=`` goes left); batch or streaming."""
    return df.withColumn(output, tree_column(df, model, xs))
