"""Gradient boosting for squared error."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameml.operators.trees import (MIN_VARIANCE_GAIN, NODE_SCHEMA, TreeModel, _Open, grow, label_stats, leaf_values,
                                     node_rows, training_table)
from frameml.plans.features import balanced_sum, resolve
from frameml.plans.lineage import Rolling
from frameml.plans.reduce import persisted
from frameml.plans.splits import NUMERIC, choose_bins, with_bins

# Trees whose CASE expressions may stand in one projection.
TREES_PER_PROJECTION = 20
# Trees between two writes of the running prediction.
TREES_PER_CHECKPOINT = 10


@dataclass(frozen=True)
class BoostingModel:
    base: float
    lr: float
    trees: tuple[TreeModel, ...]
    history: tuple[tuple[int, float], ...] = ()

    def to_df(self, spark) -> DataFrame:
        """Node rows of all trees with the ensemble's base and rate."""
        rows = [r for t, tree in enumerate(self.trees) for r in node_rows(tree, t)]
        nodes = spark.createDataFrame(rows, NODE_SCHEMA)
        return nodes.withColumns({"base": F.lit(self.base), "lr": F.lit(self.lr)})

    @staticmethod
    def from_df(df: DataFrame, d: int) -> "BoostingModel":
        rows = df.collect()
        trees = {}
        for r in rows:
            trees.setdefault(r["tree"], []).append(r)
        return BoostingModel(rows[0]["base"], rows[0]["lr"],
                             tuple(TreeModel.from_rows(trees[t], d) for t in sorted(trees)))

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame([(int(t), float(v)) for t, v in self.history], "tree int, mse double")


def gbt_fit(df: DataFrame, xs, y, n_estimators: int = 100, lr: float = 0.1, max_depth: int = 3,
            handle_invalid: str = "error") -> BoostingModel:
    """F0 = mean(y); each tree fits the residual y - F with
    min_samples_split 2, then F += lr * tree.  The training error is kept
    every tenth tree.

    Rows, bins and labels are prepared once.  The residual sums at a new root
    follow from the last tree's leaf sums, so a tree costs only its level
    searches.  The running residual is written to the shared checkpoint folder
    every ten trees; one copy is there at a time and none after the fit."""
    rows, feats = training_table(df, xs, y, handle_invalid)
    trees: list[TreeModel] = []
    history = []
    n, base = label_stats(rows)
    binning = choose_bins(rows, n, feats.d)
    start = with_bins(rows.select("x", (F.col("y") - F.lit(base)).alias("t")), binning)
    copies = Rolling(df.sparkSession)
    with persisted(start) as cached:
        data = cached
        total, square = data.agg(F.sum("t"), F.sum(F.col("t") * F.col("t"))).first()
        for t in range(n_estimators):
            root = _Open(0, n, np.array([total]), square)
            tree, leaves = grow(data, feats, root, NUMERIC, not binning.trivial, max_depth, 2,
                                leaf_value=lambda o: float(o.s[0] / o.n), stops=lambda o: o.n <= 1,
                                accepts=lambda gain: gain >= MIN_VARIANCE_GAIN)
            trees.append(tree)
            total = square = 0.0
            for o in leaves.values():
                step = lr * float(o.s[0] / o.n)
                total += float(o.s[0]) - step * o.n
                square += o.q - 2 * step * float(o.s[0]) + step * step * o.n
            if t % 10 == 0:
                history.append((t, square / n))
            data = data.withColumn("t", F.col("t") - F.lit(float(lr)) * leaf_values(data, tree, feats))
            if (t + 1) % TREES_PER_CHECKPOINT == 0 and t + 1 < n_estimators:
                data = copies.keep(data)
                cached.unpersist()
    copies.close()
    return BoostingModel(base, float(lr), tuple(trees), tuple(history))


def _trained_width(model: BoostingModel) -> int | None:
    return model.trees[0].d if model.trees else None


def gbt_column(df: DataFrame, model: BoostingModel, xs) -> Column:
    feats = resolve(df, xs, _trained_width(model))
    return feats.guarded(F.lit(model.base) + F.lit(model.lr) * balanced_sum([leaf_values(df, t, feats) for t in model.trees]))


def gbt_predict(df: DataFrame, model: BoostingModel, xs, output: str = "prediction") -> DataFrame:
    """Add base + lr * sum of trees, at most twenty trees per projection."""
    feats = resolve(df, xs, _trained_width(model))
    names = []
    out = df
    for at in range(0, len(model.trees), TREES_PER_PROJECTION):
        chunk = model.trees[at:at + TREES_PER_PROJECTION]
        name = f"__trees{at}"
        out = out.withColumn(name, feats.guarded(balanced_sum([leaf_values(out, t, feats) for t in chunk])))
        names.append(name)
    total = F.lit(model.base) + F.lit(model.lr) * balanced_sum([F.col(c) for c in names])
    return out.withColumn(output, total if names else feats.guarded(total)).drop(*names)
