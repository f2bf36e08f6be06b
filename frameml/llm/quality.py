"""Quality classifier: a sparse rule ensemble over text statistics.

A small forest of shallow trees is grown on labelled documents.  Every path
from a root to a node is a rule, a conjunction of bounds on statistics.  A
lasso logistic regression weighs the rules and the statistics themselves; what
keeps a weight is compiled into one Spark column expression, so scoring is a
projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from frameml.llm.hashing import PrefixHash, slices, string_buffers, words
from frameml.plans.lineage import cut_lineage
from frameml.sources.tables import read_table

STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "wide", "lines", "exclaimed",
              "marked_words", "bare_marks", "distinct", "top_share", "repeats", "pair_distinct", "ended")
# Bytes of text whose arrays a worker holds at a time, but for longer texts.
SLICE = 250_000
# Labelled rows that a fit reads at most, about.
MAX_TRAIN = 20_000
THRESHOLD = 0.3
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[at[1:]] - total[at[:-1]]).astype(float)


def statistics(column, hasher: PrefixHash) -> np.ndarray:
    """One row of STATISTICS for each text; all zero for an empty or null one."""
    data, offsets = string_buffers(column)
    out = np.zeros((len(offsets) - 1, len(STATISTICS)))
    for i, j in slices(offsets, SLICE):
        part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        size = np.maximum(np.diff(at), 1)
        hasher.load(part)
        start, end, text = words(part, at)
        word = hasher.ranges(start, end)
        first = np.searchsorted(text, np.arange(j - i + 1))
        count = np.diff(first)
        some = np.maximum(count, 1)
        marks = np.concatenate(([0], np.cumsum(_MARK[part], dtype=np.int64)))
        in_word = marks[end] - marks[start]
        last = _MARK[part[end - 1]] if len(end) else np.zeros(0, bool)
        same = np.zeros(len(word), bool)
        same[1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
        distinct, top, pairs = np.zeros(j - i), np.zeros(j - i), np.zeros(j - i)
        for r in np.flatnonzero(count):
            own = np.sort(word[first[r]:first[r + 1]])
            cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
            distinct[r], top[r] = len(cuts) - 1, np.diff(cuts).max()
            if count[r] > 1:
                two = word[first[r]:first[r + 1] - 1] * np.uint64(3) + word[first[r] + 1:first[r + 1]]
                pairs[r] = len(np.unique(two)) / (count[r] - 1)
        out[i:j] = np.stack([
            np.log1p(np.diff(at)), np.log1p(count), _sums(~np.isin(part, (9, 10, 13, 32)), at) / some,
            _sums(_UPPER[part], at) / size, _sums(_DIGIT[part], at) / size, _sums(_MARK[part], at) / size,
            _sums(part >= 128, at) / size, _sums(part == 10, at) / some, _sums(part == 33, at) / some,
            _sums(in_word >= 2, first) / some, _sums(in_word == end - start, first) / some,
            distinct / some, top / some, _sums(same, first) / some, pairs, _sums(last, first) / some], axis=1)
    return out


def _add_statistics(text: str, name: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = PrefixHash()
        for batch in batches:
            x = statistics(batch.column(text), hasher)
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]),
                                              pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return run


def with_statistics(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Add the array of statistics; the text column is read whole, other columns pass through."""


    schema = StructType([*df.schema.fields, StructField(name, ArrayType(DoubleType()))])
    return df.mapInArrow(_add_statistics(text_col, name), schema)


@dataclass(frozen=True)
class RuleModel:
    """Weights of rules, (bounds, weight) with bounds (statistic, low, high), and of statistics."""

    rules: tuple
    linear: tuple
    bias: float

    def score(self, stats: Column) -> Column:
        """The probability of label 1 as a column expression over the array of statistics."""
        z = F.lit(self.bias)
        for bounds, weight in self.rules:
            z = z + F.when(holds(bounds, stats), weight).otherwise(0.0)
        for k, (low, high, weight) in enumerate(self.linear):
            if weight:
                z = z + F.least(F.greatest(stats[k], F.lit(low)), F.lit(high)) * weight
        return 1 / (1 + F.exp(-z))


def holds(bounds: tuple, stats: Column) -> Column:
    """low < statistic <= high for every bound."""
    out = F.lit(True)
    for k, low, high in bounds:
        if low > -np.inf:
            out = out & (stats[k] > low)
        if high < np.inf:
            out = out & (stats[k] <= high)
    return out


def _paths(node, bounds: dict) -> Iterator[tuple]:
    """The conjunctions of a fitted tree's nodes below the root."""
    if bounds:
        yield tuple((k, *bounds[k]) for k in sorted(bounds))
    if node.subtreeDepth() > 0:
        split = node.split()
        k, t = split.featureIndex(), split.threshold()
        low, high = bounds.get(k, (-np.inf, np.inf))
        yield from _paths(node.leftChild(), {**bounds, k: (low, min(high, t))})
        yield from _paths(node.rightChild(), {**bounds, k: (max(low, t), high)})


def fit_rules(df: DataFrame, stats_col: str, label_col: str, trees: int = 12, depth: int = 3,
              penalty: float = 0.002, seed: int = 11) -> RuleModel:
    """Fit on rows with an array of statistics and a label 0 or 1.  With one label
    only, or no rows, the model is a constant (0.5 without rows)."""
    rows = cut_lineage(df.select(F.col(stats_col).alias("x"), F.col(label_col).cast("double").alias("y")))
    n, ones = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or ones in (0, n):
        share = 0.5 if not n else (ones + 1) / (n + 2)
        return RuleModel((), (), float(np.log(share / (1 - share))))
    data = rows.withColumn("v", array_to_vector("x"))
    forest = RandomForestClassifier(featuresCol="v", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed).fit(data)
    found = {path: None for tree in forest.trees for path in _paths(tree._java_obj.rootNode(), {})}
    rules = sorted(found)
    limits = rows.agg(*(F.percentile_approx(F.col("x")[k], [0.02, 0.98], 1000) for k in range(len(STATISTICS)))).first()
    wins = [F.least(F.greatest(F.col("x")[k], F.lit(lo)), F.lit(hi)) for k, (lo, hi) in enumerate(limits)]
    terms = F.array(*(holds(r, F.col("x")).cast("double") for r in rules), *wins)
    fit = LogisticRegression(featuresCol="z", labelCol="y", elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(
        rows.select("y", array_to_vector(terms).alias("z")))
    w = fit.coefficients.toArray().tolist()
    return RuleModel(tuple((r, w[i]) for i, r in enumerate(rules) if w[i]),
                     tuple((lo, hi, w[len(rules) + k]) for k, (lo, hi) in enumerate(limits)), float(fit.intercept))


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether a row belongs to the fold that nothing is learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> RuleModel:
    """Fit on the labelled documents outside the held-out fold.

    ``most`` bounds the labelled rows that are read; more are thinned by a hash
    of the id, so the sample is the same in every run.  Null labels, and labels
    other than 0 and 1, are left out.
    """
    usable = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), 5, 0))
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = usable.count()
    usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (1 << 20) * min(1.0, most / max(n, 1)))
    # The sample's size is bounded by ``most``, hence the broadcast.
    rows = docs.select(F.col("doc_id"), F.col("text")).join(F.broadcast(usable), "doc_id")
    return fit_rules(with_statistics(rows, "text", "x"), "x", "label")


def score_quality(docs: DataFrame, model: RuleModel, text_col: str = "text", score: str = "score") -> DataFrame:
    """Add the score of every row; a null or empty text is scored by all-zero statistics."""
    name = "statistics"
    while name in docs.columns:
        name += "_"
    return (with_statistics(docs, text_col, name).withColumn(score, model.score(F.col(name))).drop(name))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return (score_quality(docs, model)
            .select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                    F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")))


QUERIES = {"op3_quality": op3_quality}
SQL: dict[str, str] = {}
