"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary n-gram classifier
(the log-odds of hashed byte 2- and 3-grams between the languages with that bit
and those without) predicts it with a margin; decoding takes the codeword of
the smallest logistic loss over all bits, each weighted by how well its
classifier separates the languages.  A small gap to the next codeword marks the
answer as ambiguous.  Counting runs in Spark over all labelled texts; the model
is one table of gram buckets by bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from frameml.llm.hashing import mix, slices, string_buffers
from frameml.llm.quality import held_out
from frameml.plans.lineage import collect_small
from frameml.sources.tables import read_table

PAIRS, TRIPLES = 1 << 12, 1 << 14
GRAMS = PAIRS + TRIPLES
# Grams after which more text no longer makes a margin surer; gap below which an answer is ambiguous.
EVIDENCE, GAP = 40.0, 0.5
MAX_LANGUAGES = 1_000
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def grams(part: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two bucket numbers for every byte of a slice of lower-cased text; GRAMS where there is no gram."""
    low = _PLAIN[part]
    latin = np.zeros(len(low), bool)
    latin[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
    x = (low + latin * np.uint8(32)).astype(np.uint64)
    out = np.full((len(x), 2), GRAMS, np.int64)
    two = x[:-1] | x[1:] << np.uint64(8)
    out[:-1, 0] = mix(two) % np.uint64(PAIRS)
    three = two[:-1] | x[2:] << np.uint64(16) | np.uint64(1 << 30)
    out[:-2, 1] = PAIRS + (mix(three) % np.uint64(TRIPLES)).astype(np.int64)
    blank = x == 32
    out[:-1, 0][blank[:-1] & blank[1:]] = GRAMS
    out[:-2, 1][blank[:-2] & blank[1:-1] | blank[1:-1] & blank[2:]] = GRAMS
    ends = at[1:][np.diff(at) > 0]
    out[ends - 1] = GRAMS
    out[np.maximum(ends - 2, 0), 1] = GRAMS
    return out


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """A row of +1 and -1 for each of n languages: all distinct splits for up to seven, else a random code."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 7:
        splits = [(1, *s) for s in itertools.product((1, -1), repeat=n - 1) if -1 in s]
        return np.array(splits, np.int8).T
    bits, rng, best = int(np.ceil(12 * np.log2(n))), np.random.default_rng(seed), None
    for _ in range(20):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(axis=1 - 1)) < n]
        apart = code.astype(int) @ code.T.astype(int)
        worst = (apart - 10**9 * np.eye(n, dtype=int)).max()
        if best is None or worst < best[0]:
            best = (worst, code)
    return best[1]


@dataclass(frozen=True)
class CodeModel:
    languages: tuple
    code: np.ndarray
    weights: np.ndarray  # (GRAMS + 1, bits), the last row zero
    trust: np.ndarray  # weight of each bit

    def decode(self, margins: np.ndarray):
        """(number of the nearest codeword, its share, whether it is ambiguous)."""
        loss = (np.log1p(np.exp(-margins[:, None, :] * self.code[None])) * self.trust).sum(axis=2)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        ranked = np.sort(loss, axis=1)
        unsure = ranked[:, 1] - ranked[:, 0] < GAP if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        return loss.argmin(axis=1), share.max(axis=1), unsure


def fit_model(languages: list[str], counts: np.ndarray) -> CodeModel:
    """From gram counts, one row a language."""
    code = codewords(len(languages))
    smooth = counts + 0.5
    share = np.concatenate([smooth[:, :PAIRS] / smooth[:, :PAIRS].sum(axis=1, keepdims=True),
                            smooth[:, PAIRS:] / smooth[:, PAIRS:].sum(axis=1, keepdims=True)], axis=1)
    weights, trust = np.zeros((GRAMS + 1, code.shape[1]), np.float32), np.ones(code.shape[1])
    for b in range(code.shape[1]):
        with_, without = share[code[:, b] > 0], share[code[:, b] < 0]
        if len(with_) and len(without):
            weights[:GRAMS, b] = np.log(with_.mean(axis=0) / without.mean(axis=0))
            margin = (share @ weights[:GRAMS, b]) * code[:, b]
            trust[b] = max(float(margin.min()), 0.05)
    return CodeModel(tuple(languages), code, weights, trust / trust.mean())


def _count(batches: Iterator) -> Iterator:
    import pyarrow as pa

    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = string_buffers(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), object)
        for i, j in slices(offsets, 1_000_000):
            found = grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            of = np.repeat(np.arange(i, j), np.diff(offsets[i:j + 1]))
            for lang in set(langs[i:j]):
                own = found[np.isin(of, np.flatnonzero(langs == lang))]
                total = totals.setdefault(lang, np.zeros(GRAMS + 1, np.int64))
                total += np.bincount(own.ravel(), minlength=GRAMS + 1)
    for lang, total in totals.items():
        some = np.flatnonzero(total[:GRAMS])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(total[some])],
                                         names=["lang", "gram", "n"])


def learn_languages(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> CodeModel:
    """Count the grams of every row with a text and a language.  The driver gets at
    most GRAMS numbers for each of at most MAX_LANGUAGES languages."""
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    table = (rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    got = collect_small(table, GRAMS * MAX_LANGUAGES)
    langs = got.column("lang").to_numpy(zero_copy_only=False)
    names = sorted(set(langs))
    counts = np.zeros((len(names), GRAMS))
    counts[np.searchsorted(names, langs) if names else np.zeros(0, int), got.column("gram").to_numpy()] = got.column("n").to_numpy()
    return fit_model(names, counts)


def _predict(model: CodeModel, text: str, alpha: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, offsets = string_buffers(batch.column(text))
            n = len(offsets) - 1
            margins = np.zeros((n, model.code.shape[1]))
            for i, j in slices(offsets, 500_000):
                at = offsets[i:j + 1] - offsets[i]
                some = np.flatnonzero(np.diff(at))
                if not len(some):
                    continue
                found = grams(data[offsets[i]:offsets[j]], at)
                total = np.add.reduceat(model.weights[found[:, 0]] + model.weights[found[:, 1]], at[some], axis=0)
                count = np.add.reduceat((found < GRAMS).sum(axis=1), at[some])
                evidence = np.minimum(count, EVIDENCE) / np.maximum(count, 1)
                margins[i + some] = total * evidence[:, None]
            letters = batch.column(alpha).to_numpy(zero_copy_only=False).astype(bool)
            if model.languages:
                best, share, unsure = model.decode(np.clip(margins, -50, 50))
                names = np.array(model.languages, object)[best]
            else:
                share, unsure, letters = np.zeros(n), np.ones(n, bool), np.zeros(n, bool)
                names = np.full(n, "und", object)
            names[~letters] = "und"
            kept = [c for c in batch.schema.names if c != alpha]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(names, pa.string()),
                 pa.array(np.where(letters, share, 0.0)), pa.array(unsure | ~letters)],
                names=[*kept, "lang_pred", "score", "ambiguous"])

    return run


def identify_language(df: DataFrame, model: CodeModel, text_col: str = "text") -> DataFrame:
    """Add lang_pred, score (0 to 1) and ambiguous, in place of columns of these names.

    A null text, one without a letter, and every text where the model knows no
    language, is ``und`` with score 0 and ambiguous.  Ties go to the first name.
    """
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())]
    df = df.drop(*(f.name for f in added))
    alpha = "has_letter"
    while alpha in df.columns:
        alpha += "_"
    rows = df.withColumn(alpha, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    return rows.mapInArrow(_predict(model, text_col, alpha), StructType([*df.schema.fields, *added]))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = learn_languages(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return (identify_language(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "ambiguous"))


QUERIES = {"op6_language": op6_language}
SQL: dict[str, str] = {}
