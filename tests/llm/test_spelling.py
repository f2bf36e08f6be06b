"""Spelling variants against comparing all words, and the whole query against plain Python."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from frameml.llm.spelling import near_words, op12_spelling, pivots, spelling_report, spelling_variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(counts):
    out = []
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = np.random.default_rng(0)
    place = np.sort(np.array([rng.choice(9, 3, False) for _ in range(300)]), axis=1)
    cost = rng.integers(1, 9, place.shape)
    got = pivots(place, cost)
    for p, c, (i, j) in zip(place, cost, got):
        costs = {(a, b): c[a] + c[b] for a, b in itertools.combinations(range(3), 2) if p[b] - p[a] >= 2}
        assert costs[i, j] == min(costs.values())


def test_all_near_words_are_found(spark):
    """Few letters, so that grams repeat, prefixes tie and words have many neighbours."""
    rng = random.Random(4)
    counts = {"".join(rng.choice("abà") for _ in range(rng.randint(1, 9))): rng.choice((0, 1, 2, 3, 4, 8, 9, 40)) for _ in range(700)}
    counts |= {"a" * 3000: 5, "a" * 2999 + "b": 50, "a" * 1500 + "z" + "a" * 1500: 7, "€uro": 1, "euro": 2, "😀uro": 4, "é": 9}
    table = [(w, n, "x") for w, n in counts.items() if n] + [(w, None, "x") for w, n in counts.items() if not n]
    table += [("", 5, "y"), (None, 6, "y")]
    words = spark.createDataFrame(table, "w string, n long, word string").repartition(5)
    got = rows(spelling_variants(words, "w", "n"))
    assert got == expected(counts)
    pairs = near_words(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert pairs.count() == sum(r[4] for r in got) // 2
    assert spelling_variants(words.limit(0), "w", "n").count() == 0


def test_counts_of_repeated_words_are_added(spark):
    words = spark.createDataFrame([("colour", 1), ("colour", 2), ("color", 6), ("colors", 12), ("xyzzy", 1)], "word string, n long")
    assert rows(spelling_variants(words)) == [("color", "colors", "colors", 6, 2, 12), ("colors", None, "colors", 12, 1, None),
                                              ("colour", "color", "colors", 3, 1, 6), ("xyzzy", None, "xyzzy", 1, 0, None)]


def vocabulary(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_report(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choice("ABcdéÜ×") for _ in range(rng.randint(4, 8))) for _ in range(40)]
    docs = [(d, " ".join(rng.choice(stems) for _ in range(120))) for d in range(60)] + [(None, " ".join(stems)), (3, None), (4, "")]
    docs += docs[:2]
    df = spark.createDataFrame([(*r, "w", 1) for r in docs], "doc_id long, text string, word string, n int").repartition(4)
    assert rows(spelling_report(df)) == expected(vocabulary(docs))
    assert spelling_report(df.limit(0)).count() == 0


def test_query_counts(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_spelling(spark, folder)
    assert {r["word"]: r["n"] for r in got.collect()} == vocabulary(docs)
    assert got.where(F.col("form").isNotNull() & (F.col("form_n") < 2 * F.col("n"))).isEmpty()
