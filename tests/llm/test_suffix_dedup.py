import hashlib

import numpy as np

from frameml.llm.suffix_dedup import dedup_suffixes, multikey_sort


def brute(rows):
    """Every 100-byte string in order of (id, start)."""
    seen, out = {}, {}
    texts = {}
    for doc, text in rows:
        texts[doc] = (text or "").encode()
    for doc in sorted(texts):
        data = texts[doc]
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            s = data[p:p + 100]
            if s in seen:
                gone[p:p + 100] = b"\1" * 100
            else:
                seen[s] = (doc, p)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeé "), rng.integers(1, 9))) for _ in range(400)]
    make = lambda n: " ".join(rng.choice(words, n))
    shared, other = make(40), make(25)
    rows = [(i, make(rng.integers(0, 60)) + (shared if i % 3 == 0 else "") + make(5)) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(10)]
    rows += [(200, "the " * 200), (201, "x" * 450), (202, "x" * 99), (203, ""), (204, None), (205, other + "|" + other),
             (206, shared[:100]), (207, "y" + shared[3:120] + "z"), (208, other[5:]), (-5, shared)]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1, "b") for d, t in rows], "doc_id long, text string, kind int, bucket string")
    got = {r["doc_id"]: tuple(r)[1:] for r in dedup_suffixes(df.repartition(5)).collect()}
    assert got == brute(rows)


def test_empty_table_null_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert dedup_suffixes(spark.createDataFrame([], schema)).count() == 0
    text = "abcdefghij" * 9 + "klmnopqrstuvw"
    got = dedup_suffixes(spark.createDataFrame([(None, text), (1, text), (1, text), (2, text)], schema)).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in got) == [(-1, 0), (1, 0), (1, 0), (2, 103)]


def test_multikey_sort():
    rng = np.random.default_rng(0)
    a, b, c = (rng.integers(0, 4, 500) for _ in range(3))
    assert (multikey_sort(a, b, c) == np.lexsort((c, b, a))).all()
