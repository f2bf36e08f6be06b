"""Licence scan: winnowed fingerprints and banded alignment.

Templates are cut into word 3-grams and winnowed; an inverted index maps a
fingerprint to the template places that have it.  One vectorised pass looks the
3-grams of every text up.  Hits on a common diagonal make a candidate, which a
banded alignment of the template with the words around that diagonal turns into
a matched coverage and a span of the text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.llm.hashing import PrefixHash, mix, slices, string_buffers, words
from frameml.sources.tables import read_table

GRAM, WINDOW, COVERAGE = 3, 2, 0.8
FOUND = "doc_id long, template string, coverage double, matched int, start int, stop int"
# Public licence notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "mit": "Released under the MIT License",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
        "the Software is furnished to do so, subject to the following conditions:"),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
}
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[48:58] = np.arange(48, 58)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def _rolled(word: np.ndarray) -> np.ndarray:
    """Digests of all runs of GRAM words."""
    n = max(0, len(word) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out += word[k:k + n] * np.uint64(2 * k + 3) ** np.uint64(5)
    return mix(out)


def winnow(prints: np.ndarray) -> list[int]:
    """Places of the smallest fingerprint, the rightmost of equal ones, of every WINDOW in a row."""
    if len(prints) <= WINDOW:
        return [len(prints) - 1 - int(prints[::-1].argmin())] if len(prints) else []
    spans = range(len(prints) - WINDOW + 1)
    return sorted({i + WINDOW - 1 - int(prints[i:i + WINDOW][::-1].argmin()) for i in spans})


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """(matched words, first word, end word) of the best alignment of the whole
    template with words of the text near the diagonal ``shift``: match 1, else -1."""
    m, width = len(template), 2 * band + 1
    low = -10**6
    score = np.full((m + 1, width + 2), low)
    back = np.zeros((m + 1, width + 2), np.int8)
    score[0, 1:-1] = 0
    for i in range(1, m + 1):
        for k in range(1, width + 1):
            j = shift + i + k - 1 - band  # words of the text before this cell
            hit = 1 <= j <= len(text) and text[j - 1] == template[i - 1]
            options = ((score[i - 1, k] + (1 if hit else -1) if 1 <= j <= len(text) else low),
                       score[i - 1, k + 1] - 1, score[i, k - 1] - 1 if 1 <= j <= len(text) else low)
            back[i, k] = int(np.argmax(options))
            score[i, k] = options[back[i, k]]
    k = 1 + int(score[m, 1:-1].argmax())
    i, matched, last, first = m, 0, 0, 0
    while i > 0:
        j = shift + i + k - 1 - band
        if back[i, k] == 0:
            if not 1 <= j <= len(text):
                break  # the band lies beside the text
            if text[j - 1] == template[i - 1]:
                matched, first, last = matched + 1, j - 1, last or j
            i -= 1
        elif back[i, k] == 1:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return matched, first, last


class Scanner:
    def __init__(self, templates: dict[str, str]) -> None:
        self.hasher, self.templates, index = PrefixHash(), {}, defaultdict(list)
        for name in sorted(templates):
            data = _PLAIN[np.frombuffer(templates[name].encode(), np.uint8)]
            self.hasher.load(data)
            start, end, _ = words(data, np.array([0, len(data)]))
            word = self.hasher.ranges(start, end)
            self.templates[name] = word
            prints = _rolled(word)
            for place in winnow(prints):
                index[int(prints[place])].append((name, place))
        self.index = dict(index)
        self.keys = np.array(sorted(index), np.uint64)

    def scan(self, column) -> Iterator[tuple[int, str, float, int, int, int]]:
        """(row, template, coverage, matched words, start, stop), positions in code points."""
        data, offsets = string_buffers(column)
        for i, j in slices(offsets, 1_000_000):
            raw, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            part = _PLAIN[raw]
            self.hasher.load(part)
            start, end, text = words(part, at)
            word = self.hasher.ranges(start, end)
            prints = _rolled(word)
            n = len(prints)
            if not n or not len(self.keys):
                continue
            near = np.minimum(np.searchsorted(self.keys, prints), len(self.keys) - 1)
            hits = np.flatnonzero((self.keys[near] == prints) & (text[:n] == text[GRAM - 1:]))
            tried = set()
            for h in hits.tolist():
                row = int(text[h])
                a, b = np.searchsorted(text, [row, row + 1])
                for name, place in self.index[int(prints[h])]:
                    template = self.templates[name]
                    band = max(2, len(template) // 10)
                    shift = h - int(a) - place
                    if any((row, name, s) in tried for s in range(shift - band, shift + band + 1)):
                        continue
                    tried.add((row, name, shift))
                    matched, first, last = align(template, word[a:b], shift, band)
                    if matched >= COVERAGE * len(template):
                        lead = at[row]
                        count = lambda stop: int(np.count_nonzero((raw[lead:stop] & 0xC0) != 0x80))
                        yield (i + row, name, matched / len(template), matched, count(start[a + first]), count(end[a + last - 1]))


def _scan(templates: dict[str, str]):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(templates)
        kinds = (pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
        for batch in batches:
            found = sorted(set(scanner.scan(batch.column("text"))))
            if found:
                row, *rest = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row)), *(pa.array(c, k) for c, k in zip(rest, kinds))],
                    names=["doc_id", "template", "coverage", "matched", "start", "stop"])

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per template found in a text: (doc_id, template, coverage, matched, start, stop).

    Words are runs of letters and digits in lower case (A-Z).  A template is
    reported at every place where at least COVERAGE of its words align; positions
    are code points of the text, end exclusive.  A template of fewer than GRAM
    words is never found.  Null and empty texts have no rows.  Rows without id
    are reported with a null doc_id, repeated rows each; other columns are
    ignored.  ``templates`` is a small dictionary that every task gets.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_scan(TEMPLATES if templates is None else templates), FOUND)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


QUERIES = {"op5_licenses": op5_licenses}
SQL: dict[str, str] = {}
