"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a document with at most ``k = rate * length`` edits.
Cut into ``k + 1`` pieces, at least one piece then occurs unchanged.  All pieces
of a block of items are found in one pass over the text (Aho-Corasick); each
hit opens a window around the place where the item would lie, and Myers'
bit-parallel algorithm computes the smallest edit distance of the item to a
substring of the window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.plans.lineage import cut_lineage
from frameml.sources.tables import read_table

RATE = 0.05
# Items of one block: its automaton goes to every task; more items take more passes.
BLOCK_ITEMS = 5_000
FOUND = "doc_id long, item_id long, distance int, start int, stop int"
_GAPS = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    """Lower case, runs of anything but letters and digits as one space, trimmed."""
    return _GAPS.sub(" ", (text or "").lower()).strip()


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 adjacent pieces of nearly equal length, with their starts."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_end(masks: dict[str, int], m: int, window: str) -> tuple[int, int]:
    """(smallest edit distance of the pattern to a substring of the window, its first end): Myers 1999."""
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = ones, 0, m, (m, 0)
    for j, c in enumerate(window, 1):
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        gain, loss = down | (ones & ~(across | up)), up & across
        if gain & top:
            score += 1
        elif loss & top:
            score -= 1
        vertical = eq | down
        gain, loss = (gain << 1) & ones, (loss << 1) & ones
        up, down = loss | (ones & ~(vertical | gain)), gain & vertical
        if score < best[0]:
            best = (score, j)
    return best


def masks_of(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        import ahocorasick

        self.items, self.automaton = [], ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            if not text:
                continue
            k = int(rate * len(text))
            for start, piece in pieces(text, k):
                places.setdefault(piece, []).append((len(self.items), start))
            self.items.append((item_id, text, k, masks_of(text), masks_of(text[::-1])))
        for piece, uses in places.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item number -> (smallest distance, start, stop) for all within their budget."""
        best: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        if not self.items or not text:
            return best
        for end, (length, uses) in self.automaton.iter(text):
            for number, offset in uses:
                start = end + 1 - length - offset
                if (number, start) in tried or best.get(number, (1,))[0] == 0:
                    continue
                tried.add((number, start))
                _, item, k, masks, reverse = self.items[number]
                m = len(item)
                if start >= 0 and text.startswith(item, start):
                    best[number] = (0, start, start + m)
                    continue
                low = max(0, start - k)
                distance, stop = best_end(masks, m, text[low:start + m + k])
                if distance <= k and distance < best.get(number, (k + 1,))[0]:
                    stop += low
                    _, back = best_end(reverse, m, text[max(0, stop - m - k):stop][::-1])
                    best[number] = (distance, stop - back, stop)
        return best


def _search(items: list[tuple[int, str]], rate: float):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        matcher = Matcher(items, rate)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                for number, (distance, start, stop) in matcher.find(normalise(text.as_py())).items():
                    rows.append((doc_id.as_py(), matcher.items[number][0], distance, start, stop))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "item_id", "distance", "start", "stop"])

    return run


def _keep_clean(items: list[tuple[int, str]], rate: float, text_col: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        matcher = Matcher(items, rate)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.find(normalise(t.as_py())) for t in batch.column(text_col)], pa.bool_()))

    return run


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                most: int = BLOCK_ITEMS) -> Iterator[list[tuple[int, str]]]:
    """The items, normalised, in blocks of at most ``most``; null and empty ones are left out."""
    items = cut_lineage(benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
                        .where("item_id is not null and text is not null and text <> ''").distinct())
    blocks = -(-items.count() // (most // 2)) or 1
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield sorted((r["item_id"], normalise(r["text"])) for r in rows)


def find_contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: (doc_id, item_id, distance, start, stop).

    Texts and items are compared in lower case with every run of characters other
    than letters and digits as one space; positions are those of the normalised
    text, of the place of smallest distance.  An item of n characters may differ
    by int(rate * n) edits.  Null, empty and mark-only texts and items match
    nothing.  Rows without id are searched and reported with a null doc_id;
    repeated rows are reported each.  Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for items in item_blocks(benchmark):
        found = docs.mapInArrow(_search(items, rate), FOUND)
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text") -> DataFrame:
    """The documents in which no item is found; all columns and rows without text stay."""
    for items in item_blocks(benchmark):
        docs = docs.mapInArrow(_keep_clean(items, rate, text_col), docs.schema)
    return docs


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_decontamination": op2_decontamination}
SQL: dict[str, str] = {}
