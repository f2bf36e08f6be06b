"""Best-fit-decreasing packing of token sequences.

Lengths lie between 1 and the capacity, so the whole plan follows from how
many pieces there are of each length.  The driver packs that histogram:
lengths in falling order, each time into the tightest open bins that still
hold it, found in a segment tree over remaining capacities.  Equal pieces that
go to alike bins make one line of the plan, so its size depends on the
capacity and not on the documents.  Pieces are ranked within their length by
partition counts and look up their line.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameml.plans.lineage import cut_lineage
from frameml.sources.tables import read_table

CAPACITY = 2048
# Fixed value: how the byte-level vocabulary cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, pid int, local long"


class FirstFree:
    """Segment tree over 0..n-1: the smallest marked place at or after one."""

    def __init__(self, n: int) -> None:
        self.size = 1 << max(n - 1, 1).bit_length()
        self.any = [False] * (2 * self.size)

    def mark(self, i: int, on: bool) -> None:
        i += self.size
        self.any[i] = on
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def first(self, i: int) -> int | None:
        i += self.size
        if not self.any[i]:
            while i > 1 and (i % 2 or not self.any[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Lines (length, first rank, pieces a bin, first bin, offset) of best-fit decreasing.

    The piece of rank k of a line goes to bin first + (k - first rank) // pieces,
    behind the (k - first rank) % pieces before it.
    """
    open_bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    tree, lines, used = FirstFree(capacity + 1), [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            open_bins[room].append((first, n))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        k, total = 0, counts[length]
        while k < total:
            room = tree.first(length)
            if room is None:
                room = capacity
                bins = -(-(total - k) // (room // length))
                first, used = used, used + bins
            else:
                first, bins = open_bins[room].pop()
                tree.mark(room, bool(open_bins[room]))
            each = room // length
            take = min(bins, -(-(total - k) // each))
            items = min(total - k, take * each)
            full, rest = divmod(items, each)
            lines.append((length, k, each, first, capacity - room))
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + take, bins - take)
            k += items
    return np.array(lines, np.int64).reshape(-1, 5)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def special_tokens(path: str) -> dict[str, int]:
    """The strings that a tokenizer file turns into ids of their own, wherever they stand in a text."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError("special tokens that take in what is beside them are not supported")
    return {t["content"]: t["id"] for t in added}


def _encode(ranks_file: bytes, special: dict[str, int], capacity: int, closing: int, with_ids: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import tiktoken

        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks_file.splitlines())}
        encoder = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        pid, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            where, rows, ids = [], [], []
            for i in range(len(texts)):
                codes = encoder.encode(texts[i].as_py() or "", allowed_special="all")
                codes.append(closing)
                data = np.array(codes, "<u4")
                pieces = -(-len(data) // capacity)
                start = 0
                for piece in range(pieces):
                    stop = len(data) - (pieces - 1 - piece) * capacity
                    length = stop - start
                    rows.append((piece, start, length, zlib.crc32(data[start:stop].tobytes()), pid, seen[length]))
                    if with_ids:
                        ids.append(data[start:stop].astype(np.int32))
                    seen[length] += 1
                    where.append(i)
                    start = stop
            if not rows:
                continue
            columns = [np.array(c) for c in zip(*rows)]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            arrays = [doc_ids.take(pa.array(where)), *(pa.array(c.astype(np.int64)).cast(k) for c, k in zip(columns, kinds))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "pid", "local"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _look_up(lines: np.ndarray):
    order = np.lexsort((lines[:, 1], lines[:, 0]))
    lines = lines[order]
    # Lines of one length start at rising ranks: one sorted key finds the line of (length, rank).
    starts = lines[:, 0] * (1 << 48) + lines[:, 1]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            at = np.searchsorted(starts, length * (1 << 48) + rank, "right") - 1
            nth = rank - lines[at, 1]
            sequence = lines[at, 3] + nth // lines[at, 2]
            offset = lines[at, 4] + nth % lines[at, 2] * length
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(sequence), pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, closing: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False, special: dict[str, int] | None = None) -> DataFrame:
    """Tokenize, cut and pack: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A document is the ids of its whole text followed by ``closing``.  Only one of
    more than ``capacity`` ids is cut, into pieces of ``capacity`` of which the
    first may be shorter.  A null text is empty (one piece, the closing id);
    strings named in ``special`` become its ids.  Rows without id and repeated
    rows are packed like others.  Other columns are ignored; an empty table gives
    an empty result.  ``with_ids`` adds the ids themselves.
    """
    with open(ranks_path, "rb") as f:
        vocabulary = f.read()
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = cut_lineage(docs.mapInArrow(_encode(vocabulary, special or {}, capacity, closing, with_ids),
                                         PIECES + (", ids array<int>" if with_ids else "")))
    counts = cut_lineage(pieces.groupBy("pid", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("pid", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(bases, ["pid", "length"]).withColumn("rank", F.col("base") + F.col("local"))
              .drop("pid", "local", "base"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    ranked = ranked.select(*names, "rank")
    schema = ranked.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(_look_up(best_fit_plan(histogram, capacity)), schema)


def vocabulary_path() -> str:
    import public_tokenizers

    # The same vocabulary and ids as byte_bpe_50k.json, as ranks.
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def vocabulary_special() -> dict[str, int]:
    import public_tokenizers

    return special_tokens(public_tokenizers.path("byte_bpe_50k.json"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), vocabulary_path(), special=vocabulary_special())


QUERIES = {"op4_packing": op4_packing}
SQL: dict[str, str] = {}
