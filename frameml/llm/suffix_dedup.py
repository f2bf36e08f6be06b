"""Suffix-array deduplication of byte strings.

A byte goes when a string of 100 bytes covers it that also starts earlier.
Suffixes are taken at content-defined tokens: every 100-byte window picks the
smallest of its 32-byte strings (by digest, the rightmost of equal ones), so
equal windows pick the same place, and one suffix stands for the run of windows
that picked it.  Its sort key is the leading token (the digest of the 32 bytes)
and the digest of all bytes that its run of windows covers.

1. Sampled splitters range-partition the suffixes by leading token.  A bucket
   sorts by multikey quicksort (a later key only inside runs of equal earlier
   ones).  A suffix whose whole run equals an earlier one gives its bytes away.
2. Leading tokens with several different runs, where repeated passages begin
   and end, are settled window by window: the windows' digests are partitioned
   over all buckets, which compares across the boundaries of runs.
3. Removed ranges meet their texts.

Equal suffixes of one map task are combined before the shuffle, so a passage of
a third of all texts sends one suffix a task.  Digests have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.llm.hashing import PrefixHash, mix, slices, string_buffers
from frameml.plans.lineage import cut_lineage
from frameml.sources.tables import read_table

LENGTH, TOKEN = 100, 32
# Bytes of text that a bucket stands for, about, and suffixes held before they are combined and sent.
BUCKET_BYTES, FLUSH = 16_000_000, 400_000
SAMPLE_TEXTS = 2_000
_PLACE = np.uint64((1 << 28) - 1)
PACKED = "kind int, bucket long, payload binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def multikey_sort(*keys: np.ndarray) -> np.ndarray:
    """Order by several keys; each further key is looked at only in runs of equal earlier ones."""
    order = np.argsort(keys[0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = keys[0][order][1:] != keys[0][order][:-1]
    for key in keys[1:]:
        run = np.cumsum(new)
        tied = np.flatnonzero(~new | np.concatenate((~new[1:], [False])))
        if not len(tied):
            break
        order[tied] = order[tied][np.lexsort((key[order[tied]], run[tied]))]
        new[1:] |= key[order][1:] != key[order][:-1]
    return order


def _heads(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the index at which each element's run of equal keys starts."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)


def suffixes(part: np.ndarray, at: np.ndarray, hasher: PrefixHash):
    """(text number, place, first window, last window, token, run digest) of every suffix of a slice."""
    hasher.load(part)
    windows = len(part) - LENGTH + 1
    empty = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    if windows <= 0:
        return empty
    i = np.arange(len(part) - TOKEN + 1)
    token = hasher.ranges(i, i + TOKEN)
    low = (token & ~_PLACE) | (_PLACE - i.astype(np.uint64))
    size, width = 1, LENGTH - TOKEN + 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:windows], low[width - size:width - size + windows])
    place = (_PLACE - (low & _PLACE)).astype(np.int64)
    inside = np.ones(windows + LENGTH, bool)
    for k in range(1, LENGTH):
        inside[np.maximum(at[1:] - k, 0)] = False
    ends = np.flatnonzero(np.diff(at) < LENGTH)
    for r in ends:
        inside[at[r]:at[r + 1]] = False
    p = np.flatnonzero(inside[:windows])
    if not len(p):
        return empty
    new = np.ones(len(p), bool)
    new[1:] = (place[p[1:]] != place[p[:-1]]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(p)])) - 1
    lo, hi, a = p[first], p[last], place[p[first]]
    shape = ((a - lo) * 128 + hi - lo).astype(np.uint64)
    run = mix(hasher.ranges(lo, hi + LENGTH) + mix(shape))
    return [np.searchsorted(at, lo, "right") - 1, a, lo, hi, token[a], run]


def _rows(found: list[tuple[int, int, bytes]]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64()),
         pa.array([f[2] for f in found], pa.binary())], names=["kind", "bucket", "payload"])


def _pack(bucket: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple[int, int, bytes]]:
    """One row of packed columns for every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    columns = np.stack([c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64) for c in columns])[:, order]
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-2))
    return [(kind, int(bucket[order[a]]), columns[:, a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]


def _unpack(payloads: list[bytes], width: int) -> np.ndarray:
    if not payloads:
        return np.zeros((width, 0), np.int64)
    return np.concatenate([np.frombuffer(p, np.int64).reshape(width, -1) for p in payloads], axis=1)


def _ranges(doc: np.ndarray, start: np.ndarray, stop: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    """Removed ranges, those of a text that touch made one, packed by the text's bucket."""
    if not len(doc):
        return []
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    # Stops as ranks over texts, so that one running maximum serves all.
    base = _heads(doc)
    reach = np.maximum.accumulate(stop + base * (1 << 31)) - base * (1 << 31)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(doc)])) - 1
    return _pack(doc_bucket(doc[first], buckets), 0, doc[first], start[first], reach[last])


def doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _map_tokens(batches: Iterator) -> Iterator:
    import pyarrow as pa

    hasher = PrefixHash()
    for batch in batches:
        data, offsets = string_buffers(batch.column("text"))
        for i, j in slices(offsets, 1_000_000):
            found = suffixes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], hasher)
            yield pa.RecordBatch.from_arrays([pa.array(found[4].view(np.int64) >> 1)], names=["token"])


def _map_suffixes(splitters: np.ndarray, buckets: int):
    def run(batches: Iterator) -> Iterator:
        hasher, held, count = PrefixHash(), [], 0

        def flush():
            doc, a, lo, hi, token, digest = (np.concatenate(c) for c in zip(*held))
            given = doc, a, lo, hi, token, digest
            order = multikey_sort(token, digest, doc, a)
            doc, a, lo, hi, token, digest = (c[order] for c in given)
            head = _heads(token, digest)
            again = (doc != doc[head]) | (a != a[head])
            out = _ranges(doc[again], lo[again], hi[again] + LENGTH, buckets)
            # Sent in the order of the texts, in which ids compress.
            one = np.sort(order[head == np.arange(len(head))])
            doc, a, lo, hi, token, digest = (c[one] for c in given)
            packed = (a << 16) | ((a - lo) << 8) | (hi - lo)
            out += _pack(np.searchsorted(splitters, token.view(np.int64) >> 1), 1, token, digest, doc, packed)
            yield _rows(out)

        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            data, offsets = string_buffers(batch.column("text"))
            for i, j in slices(offsets, 1_000_000):
                at = offsets[i:j + 1] - offsets[i]
                text, a, lo, hi, token, digest = suffixes(data[offsets[i]:offsets[j]], at, hasher)
                held.append((ids[i + text].astype(np.int64), a - at[text], lo - at[text], hi - at[text], token, digest))
                count += len(a)
                if count > FLUSH:
                    yield from flush()
                    held, count = [], 0
        if count:
            yield from flush()

    return run


def _reduce_suffixes(buckets: int):
    """Ranges of suffixes that repeat (kind 0) and the suffixes of tokens with several runs (kind 1)."""
    def run(table):
        import pyarrow as pa

        kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
        out = [(0, b, p) for k, b, p in zip(kinds, table.column("bucket").to_pylist(), payloads) if k == 0]
        token, digest, doc, packed = _unpack([p for k, p in zip(kinds, payloads) if k == 1], 4)
        if len(token):
            order = multikey_sort(token, digest, doc, packed)
            token, digest, doc, packed = (c[order] for c in (token, digest, doc, packed))
            a, lo = packed >> 16, (packed >> 16) - (packed >> 8 & 255)
            hi = lo + (packed & 255)
            head = _heads(token, digest)
            again = (doc != doc[head]) | (a != a[head])
            out += _ranges(doc[again], lo[again], hi[again] + LENGTH, buckets)
            one = np.flatnonzero(head == np.arange(len(head)))
            run_of = _heads(token[one])
            several = np.bincount(run_of, minlength=len(one))[run_of] > 1
            one = one[several]
            out += _pack(doc_bucket(doc[one], buckets), 1, doc[one], lo[one], hi[one])
        return pa.Table.from_batches([_rows(out)])

    return run


def _by_doc(table):
    """(ids, bytes, offsets) of the texts of a bucket."""
    ids = table.column("doc_id").to_numpy()
    data, offsets = string_buffers(table.column("text"))
    return ids, data, offsets


def _windows(buckets: int):
    """Digests of the open windows of a bucket's texts: the first of each goes on, the others are ranges."""
    def run(texts, opened):
        import pyarrow as pa

        doc, lo, hi = _unpack(opened.column("payload").to_pylist(), 3)
        ids, data, offsets = _by_doc(texts)
        hasher, out = PrefixHash(), []
        if len(doc) and len(ids):
            sort = np.argsort(ids, kind="stable")
            row = sort[np.minimum(np.searchsorted(ids[sort], doc), len(ids) - 1)]
            fits = (ids[row] == doc) & (offsets[row] + hi + LENGTH <= offsets[row + 1])
            doc, lo, hi, row = doc[fits], lo[fits], hi[fits], row[fits]
            digests, docs, starts = [], [], []
            for i, j in slices(offsets, 1_000_000):
                own = np.flatnonzero((row >= i) & (row < j))
                if not len(own):
                    continue
                hasher.load(data[offsets[i]:offsets[j]])
                n = hi[own] - lo[own] + 1
                start = np.repeat(lo[own] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                place = start + np.repeat(offsets[row[own]] - offsets[i], n)
                digests.append(hasher.ranges(place, place + LENGTH))
                docs.append(np.repeat(doc[own], n))
                starts.append(start)
            if digests:
                digest, doc, start = map(np.concatenate, (digests, docs, starts))
                out = _first_windows(digest, doc, start, buckets, True)
        return pa.Table.from_batches([_rows(out)])

    return run


def _first_windows(digest, doc, start, buckets: int, pass_on: bool):
    given = digest, doc, start
    order = multikey_sort(*given)
    digest, doc, start = (c[order] for c in given)
    head = _heads(digest)
    again = (doc != doc[head]) | (start != start[head])
    out = _ranges(doc[again], start[again], start[again] + LENGTH, buckets)
    if pass_on:
        one = np.sort(order[head == np.arange(len(head))])
        digest, doc, start = (c[one] for c in given)
        out += _pack((digest % np.uint64(buckets)).astype(np.int64), 1, digest, doc, start)
    return out


def _reduce_windows(buckets: int):
    def run(table):
        import pyarrow as pa

        kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
        out = [(0, b, p) for k, b, p in zip(kinds, table.column("bucket").to_pylist(), payloads) if k == 0]
        digest, doc, start = _unpack([p for k, p in zip(kinds, payloads) if k == 1], 3)
        if len(doc):
            out += _first_windows(digest.view(np.uint64), doc, start, buckets, False)
        return pa.Table.from_batches([_rows(out)])

    return run


def _finish(texts, ranges):
    """The remaining bytes of every text of a bucket."""
    import pyarrow as pa

    doc, start, stop = _unpack(ranges.column("payload").to_pylist(), 3)
    order = np.argsort(doc, kind="stable")
    doc, start, stop = doc[order], start[order], stop[order]
    ids, data, offsets = _by_doc(texts)
    rows = []
    for r, doc_id in enumerate(ids.tolist()):
        text = data[offsets[r]:offsets[r + 1]]
        a, b = np.searchsorted(doc, [doc_id, doc_id + 1])
        change = np.zeros(len(text) + 1, np.int64)
        np.add.at(change, np.minimum(start[a:b], len(text)), 1)
        np.add.at(change, np.minimum(stop[a:b], len(text)), -1)
        gone = np.cumsum(change[:-1]) > 0
        spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1])))) if len(text) else 0
        rows.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(text[~gone].tobytes()).hexdigest()))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*rows)) or [()] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_ranges(docs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The texts with their buckets, and packed removed ranges by bucket."""
    count = docs.count()
    share = min(1.0, SAMPLE_TEXTS / max(count, 1))
    cuts = docs.sample(share, 5).mapInArrow(_map_tokens, "token long").agg(
        F.percentile_approx("token", [i / buckets for i in range(1, buckets)], 10_000)).first()[0]
    splitters = np.array(cuts or [], np.int64)
    first = cut_lineage(docs.mapInArrow(_map_suffixes(splitters, buckets), PACKED)
                        .groupBy((F.col("bucket") + F.col("kind") * 0).alias("b")).applyInArrow(_reduce_suffixes(buckets), PACKED))
    texts = docs.withColumn("bucket", _bucket_column(buckets))
    windows = (texts.groupBy("bucket").cogroup(first.where("kind = 1").groupBy("bucket"))
               .applyInArrow(_windows(buckets), PACKED))
    second = cut_lineage(windows.groupBy(F.col("bucket").alias("b")).applyInArrow(_reduce_windows(buckets), PACKED))
    return texts, first.where("kind = 0").union(second.where("kind = 0"))


def _bucket_column(buckets: int):
    @F.pandas_udf("long")
    def of(ids):
        return __import__("pandas").Series(doc_bucket(ids.to_numpy(), buckets))

    return of("doc_id")


def dedup_suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: (doc_id, n_bytes, n_removed, n_spans, kept_sha256).

    A byte of the UTF-8 text is removed when a string of 100 bytes covers it that
    also starts earlier: in a text of smaller id or before it in the same text.
    Strings do not cross texts and are judged on the input.  A null text is empty.
    Rows of one id are copies of one document and get the same ranges.  A row
    without id keeps all its bytes and removes none.  Other columns are ignored;
    an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    nameless = docs.where(F.col("doc_id").isNull()).select(
        "doc_id", F.octet_length("text").cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.sha2("text", 256))
    docs = docs.where(F.col("doc_id").isNotNull())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    texts, ranges = repeated_ranges(docs, max(32, size // BUCKET_BYTES))
    return (texts.groupBy("bucket").cogroup(ranges.groupBy("bucket")).applyInArrow(_finish, RESULT)).union(nameless)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_suffixes(read_table(spark, sf_dir, "documents"))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
SQL: dict[str, str] = {}
