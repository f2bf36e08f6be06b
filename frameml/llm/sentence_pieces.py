"""Encoding and decoding with a piece vocabulary by vectorised merge rounds.

A text is cut wherever no piece of the vocabulary holds the two characters
side by side: no merge can cross such a place, so the words between them are
independent and equal words are merged once.  The words of a window of text lie
in flat numpy arrays.  Every round takes the segmented minimum of the pair ranks
of each word, merges all its leftmost places at once, and compacts; words
without a pair leave.  A merge can open a pair that ranks as high as itself or higher
(piece scores need not fall along a merge tree); such a piece is
merged at its first place only, so that the order is the one of a queue by
rank and place.  Words longer than ``LONG`` symbols are merged with that queue,
which keeps their cost at n log n.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from frameml.llm.hashing import BASE, BASE_INVERSE, mix, powers, slices, string_buffers
from frameml.sources.tables import read_table

# Bytes of text that one window holds, and symbols of the longest word merged in rounds.
WINDOW, LONG = 500_000, 256
SPACE_MARK = "▁"
UNKNOWN_SURFACE = " ⁇ "
NONE = np.int32(2**31 - 1)


@dataclass(frozen=True)
class PieceModel:
    """What the workers need of a vocabulary: pieces, scores and the special ids."""

    pieces: tuple[str, ...]
    scores: np.ndarray
    normal: np.ndarray
    control: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    prefix: bool
    end: int


def read_model(path: str) -> PieceModel:
    """Read a byte-fallback BPE model; raises ValueError for one that rewrites the text first."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    normalizer = proto.normalizer_spec
    kinds = np.array([p.type for p in proto.pieces])
    if normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces or not normalizer.escape_whitespaces:
        raise ValueError("only models that keep the text as it is")
    if proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback:
        raise ValueError("only merge models with byte fallback")
    if proto.trainer_spec.treat_whitespace_as_suffix or np.isin(kinds, (4, 5)).any():
        raise ValueError("no user-defined or unused pieces, and spaces before words")
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    return PieceModel(tuple(p.piece for p in proto.pieces), np.array([p.score for p in proto.pieces], np.float32), kinds == 1,
                      kinds == 3, np.array([processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32),
                      processor.unk_id(), bool(normalizer.add_dummy_prefix), processor.eos_id())


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Merger:
    """Merge tables of a model; symbols are piece ids, then characters that are no piece."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        ids = {p: i for i, p in enumerate(model.pieces) if model.normal[i]}
        self.parts = sorted(set("".join(ids)) - set(ids))
        self.size = len(model.pieces) + len(self.parts)
        rank = np.full(self.size, -1, np.int64)
        places = np.flatnonzero(model.normal)
        rank[places] = np.unique(-model.scores[places], return_inverse=True)[1]
        ids |= {c: len(model.pieces) + k for k, c in enumerate(self.parts)}
        alphabet = sorted({ord(c) for p in ids for c in p})
        self.number = np.zeros(0x110000, np.int16 if len(alphabet) < 2**15 - 1 else np.int32)
        self.number[alphabet] = np.arange(1, len(alphabet) + 1)
        self.symbol = np.array([-1] + [ids[chr(c)] for c in alphabet], np.int32)
        self.joined = np.zeros((len(alphabet) + 1,) * 2, bool)
        pairs: dict[int, int] = {}
        open_again = np.zeros(self.size, bool)
        for piece, i in ids.items():
            at = self.number[[ord(c) for c in piece]]
            self.joined[at[:-1], at[1:]] = True
            for k in range(1, len(piece)):
                a, b = ids.get(piece[:k]), ids.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = i
                    for part in (a, b):
                        open_again[part] |= rank[i] <= rank[part]
        self.rank, self.open_again, self.pairs = rank.astype(np.int32), open_again, pairs
        # Open addressing: a pair's merged symbol in one or two look-ups.
        self.bits = max(int(4 * len(pairs) + 1).bit_length(), 4)
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.values = np.full(len(self.keys), -1, np.int32)
        self.longest = 1
        for key, value in pairs.items():
            at = int(self._slot(np.array([key], np.int64))[0])
            steps = 1
            while self.keys[at] >= 0:
                at, steps = at + 1, steps + 1
            self.keys[at], self.values[at], self.longest = key, value, max(self.longest, steps)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that each pair merges to, or -1."""
        out = np.full(len(left), -1, np.int32)
        rest = np.flatnonzero((left >= 0) & (right >= 0) & (left < self.size) & (right < self.size))
        key = left[rest].astype(np.int64) * self.size + right[rest]
        at = self._slot(key)
        for _ in range(self.longest):
            if not len(rest):
                break
            hit = self.keys[at] == key
            out[rest[hit]] = self.values[at[hit]]
            go = ~hit & (self.keys[at] >= 0)
            rest, key, at = rest[go], key[go], at[go] + 1
        return out

    def queue(self, symbols: list[int]) -> list[int]:
        """One word merged pair by pair, best rank first, leftmost among equals."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n:
                to = self.pairs.get(symbols[i] * self.size + symbols[j])
                if to is not None:
                    heapq.heappush(heap, (int(self.rank[to]), i, symbols[i], symbols[j], to))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, a, b, to = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = to, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in symbols if s >= 0]

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word numbers) of all words after their last merge, in order of the words."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        sizes = np.bincount(word) if len(word) else np.zeros(0, np.int64)
        for w in np.flatnonzero(sizes > LONG):
            a = np.searchsorted(word, w)
            out = np.array(self.queue(symbols[a:a + sizes[w]].tolist()), np.int32)
            done.append((out, np.full(len(out), w)))
        if done:
            keep = sizes[word] <= LONG
            symbols, word = symbols[keep], word[keep]
        to = self._next(symbols, word, np.arange(len(symbols)))
        while len(symbols):
            rank = np.where(to >= 0, self.rank[to], NONE)
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(rank, first)
            if (best == NONE).any():
                rest = np.repeat(best != NONE, sizes)
                done.append((symbols[~rest], word[~rest]))
                symbols, word, to, rank = symbols[rest], word[rest], to[rest], rank[rest]
                best, sizes = best[best != NONE], sizes[best != NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            # Of places that overlap every second one is merged, from the left.
            new = np.concatenate(([True], np.diff(at) != 1))
            run = np.flatnonzero(new)[np.cumsum(new) - 1]
            lead = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
            at = at[np.where(self.open_again[to[at]], lead, (np.arange(len(at)) - run) % 2 == 0)]
            symbols[at] = to[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, to = symbols[keep], word[keep], to[keep]
            at = (np.cumsum(keep) - 1)[at]
            changed = np.zeros(len(symbols), bool)
            changed[at] = changed[np.maximum(at - 1, 0)] = True
            changed = np.flatnonzero(changed)
            to[changed] = self._next(symbols, word, changed)
        if not done:
            return symbols, word
        symbols, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _next(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What the pairs at the given places merge to; none across words."""
        out = np.full(len(at), -1, np.int32)
        inside = at < len(symbols) - 1
        inside[inside] = word[at[inside]] == word[at[inside] + 1]
        out[inside] = self.merged(symbols[at[inside]], symbols[at[inside] + 1])
        return out

    def ids(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of them each word has) of words given by their first places in the code points."""
        model, sizes = self.model, np.diff(np.append(starts, len(points)))
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        up, down = powers(BASE, len(points)), powers(BASE_INVERSE, len(points))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(points.astype(np.uint64) + BASE) * up[:-1])))
        digest = mix((sums[starts + sizes] - sums[starts]) * down[starts]) + sizes.astype(np.uint64)
        _, kept, same = np.unique(digest, return_index=True, return_inverse=True)
        # Equal digests are held against the characters themselves.
        if (sizes[kept][same] != sizes).any() or (points[_ranges(starts[kept][same], sizes)] != points).any():
            kept = same = np.arange(len(starts))
        where = points[_ranges(starts[kept], sizes[kept])]
        symbols = self.symbol[self.number[where]]
        symbols = np.where(symbols < 0, where.astype(np.int32) + self.size, symbols)
        symbols, word = self.merge(symbols.astype(np.int32), np.repeat(np.arange(len(kept)), sizes[kept]))
        strange = symbols >= len(model.pieces)
        if strange.any():
            spelled = [self._bytes_of(x) for x in symbols[strange].tolist()]
            counts = np.ones(len(symbols), np.int64)
            counts[strange] = list(map(len, spelled))
            symbols, word, strange = (np.repeat(x, counts) for x in (symbols, word, strange))
            symbols[strange] = np.concatenate(spelled)
        counts = np.bincount(word, minlength=len(kept))
        first = np.cumsum(counts) - counts
        return symbols[_ranges(first[same], counts[same])], counts[same]

    def _bytes_of(self, symbol: int) -> np.ndarray:
        """A character that is no piece, as byte pieces."""
        at = symbol - len(self.model.pieces)
        return self.model.byte_ids[list((self.parts[at] if at < len(self.parts) else chr(symbol - self.size)).encode())]

    def word_starts(self, points: np.ndarray) -> np.ndarray:
        number = self.number[points]
        return np.flatnonzero(np.concatenate(([True], ~self.joined[number[:-1], number[1:]])))[:len(points)]


def _points(data: np.ndarray) -> np.ndarray:
    text = np.frombuffer(bytes(data).decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    text[text == 32] = ord(SPACE_MARK)
    return text


class Encoder:
    """Ids of whole texts, window by window."""

    def __init__(self, model: PieceModel, window: int = WINDOW) -> None:
        self.merger, self.window = Merger(model), window
        self.prefix = np.full(int(model.prefix), ord(SPACE_MARK), np.int64)

    def column(self, column) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) for every text of an Arrow string column."""
        data, offsets = string_buffers(column)
        for i, j in slices(offsets, self.window):
            if offsets[j] - offsets[i] > self.window:
                yield i, self._long(data[offsets[i]:offsets[j]])
            else:
                ids, ends = self._together(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for r in range(j - i):
                    yield i + r, ids[ends[r]:ends[r + 1]]

    def _together(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        points, at = _points(data), leads[offsets]
        full = np.flatnonzero(np.diff(at))
        first = at[full] + np.arange(len(full)) * len(self.prefix)
        if len(self.prefix):
            points = np.insert(points, at[full], self.prefix[0])
        begins = np.zeros(len(points), bool)
        begins[self.merger.word_starts(points)] = begins[first] = True
        starts = np.flatnonzero(begins)
        ids, counts = self.merger.ids(points, starts)
        text = full[np.searchsorted(first, starts, "right") - 1] if len(full) else starts
        each = np.bincount(text, counts, minlength=len(offsets) - 1).astype(np.int64)
        return ids, np.concatenate(([0], np.cumsum(each)))

    def _long(self, data: np.ndarray) -> np.ndarray:
        """A text beyond the window, cut between words; a word beyond it stays whole."""
        out, at, left = [], 0, self.prefix
        while at < len(data):
            stop = min(at + self.window, len(data))
            while stop < len(data) and data[stop] & 0xC0 == 0x80:
                stop += 1
            points = np.concatenate((left, _points(data[at:stop])))
            starts = self.merger.word_starts(points)
            left = points[:0] if stop == len(data) else points[starts[-1]:]
            if len(left) < len(points):
                starts = starts if not len(left) else starts[:-1]
                out.append(self.merger.ids(points[:len(points) - len(left)], starts)[0])
            at = stop
        if len(left):
            out.append(self.merger.ids(left, np.zeros(1, np.int64))[0])
        return np.concatenate(out) if out else np.zeros(0, np.int32)


class Decoder:
    """Texts of id lists."""

    def __init__(self, model: PieceModel) -> None:
        surface = [p.replace(SPACE_MARK, " ").encode() for p in model.pieces]
        for i in np.flatnonzero(model.control).tolist():
            surface[i] = b""
        surface[model.unknown] = UNKNOWN_SURFACE.encode()
        for b, i in enumerate(model.byte_ids.tolist()):
            surface[i] = bytes([b])
        self.sizes = np.array(list(map(len, surface)), np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(surface), np.uint8)
        self.control, self.is_byte = model.control, np.zeros(len(surface), bool)
        self.is_byte[model.byte_ids] = True
        self.marked = np.array([model.prefix and bool(n) and p.startswith(SPACE_MARK)
                                for p, n in zip(model.pieces, model.normal)], bool)

    def text(self, ids: np.ndarray) -> str:
        """The mark before the first piece that shows goes; each byte that belongs to no character is U+FFFD."""
        if len(ids) and ((ids < 0) | (ids >= len(self.sizes))).any():
            raise ValueError("an id outside the vocabulary")
        shown = ids[~self.control[ids]] if len(ids) else ids
        out = self.data[_ranges(self.first[shown], self.sizes[shown])]
        skip = int(len(shown) > 0 and self.marked[shown[0]])
        try:
            return out[skip:].tobytes().decode()
        except UnicodeDecodeError:
            return self._by_runs(ids)[skip:]

    def _by_runs(self, ids: np.ndarray) -> str:
        edge = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        out = []
        for run in np.split(ids, edge):
            data = self.data[_ranges(self.first[run], self.sizes[run])].tobytes()
            out.append(_characters(data) if self.is_byte[run[0]] else data.decode())
        return "".join(out)


def _characters(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        size = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
        try:
            out.append(data[at:at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("\ufffd")
            at += 1
    return "".join(out)


def _encode_batches(model: PieceModel, ending: bool, window: int, decoded: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder, tail = Encoder(model, window), np.full(int(ending), model.end, np.int32)
        decoder = Decoder(model) if decoded else None

        def out(batch, rows, ids):
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(ids).astype(np.int32)))
            kept = batch.slice(rows[0], len(rows))
            texts = [pa.array([decoder.text(x) for x in ids], pa.string())] if decoder else []
            return pa.RecordBatch.from_arrays([kept.column(0), lists, *texts], names=["id", "ids", "decoded"][:2 + len(texts)])

        for batch in batches:
            rows, ids, held = [], [], 0
            for row, found in encoder.column(batch.column(1)):
                rows.append(row)
                ids.append(np.concatenate((found, tail)))
                held += len(ids[-1])
                if held > window // 4:
                    yield out(batch, rows, ids)
                    rows, ids, held = [], [], 0
            if rows:
                yield out(batch, rows, ids)

    return run


def _decode_batches(model: PieceModel):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        decoder = Decoder(model)
        for batch in batches:
            column = batch.column("ids")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate(
                ([0], np.cumsum(np.nan_to_num(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64))))
            texts = [decoder.text(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def encode_pieces(docs: DataFrame, model: PieceModel, ending: bool = True, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, decoded: bool = False) -> DataFrame:
    """One row per document: (doc_id, ids array<int>), the ids of its whole text; with ``decoded``
    also the text that the ids give back, made in the same task.

    A null text is empty; an empty text has the end id alone (nothing without
    ``ending``).  Repeated rows and rows without id are encoded like others,
    columns besides the two are ignored, an empty table gives an empty result.
    Between pairs of one rank the leftmost merges first.  Characters outside the
    vocabulary become byte pieces.  ``window`` bounds the text held at a time.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, ids array<int>" + ", decoded string" * decoded
    return rows.mapInArrow(_encode_batches(model, ending, window, decoded), schema).withColumnRenamed("id", "doc_id")


def decode_pieces(encoded: DataFrame, model: PieceModel, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the text of every id list in ``out_col``; a null or empty list gives an empty text.

    Ids must lie in the vocabulary (ValueError).  All columns stay; an existing
    ``out_col`` is replaced.
    """
    kept = [c for c in encoded.columns if c != out_col]
    plain = [f"c{i}" for i in range(len(kept))]
    rows = encoded.select(*(F.col(f"`{c}`").alias(p) for c, p in zip(kept, plain)),
                          F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])
    read = rows.mapInArrow(_decode_batches(model), schema)
    return read.select(*(F.col(p).alias(c) for c, p in zip(kept, plain)), F.col("decoded").alias(out_col))


def piece_report(docs: DataFrame, model: PieceModel) -> DataFrame:
    """Digests of the ids of every document and of the text that they give back."""
    back = encode_pieces(docs, model, decoded=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_report(read_table(spark, sf_dir, "documents"), read_model(public_tokenizers.path("piece_bpe_32k.model")))


QUERIES = {"op11_sentence_pieces": op11_sentence_pieces}
# Merging by rank has no SQL twin; tests/llm holds it against the library.
SQL: dict[str, str] = {}
