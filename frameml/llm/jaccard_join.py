"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles with Jaccard similarity J >= 85 % differ in at most
15/185 (|A| + |B|) elements.  Sizes are cut into bands; instance ``i`` joins
the sets of band ``i`` and those of band ``i + 1`` small enough to be similar
to one of them, and has a bound ``k`` on the difference.  The shingle domain
is cut into groups of partitions.  A scheme that leaves ``c`` partitions of a group out
needs ``k // (c + 1) + 1`` groups: one then holds at most ``c`` differing elements,
which touch ``c`` partitions, so the two sets agree on one of the subsets of the
others.  Every (instance, group, subset) gives one signature.

A subset may be empty in a set, and sets that share only emptiness are not
similar.  With ``spare`` more groups a similar pair agrees on ``spare + 1`` subsets at
least, and what is empty on one side of an agreement is so on the other.  A set with at
most ``spare`` empty subsets therefore leaves them out.  The few sets with more
leave them out too and add the signatures of a second scheme with larger
subsets: two such sets meet there.

Sets that share a signature meet at the smallest id of its bucket (a star, not
all pairs).  Stars are filtered by sketches and verified exactly; buckets whose
members then still lie in different components compare the sketches of all pairs
across components, in tiles of bounded size, and the pairs left are verified, so
no link between different components is lost.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.llm.components import connected_components
from frameml.llm.hashing import PrefixHash, mix, shingle_sets
from frameml.plans.lineage import cut_lineage, join_summary
from frameml.sources.tables import read_table

# Bytes of text whose signatures one bucket of the shuffle holds, about.
BUCKET_BYTES = 4_000_000
# Signatures gathered in a map task before equal ones are combined and sent.
FLUSH = 300_000
# Bytes of text whose arrays a worker holds at a time, but for longer texts.
SLICE = 250_000
BAND_RATIO = 1.3
# The first scheme takes no more groups than leave this share of subsets empty.
EMPTY = 0.05
# The second scheme leaves this many partitions out.
SECOND = 4
# Members of a bucket that one tile compares with as many others.
TILE = 1024
# Members of buckets, about, that one task deals out with their sketches.
TASK_LINES = 20_000

PACKED = "bucket long, kind int, payload binary"
ROWS = "kind int, a long, b long, c long, d long"


@dataclass(frozen=True)
class Scheme:
    """``groups`` of ``parts`` partitions, of which every ``left_out`` are left out in turn."""

    groups: int
    parts: int
    left_out: int
    spare: int

    @property
    def count(self) -> int:
        return self.groups * math.comb(self.parts, self.left_out)

    def signatures(self, shingles: np.ndarray, values: np.ndarray, tag: int) -> tuple[np.ndarray, np.ndarray]:
        """One for each group and subset, and whether the subset is empty."""
        cells = self.groups * self.parts
        cell = (((shingles >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(cells, np.uint64)
        np.add.at(sums, cell, values)
        gone = np.array([[p in out for out in itertools.combinations(range(self.parts), self.left_out)] for p in range(self.parts)])
        size = np.bincount(cell, minlength=cells).reshape(-1, self.parts) @ (~gone).astype(np.int64)
        kept = sums.reshape(-1, self.parts) @ (~gone).astype(np.uint64)
        tags = np.arange(kept.size, dtype=np.uint64).reshape(kept.shape) + np.uint64(tag)
        return mix(kept + mix(tags)).ravel(), (size == 0).ravel()


def first_scheme(k: int, size: int, second: Scheme) -> Scheme:
    """The scheme with the fewest signatures for sets of about ``size`` elements, those counted that
    sets with more than ``spare`` empty subsets add by the second one."""
    found = []
    for parts in (2, 3):
        for spare in range(k // 2 + 2):
            groups = k // 2 + 1 + spare
            empty = (1 - (parts - 1) / (groups * parts)) ** size
            if empty > EMPTY and found:
                break
            # Empty subsets come about as in a Poisson distribution.
            mean = groups * parts * empty
            often = 1 - sum(math.exp(x * math.log(mean) - mean - math.lgamma(x + 1)) for x in range(spare + 1))
            found.append((groups * parts + max(often, 0.0) * second.count, Scheme(groups, parts, 1, spare)))
    return min(found, key=lambda f: f[0])[1]


def second_scheme(k: int) -> Scheme:
    out = min(k, SECOND)
    return Scheme(k // (out + 1) + 1, 2 * out + 2 * (out < SECOND), out, 0)


class Bands:
    """Size bands and the signature scheme of each instance, for J >= percent / 100."""

    def __init__(self, percent: int) -> None:
        self.percent, self.edges, self.schemes = percent, [1], {}

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(max(self.edges[-1] + 1, int(np.ceil(self.edges[-1] * self._ratio()))))
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def _ratio(self) -> float:
        return max(BAND_RATIO, 100.01 / self.percent)

    def instances(self, n: int) -> list[tuple[int, Scheme, Scheme]]:
        """(instance, first and second scheme) of a set of n elements; none where only equal sets are similar."""
        i, out = self.band(n), []
        for j in (i - 1, i):
            if j < 0 or (top := self.edges[j + 1] - 1) * 100 < n * self.percent:
                continue
            if j not in self.schemes:
                k = (100 - self.percent) * (top + top * 100 // self.percent) // (100 + self.percent)
                second = second_scheme(k)
                self.schemes[j] = (first_scheme(k, math.isqrt(self.edges[j] * top), second), second) if k else None
            if self.schemes[j]:
                out.append((j, *self.schemes[j]))
        return out

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        if not len(shingles):
            return np.zeros(0, np.uint64)
        values = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
        out = []
        for j, first, second in self.instances(len(shingles)):
            found, empty = first.signatures(shingles, values, j << 40)
            out.append(found[~empty])
            if empty.sum() > first.spare:
                out.append(second.signatures(shingles, values, j << 40 | 1 << 60)[0])
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    a = mix(shingles).sum(dtype=np.uint64)
    b = mix(shingles ^ np.uint64(0xD1342543DE82EF95)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _pack(**columns: np.ndarray) -> bytes:
    """Columns of numbers byte by byte: first bytes of all, then second ones.  Leading bytes of sorted
    signatures and of ids repeat, so that the shuffle's compression finds them."""
    numbers = np.stack([np.asarray(c, np.int64) for c in columns.values()])
    return numbers.view(np.uint8).reshape(*numbers.shape, 8).transpose(0, 2, 1).tobytes()


def _unpack(payload, width: int) -> np.ndarray:
    raw = np.frombuffer(payload, np.uint8).reshape(width, 8, -1)
    return np.ascontiguousarray(raw.transpose(0, 2, 1)).view(np.int64)[:, :, 0]


def _runs(keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the index at which each element's run starts."""
    new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def _stars(sig: np.ndarray, ids: np.ndarray):
    """Sorted distinct signatures with their smallest id, and (sig, hub, member) of the others."""
    order = np.lexsort((ids, sig))
    sig, ids = sig[order], ids[order]
    first = _runs(sig)
    head = first == np.arange(len(sig))
    tail = ~head & (ids != ids[first])
    return sig[head], ids[head], (sig[tail], ids[first[tail]], ids[tail])


def _map_signatures(width: int, percent: int, buckets: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher, bands = PrefixHash(), Bands(percent)
        sigs, owners, sets, held = [], [], [], 0

        def flush():
            if not sets:
                return
            rows = [(int(sets[0][0]) % buckets, 0, _pack(**dict(zip("abcd", np.array(sets, np.int64).T))))]
            sig, hub, star = _stars(np.concatenate(sigs), np.repeat(np.array([o for o, _ in owners], np.int64),
                                                                    [k for _, k in owners]))
            if len(star[0]):
                rows.append((int(star[1][0]) % buckets, 1, _pack(s=star[0].view(np.int64), h=star[1], m=star[2])))
            # Signatures are uniform, so their leading bits deal the sorted run out to the buckets.
            cuts = np.searchsorted((sig >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32),
                                   np.arange(buckets + 1, dtype=np.uint64))
            rows += [(b, 2, _pack(s=sig[cuts[b]:cuts[b + 1]].view(np.int64), h=hub[cuts[b]:cuts[b + 1]]))
                     for b in np.flatnonzero(np.diff(cuts)).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "payload"])

        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for row, shingles in shingle_sets(batch.column("text"), width, hasher, SLICE):
                sig = bands.signatures(shingles)
                sets.append((int(ids[row]), len(shingles), *_digest(shingles)))
                sigs.append(sig)
                owners.append((int(ids[row]), len(sig)))
                held += len(sig) + 20
                if held > FLUSH:
                    yield from flush()
                    sigs, owners, sets, held = [], [], [], 0
        yield from flush()

    return run


def _reduce_bucket(table):
    """Sets and local stars pass through; what is left of each signature meets once more."""
    import pyarrow as pa

    kinds, payloads = table.column("kind").to_pylist(), [p.as_buffer() for p in table.column("payload")]
    sets = [_unpack(p, 4) for k, p in zip(kinds, payloads) if k == 0]
    stars = [_unpack(p, 3) for k, p in zip(kinds, payloads) if k == 1]
    left = [_unpack(p, 2) for k, p in zip(kinds, payloads) if k == 2]
    if left:
        sig, ids = np.concatenate(left, axis=1)
        _, _, star = _stars(sig.view(np.uint64), ids)
        stars.append(np.stack([star[0].view(np.int64), star[1], star[2]]))
    stars = np.concatenate(stars, axis=1) if stars else np.zeros((3, 0), np.int64)
    sets = np.concatenate(sets, axis=1) if sets else np.zeros((4, 0), np.int64)
    n, m = sets.shape[1], stars.shape[1]
    blank = pa.nulls(m, pa.int64())
    return pa.table({
        "kind": pa.array(np.repeat(np.array([0, 1], np.int32), [n, m])),
        **{name: pa.concat_arrays([pa.array(sets[i]), pa.array(stars[i]) if i < 3 else blank])
           for i, name in enumerate("abcd")}})


def _map_sets(width: int, sketched: bool = False):
    """(doc_id, text) to (id, n, shingles array<long>) or to (id, n, sketch binary)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = PrefixHash()

        def out(ids, where, rows):
            sizes = [len(r) for r in rows]
            if sketched:
                values = pa.array([sketch(r).tobytes() for r in rows], pa.binary())
            else:
                values = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)),
                                                  pa.array(np.concatenate(rows).view(np.int64)))
            return pa.RecordBatch.from_arrays([ids.take(pa.array(where)), pa.array(sizes, pa.int64()), values],
                                              names=["id", "n", "value"])

        for batch in batches:
            ids, where, rows, held = batch.column("doc_id"), [], [], 0
            for row, shingles in shingle_sets(batch.column("text"), width, hasher, SLICE):
                rows.append(shingles)
                where.append(row)
                held += len(shingles)
                if held > FLUSH:
                    yield out(ids, where, rows)
                    where, rows, held = [], [], 0
            if rows:
                yield out(ids, where, rows)

    return run


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One byte for each of 2**m slots, the sum of the digests that fall there; 2**m is at least half the set's size.

    Sets that differ in d elements differ in at most d slots, so slots bound the
    difference from below.  Adding neighbouring slots gives the sketch of half the size.
    """
    m = max(int(len(shingles) - 1).bit_length() - 1, 3)
    slots = np.zeros(1 << m, np.uint8)
    np.add.at(slots, (shingles >> np.uint64(64 - m)).astype(np.int64), mix(shingles).astype(np.uint8))
    return slots


def fold(slots: np.ndarray, size: int) -> np.ndarray:
    return slots if len(slots) == size else slots.reshape(size, -1).sum(axis=1, dtype=np.uint8)


def _close(n, others, differing, percent: int):
    """Whether sizes and differing slots leave room for the similarity."""
    small, large = np.minimum(n, others), np.maximum(n, others)
    return (small * 100 >= large * percent) & (differing * (100 + percent) <= (100 - percent) * (small + large))


def _pairs_left(percent: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n, other = (batch.column(c).to_numpy() for c in ("n", "o"))
            differ = np.zeros(len(n), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_py(), np.uint8), np.frombuffer(y.as_py(), np.uint8)
                size = min(len(x), len(y))
                differ[i] = np.count_nonzero(fold(x, size) != fold(y, size))
            yield batch.select(["a", "b"]).filter(pa.array(_close(n, other, differ, percent)))

    return run


def _tile_left(percent: int):
    """Pairs of one tile of a bucket, across components, that their sketches leave possible."""
    def run(key, table):
        import pyarrow as pa

        first = key[1].as_py()
        ids, n, part, chunk = (table.column(c).to_numpy() for c in ("id", "n", "part", "chunk"))
        raw = [np.frombuffer(x, np.uint8) for x in table.column("value").to_pylist()]
        lists = [set(x) for x in table.column("sigs").to_pylist()]
        size = min(map(len, raw))
        slots = np.stack([fold(x, size) for x in raw])
        one, two = [], []
        across = key[1].as_py() != key[2].as_py()
        for i in range(len(ids)):
            j = np.flatnonzero(chunk != first) if across and chunk[i] == first else (
                np.arange(0) if across else np.arange(i + 1, len(ids)))
            j = j[(part[j] != part[i]) & _close(n[i], n[j], 0, percent)]
            if len(j):
                j = j[_close(n[i], n[j], np.count_nonzero(slots[j] != slots[i], axis=1), percent)]
                # A pair of several buckets belongs to the bucket of the smallest number.
                j = j[np.array([lists[i].isdisjoint(lists[k]) for k in j], bool)]
            one.append(np.full(len(j), i))
            two.append(j)
        a, b = ids[np.concatenate(one)], ids[np.concatenate(two)]
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return run


def _texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents that the pairs name."""
    ids = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    return join_summary(docs, ids, "doc_id", "left_semi")


def _possible(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches leave possible."""
    slots = _texts_of(docs, pairs).mapInArrow(_map_sets(width, True), "id long, n long, value binary")
    left = slots.select(F.col("id").alias("a"), "n", F.col("value").alias("x"))
    right = slots.select(F.col("id").alias("b"), F.col("n").alias("o"), F.col("value").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_pairs_left(percent), "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar; a repeated id links by any of its texts."""
    sets = _texts_of(docs, pairs).mapInArrow(_map_sets(width), "id long, n long, value array<long>")
    left = sets.select(F.col("id").alias("a"), F.col("value").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("value").alias("y"))
    common = F.size(F.array_intersect("x", "y")).cast("long")
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", common.alias("both"), (F.size("x") + F.size("y")).alias("total"))
            .where(100 * F.col("both") >= percent * (F.col("total") - F.col("both")))
            .select("a", "b"))


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id).

    Two documents link when their sets of ``width``-word shingles have Jaccard
    similarity >= percent / 100 (percent > 50); a component's id is its smallest
    document id.  A null or empty text, or one of white space, has an empty set
    and links with nothing.  Rows of one id are one node: what any of its texts links
    with is linked, and all of them but those with an empty set have its component.  A row
    without id keeps its count, has a null component and links with nothing.
    Other columns are ignored.  An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    nameless = (docs.where(F.col("doc_id").isNull()).mapInArrow(_map_sets(width), "id long, n long, value array<long>")
                .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.lit(None).cast("long").alias("component_id")))
    docs = docs.where(F.col("doc_id").isNotNull())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, size // BUCKET_BYTES)
    rows = cut_lineage(docs.mapInArrow(_map_signatures(width, percent, buckets), PACKED)
                       .groupBy("bucket").applyInArrow(_reduce_bucket, ROWS))
    sets = rows.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"),
                                         F.col("c").alias("d1"), F.col("d").alias("d2"))
    key = ["n_shingles", "d1", "d2"]
    # Documents of one set are one node, the smallest id.
    classes = cut_lineage(sets.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep")))
    member = cut_lineage(sets.join(classes, key, "left"))
    rep = cut_lineage(member.where("rep is not null").select("doc_id", "rep").distinct())
    stars = rows.where("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("hub"), F.col("c").alias("member"))
    stars = cut_lineage(
        stars.join(rep.select(F.col("doc_id").alias("hub"), F.col("rep").alias("p")), "hub")
        .join(rep.select(F.col("doc_id").alias("member"), F.col("rep").alias("q")), "member")
        .where("p != q").select("sig", F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())
    likely = cut_lineage(_possible(cut_lineage(stars.select("a", "b").distinct()), docs, width, percent))
    # The classes of a repeated id hang together.
    same = rep.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    same = same.join(rep, "doc_id").select("a", F.col("rep").alias("b"))
    parts = cut_lineage(connected_components(_verified(likely, docs, width, percent).union(same)))
    rest = cut_lineage(_pairs_across(stars, parts, docs, width, percent).join(likely, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        # Roots of the first components and the late links between them.
        more = _verified(rest, docs, width, percent)
        late = (more.join(parts.select(F.col("node").alias("a"), F.col("component").alias("x")), "a", "left")
                .join(parts.select(F.col("node").alias("b"), F.col("component").alias("y")), "b", "left")
                .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
        top = cut_lineage(connected_components(late)).select(F.col("node").alias("root"), F.col("component").alias("top"))
        # A late root is one of an earlier component or was alone.
        alone = top.select(F.col("root").alias("node")).join(parts, "node", "left_anti")
        parts = (parts.union(alone.select("node", "node")).join(top, F.col("component") == F.col("root"), "left")
                 .select("node", F.coalesce("top", "component").alias("component")))
    return (member.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
            .union(nameless))


def _pairs_across(stars: DataFrame, parts: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs that share a signature, lie in different components and are possible by their sketches."""
    a = parts.select(F.col("node").alias("a"), F.col("component").alias("x"))
    b = parts.select(F.col("node").alias("b"), F.col("component").alias("y"))
    known = cut_lineage(stars.join(a, "a", "left").join(b, "b", "left")
                        .select("sig", "a", "b", F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y")))
    inside = cut_lineage(known.select("sig", F.col("a").alias("id"), F.col("x").alias("part"))
                         .union(known.select("sig", "b", "y")).distinct())
    # A bucket whose members lie in one component is settled; of buckets with the
    # same members one is kept.  A bucket of two was tried as a star.
    alike = (inside.groupBy("sig").agg(
        F.count("*").alias("m"), F.min("part").alias("low"), F.max("part").alias("high"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("u"), F.sum(F.hash("id")).alias("v"))
        .where("low != high and m > 2").groupBy("m", "u", "v").agg(F.min("sig").alias("sig")))
    # Short numbers for the buckets, so that lists of them stay small.
    alike = cut_lineage(alike.select("sig", F.ceil(F.col("m") / TILE).alias("chunks"),
                                     F.monotonically_increasing_id().alias("number")))
    inside = cut_lineage(inside.join(alike, "sig").select(F.col("number").alias("sig"), "id", "part", "chunks",
                                                          F.pmod(F.xxhash64("id"), "chunks").alias("chunk")))
    ids = cut_lineage(inside.select(F.col("id").alias("doc_id")).distinct())
    slots = (join_summary(docs, ids, "doc_id", "left_semi")
             .mapInArrow(_map_sets(width, True), "id long, n long, value binary"))
    # One row of an id meets its sketch and is dealt out to its tiles on the way to them, so that no task holds
    # or sorts the copies, which take twenty times the bytes of the rows they come from.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), inside.count() // TASK_LINES)
    # As many buckets as a set has signatures at most.
    own = (inside.repartition(tasks, "id").groupBy("id", "part")
           .agg(F.sort_array(F.collect_list(F.struct("sig", "chunks", "chunk"))).alias("at")))
    # An id names the buckets before this one.
    each = (own.join(slots, "id").select("id", "part", "n", "value", F.col("at.sig").alias("all"), F.posexplode("at").alias("k", "here"))
            .select("id", "part", "n", "value", "here.*", F.slice("all", F.lit(1), F.col("k")).alias("sigs")))
    places = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
                         lambda k: F.struct(F.least("chunk", k).alias("i"), F.greatest("chunk", k).alias("j")))
    return (each.select("sig", "id", "part", "chunk", "sigs", "n", "value", F.explode(places).alias("t"))
            .select("sig", "t.i", "t.j", "id", "part", "chunk", "sigs", "n", "value")
            .groupBy("sig", "i", "j").applyInArrow(_tile_left(percent), "a long, b long").distinct())


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
), sh as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end) as s from w
), n as (select doc_id, count(*) as n from sh group by doc_id
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), link as (
  select a, b from pairs p join n x on p.a = x.doc_id join n y on p.b = y.doc_id where 100 * c >= 85 * (x.n + y.n - c)
), two as (select a, b from link union all select b, a from link
), reach as (
  select doc_id as id, doc_id as r from documents
  union select reach.id, two.b from reach join two on reach.r = two.a
), comp as (select id, min(r) as component_id from reach group by id)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, comp.component_id
from documents d left join n on d.doc_id = n.doc_id join comp on comp.id = d.doc_id
"""

QUERIES = {"op8_jaccard_join": op8_jaccard_join}
SQL = {"op8_jaccard_join": ORACLE}
