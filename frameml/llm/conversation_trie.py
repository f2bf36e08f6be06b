"""The prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns.  Turns are reduced to digests, and a
sequence to the sum of its turns' digests times powers of an odd base (two
lanes of 64 bits), so that the digest of every prefix is a running sum.  Running
sums are taken over range-partitioned rows: each partition adds what the
partitions before it hold of its first conversation, so one conversation
may be spread over many tasks.

One aggregation of all (conversation, depth) rows finds the nodes of every depth
with their members.  What only one conversation has, the tail behind its last
shared turn, is peeled at once.  The shared nodes are then peeled from
the greatest depth: the nodes of a depth are what ended or began its tail there
merged with what is left of the depth below it, stripped of the last turn and
regrouped; sums of leaves and savings go along.  Only members that end at a node
are needed as a list; they are sorted and joined in range partitions too, and
the digest of a list that spans several of them is taken over its joined parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.llm.hashing import BASE, BASE_INVERSE, powers
from frameml.plans.lineage import cut_lineage
from frameml.sources.tables import read_table

# Text of member lists that is joined into one part, about.
PART_BYTES = 1_000_000
NOTHING = hashlib.sha256().hexdigest()


def _segments(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)


class Running:
    """Place and running digest of rows that come sorted by conversation."""

    def __init__(self, conv: int | None = None, count: int = 0, sums: tuple[int, ...] = (0, 0)) -> None:
        self.conv, self.count, self.sums = conv, count, sums
        self.up = np.ones(1, np.uint64)

    def add(self, conv: np.ndarray, lanes: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """(place, digests without the row, digests with the row); remembers where the last conversation stands."""
        n = len(conv)
        if n >= len(self.up):
            self.up = powers(BASE, max(n, 1 << 14))
        first = _segments(conv)
        sizes = np.diff(np.append(first, n))
        local = np.arange(n) - np.repeat(first, sizes)
        goes_on = self.conv is not None and conv[0] == self.conv
        before, base = (self.count, pow(int(BASE), self.count, 2**64)) if goes_on else (0, 1)
        head = sizes[0]
        place = local + np.where(np.arange(n) < head, before, 0)
        without, through, ends = [], [], []
        for lane, start in zip(lanes, self.sums if goes_on else (0, 0)):
            value = lane * self.up[local]
            value[:head] *= np.uint64(base)
            total = np.cumsum(value)
            total -= np.repeat(total[first] - value[first], sizes)
            total[:head] += np.uint64(start)
            through.append(total)
            without.append(total - value)
            ends.append(int(total[-1]))
        self.conv, self.count, self.sums = int(conv[-1]), int(place[-1]) + 1, tuple(ends)
        return place, without, through


def _columns(batch) -> tuple[np.ndarray, list[np.ndarray]]:
    return batch.column("conv").to_numpy(), [batch.column(c).to_numpy().view(np.uint64) for c in ("a", "b")]


def _summaries(batches: Iterator) -> Iterator:
    """One line for a partition: its first and last conversation and where the last stands."""
    import pyarrow as pa

    first, running = None, Running()
    for batch in batches:
        if batch.num_rows:
            conv, lanes = _columns(batch)
            first = int(conv[0]) if first is None else first
            running.add(conv, lanes)
    if first is not None:
        line = [TaskContext.get().partitionId(), first, running.conv, running.count, *(np.uint64(s).view(np.int64) for s in running.sums)]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in line],
                                         names=["pid", "first", "last", "count", "a", "b"])


def _carries(lines) -> dict[int, tuple[int, int, tuple[int, int]]]:
    """For each partition where its first conversation stands before it."""
    out, conv, count, sums = {}, None, 0, (0, 0)
    for line in sorted(lines, key=lambda r: r["pid"]):
        out[line["pid"]] = (conv, count, sums)
        ends = tuple(x % 2**64 for x in (line["a"], line["b"]))
        if line["first"] == line["last"] == conv:
            base = pow(int(BASE), count, 2**64)
            count, sums = count + line["count"], tuple((s + base * e) % 2**64 for s, e in zip(sums, ends))
        else:
            conv, count, sums = line["last"], line["count"], ends
    return out


def _run_on(carries: dict):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        running = Running(*carries.get(TaskContext.get().partitionId(), ()))
        for batch in batches:
            if batch.num_rows:
                conv, lanes = _columns(batch)
                place, without, through = running.add(conv, lanes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv"), pa.array(place), *(pa.array(x.view(np.int64)) for x in (*through, *without)),
                     batch.column("bytes")], names=["conv", "place", "a", "b", "pa", "pb", "bytes"])

    return run


def running_digests(turns: DataFrame) -> DataFrame:
    """(conv, place, a, b, pa, pb, bytes): each turn's place from 0 and the digests of the turns up to it and before it."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", F.col("turn").asc_nulls_first(), "a", "b"]
    turns = cut_lineage(turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv", "a", "b", "bytes"))
    # One line for a partition.
    lines = turns.mapInArrow(_summaries, "pid long, first long, last long, count long, a long, b long").collect()
    return turns.mapInArrow(_run_on(_carries(lines)), "conv long, place long, a long, b long, pa long, pb long, bytes long")


def _shift(batches: Iterator) -> Iterator:
    """Digests of own turns behind the borrowed head: head + (own - own's first) moved to their new places."""
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        read = lambda c: batch.column(c).to_numpy().view(np.uint64)
        less = batch.column("less").to_numpy()
        factor = powers(BASE_INVERSE, int(less.max()))[less]
        out = [read("h" + c[-1]) + (read(c) - read("o" + c[-1])) * factor for c in ("a", "b", "pa", "pb")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "depth")), *(pa.array(x.view(np.int64)) for x in out),
                                          batch.column("bytes")], names=["conv", "depth", "a", "b", "pa", "pb", "bytes"])


def rebuilt_prefixes(own: DataFrame, convs: DataFrame, borrow: DataFrame, longest: int) -> DataFrame:
    """(conv, depth, a, b, pa, pb, bytes) of rebuilt conversations: the first ``h`` turns of ``base``,
    then own turns after the first ``h`` (at most ``longest``); borrow has (conv, base, h), convs (conv, size)."""
    heads = own.where(F.col("place") < longest)
    bases = convs.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    plan = (borrow.join(bases, "base", "left")
            .withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0).cast("long")))))
    # A digest at the cut, of the base and of the conversation itself; none at place 0.
    at = heads.select(F.col("conv").alias("who"), (F.col("place") + 1).alias("cut"), "a", "b")
    plan = (plan.join(at.toDF("base", "taken", "ha", "hb"), ["base", "taken"], "left")
            .join(at.toDF("conv", "h", "oa", "ob"), ["conv", "h"], "left"))
    zero = F.lit(0).cast("long")
    plan = cut_lineage(plan.select("conv", "base", "h", "taken", *(F.coalesce(c, zero).alias(c) for c in ("ha", "hb", "oa", "ob"))))
    borrowed = (plan.where("taken > 0").select("conv", "base", "taken")
                .join(heads.withColumnRenamed("conv", "base"), "base").where(F.col("place") < F.col("taken"))
                .select("conv", (F.col("place") + 1).alias("depth"), "a", "b", "pa", "pb", "bytes"))
    kept = (own.join(plan, "conv").where(F.col("place") >= F.col("h"))
            .withColumn("less", F.col("h") - F.col("taken")).withColumn("depth", F.col("place") - F.col("less") + 1)
            .select("conv", "depth", "a", "b", "pa", "pb", "bytes", "less", "ha", "hb", "oa", "ob")
            .mapInArrow(_shift, "conv long, depth long, a long, b long, pa long, pb long, bytes long"))
    return borrowed.union(kept)


def _join_ids(batches: Iterator) -> Iterator:
    """Sorted (depth, a, b, conv) to joined parts; a list that lies inside the partition is finished."""
    import pyarrow as pa

    pid, kept, open_key, parts, number = TaskContext.get().partitionId(), [], None, [], 0
    first_key, held = None, 0

    def line(key, data, last):
        # The partition's first and last list may go on in another one.
        whole = number == 0 and last and key != first_key
        return (*key, pid, number, hashlib.sha256(data).hexdigest() if whole else None, None if whole else data)

    def out():
        kind = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("pid", pa.int32()), ("part", pa.int32()),
                          ("sha", pa.string()), ("data", pa.binary())])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), kind)], schema=kind)

    for batch in batches:
        if not batch.num_rows:
            continue
        depth, a, b, conv = (batch.column(c).to_numpy() for c in ("depth", "a", "b", "conv"))
        first = np.flatnonzero(np.concatenate(([True], (np.diff(depth) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0))))
        for i, j in zip(first, np.append(first[1:], len(conv))):
            key = (int(depth[i]), int(a[i]), int(b[i]))
            if key != open_key:
                if open_key is not None:
                    kept.append(line(open_key, b",".join(parts), True))
                first_key = first_key or key
                open_key, parts, number, held = key, [], 0, 0
            for k in range(i, j, PART_BYTES // 20):
                ids = ",".join(map(str, conv[k:min(k + PART_BYTES // 20, j)].tolist())).encode()
                parts.append(ids)
                held += len(ids)
                if held >= PART_BYTES:
                    kept.append(line(key, b",".join(parts), False))
                    parts, number, held = [], number + 1, 0
        if kept:
            yield out()
            kept = []
    if open_key is not None and parts:
        kept = [(*open_key, pid, number, None, b",".join(parts))]
        yield out()


def _hash_parts(batches: Iterator) -> Iterator:
    """Digests of lists whose parts come in order."""
    import pyarrow as pa

    key = sha = None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()) for k in key] + [pa.array([sha.hexdigest()])],
                                          names=["depth", "a", "b", "sha"])

    for batch in batches:
        for *now, data in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b", "data"))):
            if now != key:
                if key is not None:
                    yield out()
                key, sha = now, hashlib.sha256(data)
            else:
                sha.update(b"," + data)
    if key is not None:
        yield out()


def list_digests(members: DataFrame) -> DataFrame:
    """(depth, a, b, sha) of (depth, a, b, conv): SHA-256 of the ids in rising order, joined by commas.
    Sorting and joining are spread over range partitions; only joined parts of lists that cross their borders meet again."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["depth", "a", "b", "conv"]
    kind = "depth long, a long, b long, pid int, part int, sha string, data binary"
    joined = cut_lineage(members.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_join_ids, kind))
    torn = (joined.where("sha is null").repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "pid", "part")
            .mapInArrow(_hash_parts, "depth long, a long, b long, sha string"))
    return joined.where("sha is not null").select("depth", "a", "b", "sha").union(torn)


def prefix_trie(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``prefixes`` holds (conv, depth, a, b, pa, pb, bytes): for every depth from 1 to a conversation's
    length the digests of its first turns with and without the last, and the last text's bytes.
    ``convs`` holds (conv, length).  See ``conversation_trie`` for the columns.
    """
    zero = F.lit(0).cast("long")
    rows = prefixes.join(convs.select("conv", "length"), "conv").withColumn("ends", F.col("depth") == F.col("length"))
    roots = convs.select("conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("pa"), zero.alias("pb"),
                         zero.alias("bytes"), F.col("length").alias("length"), (F.col("length") == 0).alias("ends"))
    rows = rows.select(*roots.columns).union(roots)
    ended = F.when(F.col("ends"), F.col("conv"))
    nodes = cut_lineage(rows.groupBy("depth", "a", "b").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.max("bytes").alias("bytes"), F.count(ended).alias("n_ends"), F.min(ended).alias("end_id")))
    # A node of one conversation belongs to its tail; the root counts as shared.
    alone = (F.col("n_convs") == 1) & (F.col("depth") > 0)
    tails = nodes.where(alone)
    shared = cut_lineage(nodes.where(~alone))
    sha = F.when(F.col("n_ends") == 0, NOTHING).when(F.col("n_ends") == 1, F.sha2(F.col("end_id").cast("string").cast("binary"), 256))
    tops = cut_lineage(tails.groupBy("conv_id").agg(F.min("depth").alias("top"), F.min_by(F.struct("pa", "pb"), "depth").alias("p")))
    begun = tops.select((F.col("top") - 1).alias("depth"), F.col("p.pa").alias("a"), F.col("p.pb").alias("b"),
                        F.lit(1).cast("long").alias("children"), F.lit(1).cast("long").alias("leaves"))
    begun = begun.groupBy("depth", "a", "b").agg(F.sum("children").alias("children"), F.sum("leaves").alias("leaves"))
    start = cut_lineage(shared.join(begun, ["depth", "a", "b"], "left").select(
        "depth", "a", "b", "pa", "pb", F.coalesce("children", zero).alias("children"), F.coalesce("leaves", zero).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")))
    peeled = _peel(start)
    whole = shared.join(peeled, ["depth", "a", "b"])
    # Lists of members: few nodes end more than one conversation.
    several = shared.where("n_ends > 1").select("depth", "a", "b")
    lists = list_digests(rows.where("ends").join(several, ["depth", "a", "b"], "left_semi").select("depth", "a", "b", "conv"))
    whole = whole.join(lists, ["depth", "a", "b"], "left")
    parent = shared.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                           F.col("conv_id").alias("parent"))
    whole = whole.join(parent, ["depth", "pa", "pb"], "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce(sha, "sha").alias("ends_sha256"))
    above = (tops.select("conv_id", F.col("top").alias("depth"), F.col("p.pa").alias("pa"), F.col("p.pb").alias("pb"))
             .join(parent, ["depth", "pa", "pb"]).select("conv_id", "depth", "parent"))
    one = F.lit(1).cast("long")
    lone = tails.join(above, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("parent", "conv_id").alias("parent_conv_id"), "n_convs",
        F.when(F.col("n_ends") == 1, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        sha.alias("ends_sha256"))
    return whole.union(lone)


def _peel(start: DataFrame) -> DataFrame:
    """(depth, a, b, children, leaves, saved) summed over subtrees, from the greatest depth to the root.
    One round for each depth that conversations share; a round reads and writes a depth's nodes only once."""
    deepest = start.agg(F.max("depth")).first()[0]
    out, survivors = start.limit(0).select("depth", "a", "b", "children", "leaves", "saved"), None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        level = start.where(F.col("depth") == depth).drop("depth")
        if survivors is not None:
            level = (level.union(survivors).groupBy("a", "b")
                     .agg(F.max("pa").alias("pa"), F.max("pb").alias("pb"),
                          *(F.sum(c).alias(c) for c in ("children", "leaves", "saved"))))
        # What has no child is a leaf itself.
        level = cut_lineage(level.withColumn("leaves", F.when(F.col("children") == 0, 1).otherwise(F.col("leaves"))))
        out = out.union(level.select(F.lit(depth).cast("long").alias("depth"), "a", "b", "children", "leaves", "saved"))
        # The last turn goes; the node above brings the digest of its own parent.
        nothing = F.lit(None).cast("long")
        survivors = level.select(F.col("pa").alias("a"), F.col("pb").alias("b"), nothing.alias("pa"), nothing.alias("pb"),
                                 F.lit(1).cast("long").alias("children"), "leaves", "saved")
    return out


def digested_turns(table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv, turn, a, b, bytes): two digests of role and text, nulls empty, and the text's length in UTF-8 bytes."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    return (table.where(F.col(f"`{conv_col}`").isNotNull())
            .select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                    F.xxhash64(F.lit("a"), role, text).alias("a"), F.xxhash64(F.lit("b"), text, role).alias("b"),
                    F.octet_length(text).cast("long").alias("bytes")))


def conversation_trie(table: DataFrame, block: int = 1, longest: int = 0, **columns: str) -> DataFrame:
    """The trie of the conversations of (conv_id, turn, role, text).

    One row per distinct sequence of first turns, the root included: its smallest member, depth,
    the parent's smallest member (root: null), members, children, childless nodes below or at it,
    the text bytes that sharing saves (over the subtree, members - 1 times the last text's), and the
    SHA-256 of its members that end there (ids in rising order, joined by commas).

    With ``block`` > 1 conversation c first takes over h = crc32(c) % (longest + 1) turns from
    conversation c - c % block, then its own after its first h.  Turns are ordered by ``turn``, null first;
    turns of one number in the order of their digests.  A null role or text is empty.  Rows without a
    conversation are left out; repeated rows are turns like others; other columns are ignored; an
    empty table has no node, not even a root.
    """
    own = cut_lineage(running_digests(digested_turns(table, **columns)))
    sizes = cut_lineage(own.groupBy("conv").agg((F.max("place") + 1).alias("size")))
    if block <= 1:
        return prefix_trie(own.withColumn("depth", F.col("place") + 1), sizes.withColumnRenamed("size", "length"))
    conv = F.col("conv")
    borrow = sizes.select("conv", (conv - conv % block).alias("base"),
                          (F.crc32(conv.cast("string").cast("binary")) % (longest + 1)).alias("h"))
    prefixes = cut_lineage(rebuilt_prefixes(own, sizes, borrow, longest))
    lengths = cut_lineage(sizes.join(prefixes.groupBy("conv").agg(F.max("depth").alias("d")), "conv", "left")
                          .select("conv", F.coalesce("d", F.lit(0).cast("long")).alias("length")))
    return prefix_trie(prefixes, lengths)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"), block=5, longest=8)


ORACLE = r"""
with crc as (
  select list_transform(range(256), lambda c: list_reduce(list_concat([c], range(8)),
         lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as t
), own as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first) as turns
  from conversations where conv_id is not null group by conv_id
), cut as (
  select conv_id, turns, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::varchar, ''),
         lambda x: unicode(x)::bigint)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 as h from own, crc
), path as (
  select c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) as p
  from cut c left join own b on b.conv_id = c.conv_id - c.conv_id % 5
), member as (
  select conv_id, p[1:d] as node, d, len(p) as n from (select conv_id, p, unnest(range(0, len(p) + 1)) as d from path)
), node as (
  select node, d, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d), '')) as ends_sha256
  from member group by node, d
), child as (
  select node[1:d - 1] as node, count(*) as n from node where d > 0 group by 1
), below as (
  select a.node, count(*) filter (not exists (from child where child.node = b.node)) as n_leaves,
         sum(case when b.d = 0 then 0 else (b.n_convs - 1) * octet_length(encode(b.node[b.d].text)) end) as saved
  from node a join node b on b.node[1:a.d] = a.node group by a.node
)
select node.conv_id, node.d as depth, up.conv_id as parent_conv_id, node.n_convs, coalesce(child.n, 0)::bigint as n_children,
       below.n_leaves, below.saved::bigint as saved_tokens, node.ends_sha256
from node join below on node.node = below.node left join child on child.node = node.node
left join node up on up.d = node.d - 1 and up.node = node.node[1:node.d - 1] and node.d > 0
"""

QUERIES = {"op13_conversation_trie": op13_conversation_trie}
SQL = {"op13_conversation_trie": ORACLE}
