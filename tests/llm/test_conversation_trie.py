"""The trie of conversations against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from frameml.llm.conversation_trie import Running, _carries, conversation_trie, list_digests

SCHEMA = "conv_id long, turn long, role string, text string, a string, depth int, conv long"


def expected(rows, block, longest):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in turns.items()}
    paths = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % (longest + 1) if block > 1 else 0
        paths[c] = tuple(own.get(c - c % block, [])[:h] + path[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(paths[c]) == len(node))
        out.append((min(of), len(node), min(members[node[:-1]]) if node else -1, len(of), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, 8) for r in rows], SCHEMA).repartition(6)


def conversations(seed):
    rng, rows = random.Random(seed), []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t if t or c % 7 else None, rng.choice(("user", None)), rng.choice(("a", "bé", "", None))))
    # Copies of a long conversation, one that is a prefix of it, one that leaves it late.
    for c in (200, 201, 202, 300, 301):
        for t in range({300: 20, 301: 28}.get(c, 30)):
            rows.append((c, t, "user", f"turn {t}" if (c, t) != (301, 27) else "other"))
    rows += [(400, 0, "user", "late")] * 3 + [(None, 0, "user", "nobody"), (403, 5, "user", "x" * 50_000), (2**40, 0, "u", "x")]
    return rows


@pytest.mark.parametrize("block, longest", [(1, 0), (5, 8)])
def test_trie(spark, block, longest):
    rows = conversations(block)
    assert found(conversation_trie(table(spark, rows), block, longest)) == expected(rows, block, longest)


def test_one_conversation_with_most_rows(spark):
    """Its rows lie in many range partitions; its copy shares every node."""
    rows = [(c, t, "user", str(t % 5)) for c in (1, 2) for t in range(24)] + [(7, t, "user", str(t * t % 11)) for t in range(250)]
    assert found(conversation_trie(table(spark, rows))) == expected(rows, 1, 0)


def test_names_and_empty_tables(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi")]
    renamed = table(spark, rows).selectExpr("conv_id as `my conv`", "turn as t", "role as r", "text as x", "1 as conv_id")
    got = conversation_trie(renamed, conv_col="my conv", turn_col="t", role_col="r", text_col="x")
    assert found(got) == expected(rows, 1, 0)
    for block in (1, 5):
        assert conversation_trie(table(spark, rows).limit(0), block, 8).count() == 0
        assert conversation_trie(table(spark, [(None, 1, "u", "x")]), block, 8).count() == 0


def test_running_digests_carry_over_partitions():
    rng = np.random.default_rng(1)
    conv = np.sort(rng.integers(0, 6, 500))
    lanes = [rng.integers(0, 2**63, 500).astype(np.uint64) for _ in range(2)]
    place, without, through = Running().add(conv, lanes)
    cuts = [0, 3, 3, 90, 91, 300, 500]
    parts, lines = list(zip(cuts[:-1], cuts[1:])), []
    for pid, (i, j) in enumerate(parts):
        if i < j:
            r = Running()
            r.add(conv[i:j], [x[i:j] for x in lanes])
            lines.append({"pid": pid, "first": int(conv[i]), "last": r.conv, "count": r.count, "a": r.sums[0], "b": r.sums[1]})
    for pid, carry in _carries(lines).items():
        i, j = parts[pid]
        got = Running(*carry).add(conv[i:j], [x[i:j] for x in lanes])
        assert (got[0] == place[i:j]).all()
        assert all((g == w[i:j]).all() for got_lanes, want in ((got[1], without), (got[2], through)) for g, w in zip(got_lanes, want))


def test_lists_over_many_partitions(spark):
    lists = {(1, 5, 5): range(0, 9000), (1, 5, 6): range(3), (2, -1, 7): [4], (2, 0, 0): range(10**6, 10**6 + 700)}
    rows = [(*k, c) for k, ids in lists.items() for c in ids]
    got = list_digests(spark.createDataFrame(rows, "depth long, a long, b long, conv long").repartition(7))
    assert sorted(map(tuple, got.collect())) == sorted(
        (*k, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()) for k, ids in lists.items())
