"""Running sums over range-partitioned rows.

A window function puts a whole group into one task.  Here the rows are sorted
once over all tasks; each partition sums its own part, and what the partitions
before it hold of its first group is added.  A group may span any number of
partitions, so a group with a third of the rows is no single task's work.  The
driver sees one line per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from frameml.plans.lineage import cut_lineage


def _starts(batch: pa.RecordBatch, group: list[str], before: tuple | None) -> np.ndarray:
    """True where a row's group differs from that of the row before it."""
    new = np.zeros(batch.num_rows, bool)
    for name in group:
        codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    new[0] = _key(batch, group, 0) != before
    return new


def _key(batch: pa.RecordBatch, group: list[str], row: int) -> tuple:
    return tuple(batch.column(name)[row].as_py() for name in group)


class _Sums:
    """Running sums of sorted batches, from the state that the partitions before leave."""

    def __init__(self, group: list[str], sums: list[str], key: tuple | None = None, state: list[float] | None = None) -> None:
        self.group, self.sums, self.key, self.state = group, sums, key, state or [0.0] * len(sums)

    def add(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        new = _starts(batch, self.group, self.key)
        first = np.flatnonzero(new)
        # Rows that go on with the group before take its state; a later group starts at nothing.
        run = np.cumsum(new) - 1
        out = []
        for k, name in enumerate(self.sums):
            total = np.cumsum(batch.column(name).to_numpy(zero_copy_only=False).astype(float))
            base = np.concatenate(([0.0], total))[first] if len(first) else np.zeros(1)
            out.append(np.where(run < 0, total + self.state[k], total - base[np.maximum(run, 0)]))
        self.key, self.state = _key(batch, self.group, batch.num_rows - 1), [float(x[-1]) for x in out]
        return out


def _tails(group: list[str], sums: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, first = _Sums(group, sums), None
        types = None
        for batch in batches:
            if batch.num_rows:
                types = [batch.schema.field(g).type for g in group]
                first = _key(batch, group, 0) if first is None else first
                state.add(batch)
        if first is not None:
            last = [pa.array([v], t) for v, t in zip(state.key, types)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([first == state.key]), *last,
                 *(pa.array([s]) for s in state.state)], names=["pid", "single", *(f"g{i}" for i in range(len(group))),
                                                               *(f"s{i}" for i in range(len(sums)))])

    return run


def running_sums(df: DataFrame, group: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """Add ``run_<c>`` (double) for every c of ``sums``: its sum over the rows of the same group up to
    and with this one, in rising ``order``.  ``group`` and ``order`` together tell rows apart; null keys
    are values of their own and come first, a null to be summed is not allowed."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    rows = cut_lineage(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys))
    fields = [StructField("pid", LongType()), *(StructField(f"g{i}", rows.schema[g].dataType) for i, g in enumerate(group)),
              *(StructField(f"s{i}", DoubleType()) for i in range(len(sums)))]
    schema = "pid long, single boolean, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields[1:])
    carry, key, state = {}, None, None
    for line in sorted(rows.mapInArrow(_tails(group, sums), schema).collect(), key=lambda r: r["pid"]):
        carry[line["pid"]] = (key, state)
        last = tuple(line[f"g{i}"] for i in range(len(group)))
        own = [line[f"s{i}"] for i in range(len(sums))]
        # A partition inside one group adds to what came before.
        state = [a + b for a, b in zip(state, own)] if line["single"] and last == key else own
        key = last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = _Sums(group, sums, *carry.get(TaskContext.get().partitionId(), ()))
        for batch in batches:
            if batch.num_rows:
                added = running.add(batch)
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, added)],
                                                 names=[*batch.schema.names, *(f"run_{c}" for c in sums)])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *(StructField(f"run_{c}", DoubleType()) for c in sums)]))
