"""One job over the rows, one small vector of sums back.

Both forms combine on the map side, so what crosses the network is one vector
per task, never a row.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest number of literal terms put into generated code; beyond it the
# state is broadcast and the rows go through Arrow batches.
MAX_LITERAL_TERMS = 200
# Numbers of one line of partial sums.
CHUNK = 1024


def sum_exprs(df: DataFrame, exprs: Sequence[Column]) -> np.ndarray:
    """Sums of many expressions in one aggregation, as a NumPy vector."""
    row = df.agg(*[F.sum(e).alias(f"s{k}") for k, e in enumerate(exprs)]).first()
    return np.array([0.0 if v is None else v for v in row], dtype=float)


def as_numpy(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrow column to NumPy: 1-d for scalars, 2-d for equal-length arrays."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_list(col.type) or pa.types.is_large_list(col.type):
        flat = col.flatten().to_numpy(zero_copy_only=False)
        width = pc.min_max(pc.list_value_length(col))
        if width["min"].as_py() != width["max"].as_py():
            raise ValueError(f"arrays of {width['min']} to {width['max']} elements in one column")
        return flat.reshape(len(col), -1)
    return col.to_numpy(zero_copy_only=False)


def partition_sums(df: DataFrame, kernel: Callable, size: int, state=None) -> np.ndarray:
    """``kernel(columns, state) -> vector[size]`` on every Arrow batch, added up
    over each partition in NumPy.  The sums of the partitions cross the network as arrays
    of CHUNK numbers and meet by their place, so the driver receives ``size`` numbers in all.

    ``state`` is model-sized and is shipped as a broadcast variable.  It is
    pickled by value first: a plain broadcast would look up the state's
    classes in a copy of this package that executors need not have.
    """
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast(cloudpickle.dumps(state))

    def run(batches: Iterable[pa.RecordBatch]):
        total = np.zeros(size)
        current = pickle.loads(shared.value)
        for batch in batches:
            if batch.num_rows:
                cols = {n: as_numpy(c) for n, c in zip(batch.schema.names, batch.columns)}
                total += kernel(cols, current)
        first = np.arange(0, size, CHUNK)
        ends = pa.array(np.append(first, size), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(first), pa.ListArray.from_arrays(ends, pa.array(total))], ["first", "part"])

    def add(batches: Iterable[pa.RecordBatch]):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, part in zip(batch["first"].to_pylist(), batch["part"]):
                values = part.values.to_numpy()
                held[first] = held[first] + values if first in held else values
        for first, values in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([values], pa.list_(pa.float64()))], ["first", "part"])

    kind = "first long, part array<double>"
    try:
        got = df.mapInArrow(run, kind).repartition("first").mapInArrow(add, kind).toArrow()
    finally:
        shared.unpersist()
    out = np.zeros(size)
    for first, values in zip(got["first"].to_pylist(), got["part"]):
        out[first:first + len(values)] = values.values.to_numpy()
    return out


@contextmanager
def persisted(df: DataFrame):
    """Keep the projected input for the length of an iterative fit.  Lost
    blocks are recomputed from the source, so an executor may die."""
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()
