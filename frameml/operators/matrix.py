"""Matrices as tables.

Three layouts.  ``cells``: one line (i, j, v) per element, a missing cell is 0.
``rows``: one line (i, x) per matrix row with x a dense array, a missing row is
zeros; it keeps a row together, so element-wise work joins once per row instead of
once per cell and a product with a small right-hand side needs no shuffle at all.
``columns``: the same lines read as columns, which makes the transpose of ``rows``
a change of name and A'B a sum of X'Z over batches of joined rows.

``dense`` says that no cell or row is missing; work that must see zeros completes
the others against ``spark.range``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.operators.scoring import batch_map
from frameml.plans.features import Features
from frameml.plans.lineage import collect_small
from frameml.plans.randomness import normal
from frameml.plans.reduce import as_numpy

# A right-hand side is broadcast only when its full size is at most this.
BROADCAST_CELLS = 1_000_000


@dataclass(frozen=True)
class MatrixTable:
    """A ``rows`` x ``cols`` matrix held in ``df``; (i, j) is unique."""

    df: DataFrame
    rows: int
    cols: int
    layout: str = "cells"
    dense: bool = False

    def cells(self) -> DataFrame:
        if self.layout == "cells":
            return self.df
        line, place = ("i", "j") if self.layout == "rows" else ("j", "i")
        return self.df.select(F.col("i").alias(line), F.posexplode("x").alias(place, "v")).select(
            F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "v")

    @property
    def shape(self) -> tuple[int, int]:
        return self.rows, self.cols


def from_cells(df: DataFrame, rows: int, cols: int) -> MatrixTable:
    return MatrixTable(df.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"),
                                 F.col("v").cast("double").alias("v")), rows, cols)


def from_rows(df: DataFrame, id, features, rows: int | None = None, cols: int | None = None,
              dense: bool = False) -> MatrixTable:
    """Row table with a zero-based unique integer ``id`` and an array column
    (or a list of scalar columns).  Without a shape the rows are counted, which
    also tells whether any is missing."""
    arr = F.col(features) if isinstance(features, str) else F.array(*features)
    table = df.select(F.col(id).cast("long").alias("i"), arr.cast("array<double>").alias("x"))
    if rows is None or cols is None:
        seen = table.agg(F.max("i"), F.max(F.size("x")), F.count("x")).first()
        if seen[0] is None:
            raise ValueError("empty input")
        rows, cols = rows or seen[0] + 1, cols or seen[1]
        dense = seen[2] == rows
    return MatrixTable(table, int(rows), int(cols), "rows", dense)


def matrix_cells(df: DataFrame, id, features) -> DataFrame:
    """Rows to cells (i, j, v)."""
    return from_rows(df, id, features, 1, 1).cells()


def matrix_rows(m: MatrixTable) -> MatrixTable:
    """Every row as an array, also those without any cell.  A row's array gathers at most ``cols`` cells."""
    if m.layout == "rows":
        return complete_rows(m)
    cols = m.cols

    def fill(batches):
        for batch in batches:
            # Dense rows of a bounded size at a time.
            step = max(1, BROADCAST_CELLS // max(cols, 1))
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                x = np.zeros((part.num_rows, cols))
                held = pc.fill_null(pc.list_value_length(part["j"]), 0).to_numpy(zero_copy_only=False)
                x[np.repeat(np.arange(part.num_rows), held), as_flat(part["j"])] = as_flat(part["v"])
                ends = pa.array(np.arange(0, x.size + 1, cols), pa.int32())
                yield pa.RecordBatch.from_arrays([part["i"], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["i", "x"])

    gathered = m.cells().groupBy("i").agg(F.collect_list(F.struct("j", "v")).alias("c")).select("i", "c.j", "c.v")
    if not m.dense:
        gathered = _ids(m).join(gathered, "i", "left")
    return MatrixTable(gathered.mapInArrow(fill, "i long, x array<double>"), m.rows, m.cols, "rows", True)


def complete_rows(m: MatrixTable) -> MatrixTable:
    """Row layout with missing rows written out as zeros."""
    if m.dense:
        return m
    full = _ids(m).join(m.df, "i", "left").select("i", F.coalesce("x", F.array_repeat(F.lit(0.0), m.cols)).alias("x"))
    return MatrixTable(full, m.rows, m.cols, "rows", True)


def _ids(m: MatrixTable) -> DataFrame:
    return m.df.sparkSession.range(m.rows).withColumnRenamed("id", "i")


def element(m: MatrixTable, i: int, j: int) -> DataFrame:
    """The single cell (i, j)."""
    _in_range(i, m.rows, "row")
    _in_range(j, m.cols, "column")
    return m.cells().filter((F.col("i") == i) & (F.col("j") == j))


def random_matrix(spark: SparkSession, rows: int, cols: int, seed: int = 0) -> MatrixTable:
    """Standard normal cells; a value depends only on (i, j, seed)."""
    grid = _grid(spark, rows, cols)
    return MatrixTable(grid.withColumn("v", normal("i", "j", seed=seed)), rows, cols, dense=True)


def identity_matrix(spark: SparkSession, n: int) -> MatrixTable:
    ids = spark.range(n)
    return MatrixTable(ids.select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1.0).alias("v")), n, n)


def zero_matrix(spark: SparkSession, rows: int, cols: int) -> MatrixTable:
    empty = spark.range(0).select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(0.0).alias("v"))
    return MatrixTable(empty, rows, cols)


def densify(m: MatrixTable) -> MatrixTable:
    """Cell layout with every zero written out."""
    if m.dense:
        return MatrixTable(m.cells(), m.rows, m.cols, dense=True)
    grid = _grid(m.df.sparkSession, m.rows, m.cols)
    full = grid.join(m.cells(), ["i", "j"], "left")
    return MatrixTable(full.select("i", "j", F.coalesce("v", F.lit(0.0)).alias("v")), m.rows, m.cols, dense=True)


def mat_transpose(m: MatrixTable) -> MatrixTable:
    """No data moves: rows become columns by name, cells swap their two numbers."""
    if m.layout == "cells":
        return MatrixTable(m.df.select(F.col("j").alias("i"), F.col("i").alias("j"), "v"), m.cols, m.rows, dense=m.dense)
    return MatrixTable(m.df, m.cols, m.rows, "columns" if m.layout == "rows" else "rows", m.dense)


def _as_columns(f, *matrices: MatrixTable) -> MatrixTable:
    """``f`` of matrices in column layout by way of their transposes."""
    return mat_transpose(f(*map(mat_transpose, matrices)))


def mat_row(m: MatrixTable, i: int) -> MatrixTable:
    """Row ``i`` as a 1 x cols matrix."""
    _in_range(i, m.rows, "row")
    if m.layout == "columns":
        return _as_columns(lambda t: mat_col(t, i), m)
    one = m.df.filter(F.col("i") == i).withColumn("i", F.lit(0).cast("long"))
    return MatrixTable(one, 1, m.cols, m.layout)


def mat_col(m: MatrixTable, j: int) -> MatrixTable:
    """Column ``j`` as a rows x 1 matrix."""
    _in_range(j, m.cols, "column")
    if m.layout == "columns":
        return _as_columns(lambda t: mat_row(t, j), m)
    zero = F.lit(0).cast("long").alias("j")
    if m.layout == "rows":
        return MatrixTable(m.df.select("i", zero, F.col("x")[j].alias("v")), m.rows, 1)
    return MatrixTable(m.df.filter(F.col("j") == j).select("i", zero, "v"), m.rows, 1)


def mat_apply(m: MatrixTable, f: Callable[[Column], Column], keeps_zero: bool | None = None) -> MatrixTable:
    """Element-wise ``f``.  Missing cells and rows are filled with zeros first when f(0) is not
    0; pass ``keeps_zero`` to skip the check."""
    if m.layout == "columns":
        return _as_columns(lambda t: mat_apply(t, f, keeps_zero), m)
    if keeps_zero is None and not m.dense:
        at_zero = m.df.sparkSession.range(1).select(f(F.lit(0.0)).cast("double")).first()[0]
        keeps_zero = at_zero == 0.0
    if m.layout == "rows":
        full = m if keeps_zero else complete_rows(m)
        return MatrixTable(full.df.select("i", F.transform("x", f).alias("x")), m.rows, m.cols, "rows", full.dense)
    full = m if keeps_zero else densify(m)
    return MatrixTable(full.df.select("i", "j", f(F.col("v")).alias("v")), m.rows, m.cols, dense=full.dense)


def mat_scale(m: MatrixTable, s: float) -> MatrixTable:
    return mat_apply(m, lambda v: v * F.lit(float(s)), keeps_zero=True)


def gather_rows(df: DataFrame, predicate: Column | None = None, ids: DataFrame | None = None,
                id: str = "id") -> DataFrame:
    """Rows by predicate (``x <= t`` and the like) or by a table of ids."""
    if (predicate is None) == (ids is None):
        raise ValueError("give either a predicate or ids")
    if predicate is not None:
        return df.filter(predicate)
    return df.join(ids, id, "left_semi")


def mat_add(a: MatrixTable, b: MatrixTable) -> MatrixTable:
    return _combine(a, b, 1.0)


def mat_sub(a: MatrixTable, b: MatrixTable) -> MatrixTable:
    return _combine(a, b, -1.0)


def hadamard(a: MatrixTable, b: MatrixTable) -> MatrixTable:
    """Element-wise product; cells absent on either side stay absent (0)."""
    return _pairwise(a, b, lambda p, q: p * q)


def mat_div(a: MatrixTable, b: MatrixTable) -> MatrixTable:
    """Element-wise a * b^-1.  A zero divisor, written or missing, gives Infinity, and NaN under a zero;
    a missing dividend over another divisor stays missing (0)."""
    _same_shape(a, b)
    if a.layout == b.layout == "columns":
        return _as_columns(mat_div, a, b)
    zero = F.lit(0.0)
    if a.layout == b.layout == "rows":
        below = complete_rows(b)
        both = below.df.withColumnRenamed("x", "z").join(a.df, "i", "left")
        x = F.zip_with(F.coalesce("x", F.array_repeat(zero, a.cols)), "z", lambda p, q: p * F.pow(q, F.lit(-1.0)))
        return MatrixTable(both.select("i", x.alias("x")), a.rows, a.cols, "rows", True)
    below = densify(b)
    both = below.df.withColumnRenamed("v", "u").join(a.cells(), ["i", "j"], "left")
    kept = both.filter(F.col("v").isNotNull() | (F.col("u") == 0))
    v = F.coalesce("v", zero) * F.pow("u", F.lit(-1.0))
    return MatrixTable(kept.select("i", "j", v.alias("v")), a.rows, a.cols, dense=a.dense)


def mat_dot(a: MatrixTable, b: MatrixTable) -> DataFrame:
    """One line ``dot``: the sum of element-wise products."""
    _same_shape(a, b)
    if a.layout == b.layout == "columns":
        return mat_dot(mat_transpose(a), mat_transpose(b))
    if a.df is b.df and a.layout == b.layout:
        v = F.col("v")
        if a.layout == "rows":
            inner = F.aggregate("x", F.lit(0.0), lambda acc, u: acc + u * u)
            return a.df.agg(F.coalesce(F.sum(inner), F.lit(0.0)).alias("dot"))
        return a.df.agg(F.coalesce(F.sum(v * v), F.lit(0.0)).alias("dot"))
    if a.layout == b.layout == "rows":
        both = a.df.join(b.df.withColumnRenamed("x", "z"), "i")
        terms = F.zip_with("x", "z", lambda p, q: p * q)
        inner = F.aggregate(terms, F.lit(0.0), lambda acc, u: acc + u)
        return both.agg(F.coalesce(F.sum(inner), F.lit(0.0)).alias("dot"))
    return hadamard(a, b).cells().agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("dot"))


def matmul(a: MatrixTable, b: MatrixTable, method: str = "auto", block: int = 256) -> MatrixTable:
    """Product a b.

    ``broadcast``: b has at most 1e6 cells and is collected once, counted on
    the way; a in row layout is multiplied in one map pass, a in cell layout
    joins the broadcast and adds up partially.
    ``rows``: A'B with A and B in row layout: rows meet once, each Arrow batch
    adds X'Z to an array of its task; the product has at most 1e6 cells.
    ``cells``: equi-join on the inner index.  ``blocks``: cells are packed
    into block x block arrays joined on the inner block, for two large
    operands.  ``auto`` takes rows where it applies, broadcast when b is small,
    else blocks.
    """
    if a.cols != b.rows:
        raise ValueError(f"cannot multiply {a.shape} by {b.shape}")
    if method == "auto":
        across = a.layout == "columns" and b.layout == "rows" and a.rows * b.cols <= BROADCAST_CELLS
        method = "rows" if across else "broadcast" if b.rows * b.cols <= BROADCAST_CELLS else "blocks"
    if method == "rows":
        return _across_product(a, b)
    if method == "broadcast":
        if b.rows * b.cols > BROADCAST_CELLS:
            raise ValueError(f"right-hand side {b.shape} is too large to broadcast")
        got = collect_small(b.cells(), b.rows * b.cols)
        if a.layout == "rows":
            return _map_product(a, b, got)
        local = a.df.sparkSession.createDataFrame(got)
        return _cell_product(a, b, F.broadcast(local))
    if method == "cells":
        return _cell_product(a, b, b.cells())
    if method == "blocks":
        return _block_product(a, b, block)
    raise ValueError(f"unknown method {method!r}")


def _grid(spark: SparkSession, rows: int, cols: int) -> DataFrame:
    ids = spark.range(rows * cols)
    wide = F.lit(cols).cast("long")
    return ids.select(F.expr(f"id div {max(cols, 1)}").alias("i"), (F.col("id") % wide).alias("j"))


def _in_range(k: int, size: int, what: str) -> None:
    if not 0 <= k < size:
        raise IndexError(f"{what} {k} out of range for size {size}")


def _same_shape(a: MatrixTable, b: MatrixTable) -> None:
    if a.shape != b.shape:
        raise ValueError(f"shapes {a.shape} and {b.shape} differ")


def _combine(a: MatrixTable, b: MatrixTable, sign: float) -> MatrixTable:
    _same_shape(a, b)
    if a.layout == b.layout == "columns":
        return _as_columns(lambda p, q: _combine(p, q, sign), a, b)
    s = F.lit(sign)
    if a.layout == b.layout == "rows":
        both = a.df.join(b.df.withColumnRenamed("x", "z"), "i", "full")
        zeros = F.array_repeat(F.lit(0.0), a.cols)
        x = F.zip_with(F.coalesce("x", zeros), F.coalesce("z", zeros), lambda p, q: p + s * q)
        return MatrixTable(both.select("i", x.alias("x")), a.rows, a.cols, "rows", a.dense or b.dense)
    stacked = a.cells().unionAll(b.cells().select("i", "j", (s * F.col("v")).alias("v")))
    return MatrixTable(stacked.groupBy("i", "j").agg(F.sum("v").alias("v")), a.rows, a.cols)


def _pairwise(a: MatrixTable, b: MatrixTable, f) -> MatrixTable:
    _same_shape(a, b)
    if a.layout == b.layout == "columns":
        return _as_columns(lambda p, q: _pairwise(p, q, f), a, b)
    if a.layout == b.layout == "rows":
        both = a.df.join(b.df.withColumnRenamed("x", "z"), "i")
        return MatrixTable(both.select("i", F.zip_with("x", "z", f).alias("x")), a.rows, a.cols, "rows")
    right = b.cells().withColumnRenamed("v", "u")
    both = a.cells().join(right, ["i", "j"])
    return MatrixTable(both.select("i", "j", f(F.col("v"), F.col("u")).alias("v")), a.rows, a.cols)


def as_flat(col: pa.Array) -> np.ndarray:
    """The elements of a list column in one array."""
    return col.flatten().to_numpy(zero_copy_only=False)


def _wide_rows(col: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; raises when a list has another length."""
    if not pc.all(pc.equal(pc.list_value_length(col), width), min_count=0).as_py():
        raise ValueError(f"a row does not have {width} elements")
    return as_flat(col).reshape(-1, width)


def _across_product(a: MatrixTable, b: MatrixTable) -> MatrixTable:
    """A'B: rows of A and B that share a number, X'Z for each batch, one array for each task."""
    if a.layout != "columns" or b.layout != "rows" or a.rows * b.cols > BROADCAST_CELLS:
        raise ValueError("rows need a transposed row layout, a row layout and a small product")
    p, q = a.rows, b.cols
    both = a.df.select("x") if a.df is b.df else a.df.join(b.df.withColumnRenamed("x", "z"), "i").select("x", "z")

    def multiply(batches):
        total = np.zeros((p, q))
        for batch in batches:
            if batch.num_rows:
                x = _wide_rows(batch["x"], p)
                total += x.T @ (x if batch.num_columns == 1 else _wide_rows(batch["z"], q))
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(total[i, j])], ["i", "j", "v"])

    parts = both.mapInArrow(multiply, "i long, j long, v double")
    return MatrixTable(parts.groupBy("i", "j").agg(F.sum("v").alias("v")), p, q)


def _cell_product(a: MatrixTable, b: MatrixTable, b_cells: DataFrame) -> MatrixTable:
    left = a.cells().select("i", F.col("j").alias("k"), F.col("v").alias("p"))
    right = b_cells.select(F.col("i").alias("k"), "j", F.col("v").alias("q"))
    out = left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("p") * F.col("q")).alias("v"))
    return MatrixTable(out, a.rows, b.cols)


def _map_product(a: MatrixTable, b: MatrixTable, got) -> MatrixTable:
    w = np.zeros(b.shape)
    w[got["i"].to_numpy(), got["j"].to_numpy()] = got["v"].to_numpy()
    shared = a.df.sparkSession.sparkContext.broadcast(w)
    x = batch_map(Features(a.cols, "x", ()), lambda z, s: z @ s.value, shared)
    return MatrixTable(a.df.select("i", x.alias("x")), a.rows, b.cols, "rows")


def _blocks(m: MatrixTable, block: int, row_key: str, col_key: str, tag: str) -> DataFrame:
    """One line per non-empty block, gathering at most block^2 cells."""
    cells = m.cells()
    keyed = cells.select(F.expr(f"i div {block}").alias(row_key), F.expr(f"j div {block}").alias(col_key),
                         ((F.col("i") % block) * block + F.col("j") % block).cast("int").alias("at"), "v")
    return keyed.groupBy(row_key, col_key).agg(
        F.collect_list(F.struct("at", "v")).alias("cells")).select(
        row_key, col_key, F.col("cells.at").alias(f"{tag}_at"), F.col("cells.v").alias(f"{tag}_v"))


def _block_product(a: MatrixTable, b: MatrixTable, block: int) -> MatrixTable:
    """Blocks meet on the inner index and on a salt taken from the outer index
    of the taller side, so one inner block (or few) still spreads over many
    tasks; the other side is repeated once per salt."""
    spark = a.df.sparkSession
    inner = -(-a.cols // block)
    tall_a, tall_b = -(-a.rows // block), -(-b.cols // block)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    salts = max(1, min(-(-tasks // inner), max(tall_a, tall_b)))
    left = _blocks(a, block, "bi", "bk", "a")
    right = _blocks(b, block, "bk", "bj", "b")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    if tall_a >= tall_b:
        left = left.withColumn("salt", (F.col("bi") % salts).cast("int"))
        right = right.select("*", every)
    else:
        right = right.withColumn("salt", (F.col("bj") % salts).cast("int"))
        left = left.select("*", every)
    pairs = left.join(right, ["bk", "salt"]).select("bi", "bj", "a_at", "a_v", "b_at", "b_v")
    keep = max(1, 16_000_000 // (block * block * 8))

    def multiply(batches):
        # Sums of the same output block within a task; a bounded number is
        # held at once.
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            bi, bj = batch["bi"].to_pylist(), batch["bj"].to_pylist()
            for r in range(batch.num_rows):
                p, q = np.zeros(block * block), np.zeros(block * block)
                p[as_numpy(batch["a_at"][r].values)] = as_numpy(batch["a_v"][r].values)
                q[as_numpy(batch["b_at"][r].values)] = as_numpy(batch["b_v"][r].values)
                product = p.reshape(block, block) @ q.reshape(block, block)
                key = (bi[r], bj[r])
                if key in held:
                    held[key] += product
                else:
                    if len(held) >= keep:
                        yield from (_emit(k, v, block) for k, v in held.items())
                        held = {}
                    held[key] = product
        yield from (_emit(k, v, block) for k, v in held.items())

    parts = pairs.mapInArrow(multiply, "i long, j long, v double")
    out = parts.groupBy("i", "j").agg(F.sum("v").alias("v"))
    return MatrixTable(out, a.rows, b.cols)


def _emit(key, product, block):
    li, lj = np.nonzero(product)
    return pa.RecordBatch.from_arrays(
        [pa.array(li + key[0] * block, pa.int64()), pa.array(lj + key[1] * block, pa.int64()),
         pa.array(product[li, lj], pa.float64())], ["i", "j", "v"])
