"""Embedding near-duplicates by a subspace pigeonhole join.

Two unit vectors with cosine >= t have a squared distance of at most 2 - 2t.
After one fixed orthogonal rotation the coordinates are cut into blocks of few
dimensions, and the distance budget is shared out in proportion to their
widths: a similar pair keeps within the budget of at least one block.  Each
block is range-joined on a grid over its leading coordinates.  A vector is at
home in one cell and a guest in those neighbour cells of higher number that its
budget ball reaches, so a pair meets once a block; the first block in budget
owns the pair and verifies the cosine of the original vectors in double
precision.  No list of pairs leaves a cell: it returns counts and a spanning
forest.  Crowded cells are cut into tiles of bounded size.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.llm.components import connected_components
from frameml.plans.lineage import cut_lineage, join_summary
from frameml.sources.tables import read_table

# Vectors on one side of a tile.
TILE = 1024
# Side of a grid cell in radii of the block's budget ball.
CELL_RADII = 3.5
SLACK = 1e-9


def rotation(d: int) -> np.ndarray:
    """The fixed orthogonal matrix for d dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(97).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def block_starts(d: int, width: int) -> list[int]:
    return list(range(0, d, width))


def _budgets(d: int, width: int, threshold: float) -> np.ndarray:
    starts = block_starts(d, width)
    return (2 - 2 * threshold) * np.diff([*starts, d]) / d + SLACK


def _vectors(column) -> np.ndarray:
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit_rotated(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))) @ turn


def _place(width: int, grid: int, threshold: float):
    """Homes and guest places of every vector: adds (cell, home) to its row."""
    def run(batches):
        import pyarrow as pa

        turns = {}
        for batch in batches:
            sizes = batch.column("d").to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == d)))
                turn = turns.setdefault(d, rotation(d))
                y = _unit_rotated(_vectors(part.column("vec")), turn)
                rows, cells, homes = [], [], []
                for b, (start, budget) in enumerate(zip(block_starts(d, width), _budgets(d, width, threshold))):
                    z = y[:, start:start + min(grid, width)]
                    side = CELL_RADII * np.sqrt(budget)
                    cell = np.floor(z / side).astype(np.int32)
                    low, high = (z - cell * side) ** 2, ((cell + 1) * side - z) ** 2
                    for step in itertools.product((-1, 0, 1), repeat=z.shape[1]):
                        if step < (0,) * z.shape[1]:
                            continue
                        gap = sum((high if s > 0 else low)[:, k] for k, s in enumerate(step) if s)
                        hit = np.flatnonzero(np.broadcast_to(gap <= budget, len(z)))
                        rows.append(hit)
                        homes.append(np.full(len(hit), not any(step)))
                        head = np.full((len(hit), 1), b, np.int32)
                        cells += [c.tobytes() for c in np.hstack([head, cell[hit] + np.array(step, np.int32)])]
                rows = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.take(pa.array(rows)).columns, pa.array(cells, pa.binary()), pa.array(np.concatenate(homes))],
                    names=[*part.schema.names, "cell", "home"])

    return run


def _tile(width: int, threshold: float):
    """Links inside one tile: (id, links, root) for every vector that has one."""
    turns = {}

    def run(key, table):
        import pyarrow as pa

        d, block = key[1].as_py(), int(np.frombuffer(key[2].as_py(), np.int32)[0])
        same = key[3].as_py() == key[4].as_py()
        if d not in turns:
            turns[d] = rotation(d)
        starts, budgets = block_starts(d, width), _budgets(d, width, threshold)
        left = table.column("left").to_numpy(zero_copy_only=False)
        order = np.argsort(~left, kind="stable")
        n, total = int(left.sum()), len(left)
        ids = table.column("id").to_numpy()[order]
        weight = table.column("weight").to_numpy()[order]
        x = _vectors(table.column("vec"))[order]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
        y = _unit_rotated(x, turns[d])
        z = y[:, starts[block]:starts[block] + width]
        square = (z * z).sum(axis=1)
        from_, links, one, two = 0 if same else n, np.zeros(total, np.int64), [], []
        for i in range(0, n, 512):
            upto = min(i + 512, n)
            near = square[i:upto, None] + square[None, from_:] - 2 * z[i:upto] @ z[from_:].T <= budgets[block] + 1e-7
            p, q = np.nonzero(near)
            p, q = p + i, q + from_
            p, q = p[q > p], q[q > p]
            for s in range(0, len(p), 50_000):
                a, b = p[s:s + 50_000], q[s:s + 50_000]
                spent = np.add.reduceat((y[a] - y[b]) ** 2, starts, axis=1) <= budgets
                good = spent[:, block] & ~spent[:, :block].any(axis=1)
                good &= np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= threshold
                a, b = a[good], b[good]
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                one.append(a)
                two.append(b)
        root = np.arange(total)
        if one:
            a, b = np.concatenate(one), np.concatenate(two)
            while True:
                before = root.copy()
                np.minimum.at(root, a, root[b])
                np.minimum.at(root, b, root[a])
                root = root[root]
                if (root == before).all():
                    break
        some = links > 0
        return pa.table({"id": pa.array(ids[some]), "links": pa.array(links[some]), "root": pa.array(ids[root][some])})

    return run


def near_duplicate_vectors(df: DataFrame, threshold: float = 0.98, block_width: int = 8, tile: int = TILE,
                           id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: (vec_id, n_links, component_id, kept).

    Vectors are compared only with vectors of the same non-null label and the
    same length; a link is a cosine >= threshold.  Null, empty and zero vectors
    and those with a null or non-finite element link with nothing, nor do rows
    without id or label.  Repeated rows are separate vectors that link.  A row
    without id has a null component and is not kept.  Other columns are ignored;
    an empty table gives an empty result.
    """
    vec = F.col("vec")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vec_col_of(vec_col), F.col(label_col).alias("label"))
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull() & ~bad
            & F.exists(vec, lambda v: v != 0))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    valid = rows.where("fine").select("vec_id", "vec", "label")
    # Equal vectors of a label are one node with a weight.
    nodes = cut_lineage(valid.groupBy("label", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
                        .withColumn("d", F.size("vec")))
    most = nodes.groupBy("label", "d").count().agg(F.max("count")).first()[0] or 1
    # More rows are cut by more coordinates; this changes the plan, not the links.
    grid = int(np.clip(np.ceil(np.log(max(most / 1000, 1)) / np.log(2.5)), 1, block_width))
    schema = nodes.select("label", "vec", "id", "weight", "d").schema.add("cell", "binary").add("home", "boolean")
    placed = nodes.select("label", "vec", "id", "weight", "d").mapInArrow(_place(block_width, grid, threshold), schema)
    cell = ["label", "d", "cell"]
    crowded = cut_lineage(placed.groupBy(*cell).agg(F.count_if("home").alias("h"), F.count_if(~F.col("home")).alias("g"))
                          .where((F.col("h") > tile) | (F.col("g") > tile))
                          .select(*cell, F.ceil(F.col("h") / tile).alias("h"), F.ceil(F.col("g") / tile).alias("g")))
    spread = join_summary(placed, crowded, cell, "left")
    part = F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.greatest("h", F.lit(1))).otherwise(F.greatest("g", F.lit(1))))
    spread = spread.withColumn("part", part)
    upto = F.sequence(F.lit(0).cast("long"), F.col("h") - 1)
    own = F.transform(upto, lambda k: F.struct(F.least("part", k).alias("i"), F.greatest("part", k).alias("j"),
                                               (F.col("part") <= k).alias("left")))
    guests = F.when(F.col("g") > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("g") - 1),
        lambda k: F.struct(F.col("part").alias("i"), (F.col("h") + k).alias("j"), F.lit(True).alias("left")))
    ).otherwise(F.array().cast("array<struct<i:bigint,j:bigint,left:boolean>>"))
    visits = F.when(F.col("h") > 0, F.transform(
        upto, lambda k: F.struct(k.alias("i"), (F.col("h") + F.col("part")).alias("j"), F.lit(False).alias("left")))
    ).otherwise(F.array().cast("array<struct<i:bigint,j:bigint,left:boolean>>"))
    one = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), F.col("home").alias("left")))
    places = F.when(F.col("h").isNull(), one).when(F.col("home"), F.concat(own, guests)).otherwise(visits)
    found = cut_lineage(spread.select(*cell, "id", "weight", "vec", F.explode(places).alias("t"))
                        .select(*cell, "t.i", "t.j", "t.left", "id", "weight", "vec")
                        .groupBy(*cell, "i", "j").applyInArrow(_tile(block_width, threshold),
                                                               "id long, links long, root long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    nodes = cut_lineage(nodes.select("label", "vec", "id", "weight").join(links, "id", "left")
                        .join(parts.withColumnRenamed("node", "id"), "id", "left")
                        .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                                F.coalesce("component", "id").alias("component_id")))
    out = valid.join(nodes, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    out = out.union(rows.where(~F.col("fine")).select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def vec_col_of(name: str):
    return F.col(name).alias("vec")


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


ORACLE = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), link as (
  select a.vec_id as a, b.vec_id as b from v a join v b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98
), reach as (
  select vec_id as id, vec_id as r from embeddings union select reach.id, link.b from reach join link on reach.r = link.a
), comp as (select id, min(r) as component_id from reach group by id
), n as (select a, count(*) as n from link group by a)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join comp c on c.id = e.vec_id left join n on n.a = e.vec_id
"""

QUERIES = {"op1_embedding_neardup": op1_embedding_neardup}
SQL = {"op1_embedding_neardup": ORACLE}
