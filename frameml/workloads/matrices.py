"""Queries over the embeddings as a matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from frameml.functions.activations import activation, activation_grad, dropout, softmax, softmax_grad
from frameml.functions.vectors import soft_threshold, squared_distance
from frameml.operators import matrix as M
from frameml.operators.scoring import dense_layer
from frameml.workloads.common import (CELLS, embedding_matrix, embeddings, reversed_matrix, rounded)
from frameml.sources.tables import read_table

# Weights of the dense-layer query, by rule: ((7 i + 3 k) % 11 - 5) / 50.
DENSE_OUTPUTS = 4


def rule_weight(i: int, k: int) -> float:
    return ((7 * i + 3 * k) % 11 - 5) / 50


def _out(m, digits: int = 6):
    return m.cells().select("i", "j", rounded("v", digits).alias("v"))


def matrix_cells(spark, folder):
    return M.matrix_cells(embeddings(spark, folder), "vec_id", "embedding")


def matrix_rows(spark, folder):
    a = embedding_matrix(spark, folder)
    cells = M.from_cells(a.cells(), a.rows, a.cols)
    total = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v)
    return M.matrix_rows(cells).df.select("i", F.size("x").alias("width"), rounded(total).alias("total"),
                                          F.element_at("x", -1).alias("last"))


def matrix_element(spark, folder):
    return M.element(embedding_matrix(spark, folder), 3, 5)


def random_matrix(spark, folder):
    """Share, mean and spread of as many normal cells as the embeddings have."""
    a = embedding_matrix(spark, folder)
    cells = M.random_matrix(spark, a.rows, a.cols, seed=7).df
    inside = F.avg((F.abs("v") < 1).cast("double"))
    return cells.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("v").alias("different"),
                     rounded(F.avg("v"), 1).alias("mean"), rounded(F.stddev_pop("v"), 1).alias("spread"),
                     rounded(inside, 1).alias("within_one"))


def identity_matrix(spark, folder):
    a = embedding_matrix(spark, folder)
    return _out(M.matmul(a, M.identity_matrix(spark, a.cols)))


def zero_matrix(spark, folder):
    a = embedding_matrix(spark, folder)
    return _out(M.mat_add(a, M.zero_matrix(spark, a.rows, a.cols)))


def mat_transpose(spark, folder):
    return M.mat_transpose(embedding_matrix(spark, folder)).cells()


def mat_row(spark, folder):
    return M.mat_row(embedding_matrix(spark, folder), 7).cells()


def mat_col(spark, folder):
    return M.mat_col(embedding_matrix(spark, folder), 5).df


def mat_apply(spark, folder):
    a = embedding_matrix(spark, folder)
    positive = M.MatrixTable(a.cells().filter("v > 0"), a.rows, a.cols)
    return _out(M.mat_apply(positive, lambda v: F.exp(v) * 2))


def mat_scale(spark, folder):
    return _out(M.mat_scale(embedding_matrix(spark, folder), -2.5))


def gather_rows(spark, folder):
    left = M.gather_rows(embeddings(spark, folder), predicate=F.col("embedding")[0] <= 0.02)
    return left.select("vec_id", "label", rounded(F.col("embedding")[0].cast("double")).alias("x0"))


def gather_rows_by_id(spark, folder):
    ids = read_table(spark, folder, "labels").filter("quality = 1").select(F.col("doc_id").alias("vec_id"))
    return M.gather_rows(embeddings(spark, folder), ids=ids, id="vec_id").select("vec_id", "label")


def soft_threshold_query(spark, folder):
    cells = embedding_matrix(spark, folder).cells()
    return cells.select("i", "j", rounded(soft_threshold(F.col("v"), 0.05)).alias("v"))


def squared_distance_query(spark, folder):
    x = F.col("embedding").cast("array<double>")
    return embeddings(spark, folder).select("vec_id", rounded(squared_distance(x, F.reverse(x))).alias("d2"))


def activation_query(spark, folder):
    v = F.col("v")
    cells = embedding_matrix(spark, folder).cells()
    kinds = {"relu": v, "tanh": v * 5, "sigmoid": v * 5, "exp": v, "log": v * v, "pow": v, "neg": v}
    return cells.select("i", "j", *[rounded(activation(x, k, 3.0)).alias(k) for k, x in kinds.items()])


def activation_grad_query(spark, folder):
    v = F.col("v")
    cells = embedding_matrix(spark, folder).cells()
    kinds = {"relu": v, "tanh": v * 5, "sigmoid": v * 5, "exp": v, "log": v * v + 1, "pow": v, "neg": v}
    return cells.select("i", "j", *[rounded(activation_grad(x, k, v + 2, 3.0)).alias(k) for k, x in kinds.items()])


def softmax_query(spark, folder):
    x = F.col("embedding").cast("array<double>")
    return embeddings(spark, folder).select(F.col("vec_id").alias("i"), F.posexplode(softmax(x)).alias("j", "p")).select(
        "i", F.col("j").cast("long").alias("j"), rounded("p", 9).alias("p"))


def softmax_grad_query(spark, folder):
    x = F.col("embedding").cast("array<double>")
    rows = embeddings(spark, folder).select(F.col("vec_id").alias("i"), softmax(x).alias("s"), x.alias("g"))
    return rows.select("i", F.posexplode(softmax_grad(F.col("s"), F.col("g"))).alias("j", "v")).select(
        "i", F.col("j").cast("long").alias("j"), rounded("v", 9).alias("v"))


def dropout_query(spark, folder):
    """Share of dropped units, and units that are neither 0 nor scaled."""
    cells = embedding_matrix(spark, folder).cells()
    kept = cells.withColumn("d", dropout(F.col("v"), 0.5, "i", "j", F.lit(0).cast("long"), seed=11))
    wrong = (F.col("d") != 0) & (F.abs(F.col("d") - F.col("v") * 2) > 1e-12)
    return kept.agg(F.count(F.lit(1)).alias("n"), rounded(F.avg((F.col("d") == 0).cast("double")), 1).alias("dropped"),
                    F.sum(wrong.cast("long")).alias("wrong"))


def dense_layer_query(spark, folder):
    table = embeddings(spark, folder)
    a = embedding_matrix(spark, folder)
    w = [[rule_weight(i, k) for k in range(DENSE_OUTPUTS)] for i in range(a.cols)]
    bias = [0.1 * k for k in range(DENSE_OUTPUTS)]
    out = dense_layer(table, ("embedding", a.cols), w, bias)
    return out.select("vec_id", F.posexplode("out").alias("k", "v")).select(
        "vec_id", F.col("k").cast("long").alias("k"), rounded("v").alias("v"))


def matmul(spark, folder):
    """A (A'A), both factors from the data; the 64 x 64 one is broadcast."""
    a = embedding_matrix(spark, folder)
    return _out(M.matmul(a, M.matmul(M.mat_transpose(a), a)))


def matmul_gram(spark, folder):
    """A'A: no row is copied or joined, each batch adds X'X."""
    a = embedding_matrix(spark, folder)
    return _out(M.matmul(M.mat_transpose(a), a))


def matmul_cells(spark, folder):
    a = embedding_matrix(spark, folder)
    return _out(M.matmul(M.mat_transpose(a), a, method="cells"))


def matmul_across(spark, folder):
    """A'B of two row tables that meet row by row."""
    return _out(M.matmul(M.mat_transpose(embedding_matrix(spark, folder)), reversed_matrix(spark, folder)))


def matmul_blocks(spark, folder):
    a = embedding_matrix(spark, folder)
    return _out(M.matmul(M.mat_transpose(a), a, method="blocks", block=128))


def matmul_cells_broadcast(spark, folder):
    """A in cell layout times a broadcast matrix of fixed size."""
    a = embedding_matrix(spark, folder)
    return _out(M.matmul(M.MatrixTable(a.cells(), a.rows, a.cols), M.identity_matrix(spark, a.cols)))


def mat_add(spark, folder):
    return _out(M.mat_add(embedding_matrix(spark, folder), reversed_matrix(spark, folder)))


def mat_add_cells(spark, folder):
    a, b = embedding_matrix(spark, folder), reversed_matrix(spark, folder)
    return _out(M.mat_add(M.MatrixTable(a.cells(), *a.shape), M.MatrixTable(b.cells(), *b.shape)))


def mat_sub(spark, folder):
    a, b = embedding_matrix(spark, folder), reversed_matrix(spark, folder)
    return _out(M.mat_sub(M.MatrixTable(a.cells(), *a.shape), M.MatrixTable(b.cells(), *b.shape)))


def mat_sub_rows(spark, folder):
    return _out(M.mat_sub(embedding_matrix(spark, folder), reversed_matrix(spark, folder)))


def hadamard(spark, folder):
    return _out(M.hadamard(embedding_matrix(spark, folder), reversed_matrix(spark, folder)))


def mat_div(spark, folder):
    a, b = embedding_matrix(spark, folder), reversed_matrix(spark, folder)
    shifted = M.mat_apply(b, lambda v: v + 2)
    return _out(M.mat_div(M.MatrixTable(a.cells(), *a.shape), M.MatrixTable(shifted.cells(), *b.shape)))


def _positive(m):
    """The cells above 0 only."""
    return M.MatrixTable(m.cells().filter("v > 0"), *m.shape)


def mat_div_sparse(spark, folder):
    """Missing divisors are zeros; what they give is written as text, as infinities do not round."""
    got = M.mat_div(_positive(embedding_matrix(spark, folder)), _positive(reversed_matrix(spark, folder)))
    v = F.col("v")
    kind = F.when(F.isnan(v), "nan").when(v == float("inf"), "inf").otherwise("number")
    return got.df.select("i", "j", kind.alias("kind"), F.when(kind == "number", F.round(v, 3) + 0.0).alias("v"))


def mat_apply_sparse_rows(spark, folder):
    """exp over a row table without the rows of odd labels: missing rows become ones."""
    a = embedding_matrix(spark, folder)
    even = embeddings(spark, folder).filter("label % 2 = 0")
    return _out(M.mat_apply(M.from_rows(even, "vec_id", "embedding", *a.shape), F.exp))


def matrix_rows_sparse(spark, folder):
    """Rows of the cells above 0.2, those without any included."""
    a = embedding_matrix(spark, folder)
    few = M.MatrixTable(a.cells().filter("v > 0.2"), *a.shape)
    return _out(M.matrix_rows(few))


def mat_dot(spark, folder):
    got = M.mat_dot(embedding_matrix(spark, folder), reversed_matrix(spark, folder))
    return got.select(rounded("dot").alias("dot"))


def mat_dot_self(spark, folder):
    a = embedding_matrix(spark, folder)
    return M.mat_dot(a, a).select(rounded("dot").alias("dot"))


QUERIES = {
    "matrix_cells": matrix_cells, "matrix_rows": matrix_rows, "matrix_element": matrix_element,
    "random_matrix": random_matrix, "identity_matrix": identity_matrix, "zero_matrix": zero_matrix,
    "mat_transpose": mat_transpose, "mat_row": mat_row, "mat_col": mat_col, "mat_apply": mat_apply,
    "mat_scale": mat_scale, "gather_rows": gather_rows, "gather_rows_by_id": gather_rows_by_id,
    "soft_threshold": soft_threshold_query, "squared_distance": squared_distance_query,
    "activation": activation_query, "activation_grad": activation_grad_query, "softmax": softmax_query,
    "softmax_grad": softmax_grad_query, "dropout": dropout_query, "dense_layer": dense_layer_query,
    "matmul": matmul, "matmul_gram": matmul_gram, "matmul_cells": matmul_cells, "matmul_across": matmul_across,
    "mat_div_sparse": mat_div_sparse, "mat_apply_sparse_rows": mat_apply_sparse_rows,
    "matrix_rows_sparse": matrix_rows_sparse, "matmul_blocks": matmul_blocks,
    "matmul_cells_broadcast": matmul_cells_broadcast, "mat_add": mat_add, "mat_add_cells": mat_add_cells,
    "mat_sub": mat_sub, "mat_sub_rows": mat_sub_rows, "hadamard": hadamard, "mat_div": mat_div,
    "mat_dot": mat_dot, "mat_dot_self": mat_dot_self,
}

_PAIR = (f"{CELLS}, b as (select vec_id i, unnest(range(0, len(embedding))) j, "
         "unnest(list_reverse(embedding))::double u from embeddings)")
_GRAM = "g as (select p.j i, q.j j, sum(p.v*q.v) v from a p join a q using (i) group by 1, 2)"
_SOFT = ("m as (select *, max(v) over (partition by i) mx from a), "
         "s as (select i, j, v, exp(v-mx)/sum(exp(v-mx)) over (partition by i) p from m)")

SQL = {
    "matrix_cells": f"with {CELLS} select i, j, v from a",
    "matrix_rows": f"with {CELLS} select i, count(*)::int width, round(sum(v), 6) + 0.0 total, "
                   "max_by(v, j) \"last\" from a group by i",
    "matrix_element": f"with {CELLS} select i, j, v from a where i = 3 and j = 5",
    "random_matrix": f"with {CELLS} select count(*) n, count(*) different, 0.0::double mean, 1.0::double spread, "
                     "0.7::double within_one from a",
    "identity_matrix": f"with {CELLS} select i, j, round(v, 6) + 0.0 v from a",
    "zero_matrix": f"with {CELLS} select i, j, round(v, 6) + 0.0 v from a",
    "mat_transpose": f"with {CELLS} select j i, i j, v from a",
    "mat_row": f"with {CELLS} select 0::bigint i, j, v from a where i = 7",
    "mat_col": f"with {CELLS} select i, 0::bigint j, v from a where j = 5",
    "mat_apply": f"with {CELLS} select i, j, round(exp(greatest(v, 0)) * 2, 6) + 0.0 v from a",
    "mat_scale": f"with {CELLS} select i, j, round(v * -2.5, 6) + 0.0 v from a",
    "gather_rows": "select vec_id, label, round(embedding[1]::double, 6) + 0.0 x0 from embeddings "
                   "where embedding[1]::double <= 0.02",
    "gather_rows_by_id": "select vec_id, label from embeddings where vec_id in "
                         "(select doc_id from labels where quality = 1)",
    "soft_threshold": f"with {CELLS} select i, j, round(sign(v) * greatest(abs(v) - 0.05, 0), 6) + 0.0 v from a",
    "squared_distance": f"with {_PAIR} select i vec_id, round(sum((v-u)*(v-u)), 6) + 0.0 d2 "
                        "from a join b using (i, j) group by 1",
    "activation": f"with {CELLS} select i, j, round(greatest(v, 0), 6) + 0.0 relu, round(tanh(v*5), 6) + 0.0 tanh, "
                  "round(1/(1+exp(-(v*5))), 6) + 0.0 sigmoid, round(exp(v), 6) + 0.0 \"exp\", "
                  "round(ln(v*v + 1e-8), 6) + 0.0 \"log\", round(v**3, 6) + 0.0 \"pow\", round(-v, 6) + 0.0 neg from a",
    "activation_grad": f"with {CELLS} select i, j, round(case when v > 0 then v+2 else 0 end, 6) + 0.0 relu, "
                       "round((1 - tanh(v*5)*tanh(v*5))*(v+2), 6) + 0.0 tanh, "
                       "round(1/(1+exp(-(v*5))) * (1 - 1/(1+exp(-(v*5)))) * (v+2), 6) + 0.0 sigmoid, "
                       "round(exp(v)*(v+2), 6) + 0.0 \"exp\", round((v+2)/(v*v + 1 + 1e-8), 6) + 0.0 \"log\", "
                       "round(3*v*v*(v+2), 6) + 0.0 \"pow\", round(-(v+2), 6) + 0.0 neg from a",
    "softmax": f"with {CELLS}, {_SOFT} select i, j, round(p, 9) + 0.0 p from s",
    "softmax_grad": f"with {CELLS}, {_SOFT} select i, j, round(p*(v - sum(p*v) over (partition by i)), 9) + 0.0 v from s",
    "dropout": f"with {CELLS} select count(*) n, 0.5::double dropped, 0::bigint wrong from a",
    "dense_layer": f"with {CELLS}, w as (select i.range j, k.range k, ((7*i.range + 3*k.range) % 11 - 5)/50.0::double w "
                   f"from range(0, 64) i, range(0, {DENSE_OUTPUTS}) k) "
                   "select a.i vec_id, w.k, round(sum(a.v*w.w) + 0.1*w.k, 6) + 0.0 v from a join w using (j) "
                   "group by a.i, w.k",
    "matmul": f"with {CELLS}, {_GRAM} select a.i, g.j, round(sum(a.v*g.v), 6) + 0.0 v "
              "from a join g on a.j = g.i group by 1, 2",
    "matmul_gram": f"with {CELLS}, {_GRAM} select i, j, round(v, 6) + 0.0 v from g",
    "matmul_cells": f"with {CELLS}, {_GRAM} select i, j, round(v, 6) + 0.0 v from g",
    "matmul_across": f"with {_PAIR} select a.j i, b.j, round(sum(a.v*b.u), 6) + 0.0 v from a join b using (i) group by 1, 2",
    "mat_div_sparse": f"with {_PAIR}, d as (select i, j, case when v > 0 then v else 0 end v, case when u > 0 then u else 0 end u "
                      "from a join b using (i, j)) select i, j, case when u > 0 then 'number' when v > 0 then 'inf' else 'nan' end "
                      "kind, case when u > 0 then round(v / u, 3) + 0.0 end v from d where v > 0 or u = 0",
    "mat_apply_sparse_rows": f"with {CELLS} select i, j, round(case when label % 2 = 0 then exp(v) else 1 end, 6) + 0.0 v "
                             "from a join embeddings on i = vec_id",
    "matrix_rows_sparse": f"with {CELLS} select i, j, round(case when v > 0.2 then v else 0 end, 6) + 0.0 v from a",
    "matmul_blocks": f"with {CELLS}, {_GRAM} select i, j, round(v, 6) + 0.0 v from g",
    "matmul_cells_broadcast": f"with {CELLS} select i, j, round(v, 6) + 0.0 v from a",
    "mat_add": f"with {_PAIR} select i, j, round(v + u, 6) + 0.0 v from a join b using (i, j)",
    "mat_add_cells": f"with {_PAIR} select i, j, round(v + u, 6) + 0.0 v from a join b using (i, j)",
    "mat_sub": f"with {_PAIR} select i, j, round(v - u, 6) + 0.0 v from a join b using (i, j)",
    "mat_sub_rows": f"with {_PAIR} select i, j, round(v - u, 6) + 0.0 v from a join b using (i, j)",
    "hadamard": f"with {_PAIR} select i, j, round(v * u, 6) + 0.0 v from a join b using (i, j)",
    "mat_div": f"with {_PAIR} select i, j, round(v / (u + 2), 6) + 0.0 v from a join b using (i, j)",
    "mat_dot": f"with {_PAIR} select round(sum(v*u), 6) + 0.0 dot from a join b using (i, j)",
    "mat_dot_self": f"with {CELLS} select round(sum(v*v), 6) + 0.0 dot from a",
}
