import numpy as np
import pytest
from pyspark.sql import functions as F

from frameml.operators import matrix as M


def table(spark, a, layout="cells", parts=3):
    a = np.asarray(a, dtype=float)
    if layout == "rows":
        df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(a)], "id long, x array<double>")
        return M.from_rows(df.repartition(parts), "id", "x", *a.shape)
    cells = [(i, j, float(a[i, j])) for i in range(a.shape[0]) for j in range(a.shape[1]) if a[i, j] != 0]
    return M.from_cells(spark.createDataFrame(cells, "i long, j long, v double").repartition(parts), *a.shape)


def dense(m):
    out = np.zeros(m.shape)
    for r in m.cells().collect():
        assert out[r["i"], r["j"]] == 0
        out[r["i"], r["j"]] = r["v"]
    return out


A = np.array([[1.0, 2, 3], [4, 5, 6]])
RNG = np.random.default_rng(0)
P, Q = RNG.normal(size=(37, 11)), RNG.normal(size=(11, 23))


@pytest.mark.parametrize("layout", ["cells", "rows"])
def test_dot_of_vectors(spark, layout):
    u, v = table(spark, [[1], [2], [3]], layout), table(spark, [[4], [5], [6]], layout)
    assert M.mat_dot(u, v).first()["dot"] == 32.0
    assert M.mat_dot(u, u).first()["dot"] == 14.0


@pytest.mark.parametrize("layout", ["cells", "rows"])
def test_transpose_rows_columns(spark, layout):
    m = table(spark, A, layout)
    t = M.mat_transpose(m)
    assert t.shape == (3, 2) and np.array_equal(dense(t), A.T)
    assert np.array_equal(dense(M.mat_row(m, 1)), A[1:2])
    assert np.array_equal(dense(M.mat_col(m, 2)), A[:, 2:3])
    assert M.element(m, 1, 0).first()["v"] == 4.0
    for bad in (lambda: M.mat_row(m, 2), lambda: M.mat_col(m, 3), lambda: M.mat_row(m, -1)):
        with pytest.raises(IndexError):
            bad()


@pytest.mark.parametrize("layout", ["cells", "rows"])
def test_elementwise(spark, layout):
    b = P[:, ::-1].copy()
    m, n = table(spark, P, layout), table(spark, b, layout, 5)
    assert np.allclose(dense(M.mat_add(m, n)), P + b)
    assert np.allclose(dense(M.mat_sub(m, n)), P - b)
    assert np.allclose(dense(M.hadamard(m, n)), P * b)
    assert np.allclose(dense(M.mat_div(m, n)), P / b)
    assert np.allclose(dense(M.mat_scale(m, -3)), -3 * P)
    assert np.allclose(dense(M.mat_apply(m, F.exp)), np.exp(P))
    assert np.isclose(M.mat_dot(m, n).first()["dot"], (P * b).sum())
    with pytest.raises(ValueError):
        M.mat_add(m, table(spark, A, layout))


def test_missing_cells_are_zero(spark):
    a, b = np.diag([1.0, 2, 3]), np.array([[0, 5.0, 0], [0, 0, 0], [7, 0, 1]])
    m, n = table(spark, a), table(spark, b)
    assert np.allclose(dense(M.mat_add(m, n)), a + b)
    assert np.allclose(dense(M.mat_sub(m, n)), a - b)
    assert np.allclose(dense(M.hadamard(m, n)), a * b)
    assert np.allclose(dense(M.mat_apply(m, F.cos)), np.cos(a))
    assert M.mat_apply(m, lambda v: v * v).df.count() == 3
    assert np.allclose(dense(M.matrix_rows(n)), b)


def test_division_by_zero_is_infinite(spark):
    m = M.mat_div(table(spark, [[1.0]], "rows"), table(spark, [[0.0]], "rows"))
    assert m.cells().first()["v"] == float("inf")


@pytest.mark.parametrize("method,layout", [("broadcast", "rows"), ("broadcast", "cells"), ("cells", "cells"),
                                           ("blocks", "cells"), ("blocks", "rows"), ("auto", "rows")])
def test_matmul(spark, method, layout):
    got = M.matmul(table(spark, P, layout), table(spark, Q, layout), method, block=4)
    assert got.shape == (37, 23)
    assert np.allclose(dense(got), P @ Q)


def test_matmul_blocks_with_wide_right_side(spark):
    got = M.matmul(table(spark, Q.T), table(spark, P.T), "blocks", block=5)
    assert np.allclose(dense(got), Q.T @ P.T)


def test_matmul_laws_and_shapes(spark):
    a, b = table(spark, P), table(spark, Q)
    eye = M.identity_matrix(spark, 11)
    assert np.allclose(dense(M.matmul(a, eye)), P)
    left = dense(M.mat_transpose(M.matmul(a, b, "cells")))
    right = dense(M.matmul(M.mat_transpose(b), M.mat_transpose(a), "cells"))
    assert np.allclose(left, right)
    with pytest.raises(ValueError):
        M.matmul(a, a)


def test_large_right_side_is_never_broadcast(spark):
    wide = M.zero_matrix(spark, 11, 10**6)
    with pytest.raises(ValueError):
        M.matmul(table(spark, P), wide, "broadcast")


def test_random_matrix_ignores_partitioning(spark):
    m = M.random_matrix(spark, 50, 40, seed=3)
    a = dense(m)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    b = dense(M.MatrixTable(m.df.repartition(7), 50, 40))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert np.array_equal(a, b)
    assert abs(a.mean()) < 0.1 and abs(a.std() - 1) < 0.1
    assert not np.array_equal(a, dense(M.random_matrix(spark, 50, 40, seed=4)))


def test_gather_rows(spark, make):
    df = make([[1.0], [2], [3], [4]])
    assert M.gather_rows(df, predicate=F.col("x0") <= 2).count() == 2
    ids = spark.createDataFrame([(1,), (3,), (9,)], "id long")
    assert sorted(r["id"] for r in M.gather_rows(df, ids=ids).collect()) == [1, 3]
    with pytest.raises(ValueError):
        M.gather_rows(df)


def test_transposed_rows_stay_rows(spark):
    """Every operation on the transpose of a row table equals the one on its cells."""
    a, b = RNG.normal(size=(5, 4)), RNG.normal(size=(5, 4))
    s, t = (M.mat_transpose(table(spark, m, "rows")) for m in (a, b))
    assert s.layout == "columns" and M.mat_transpose(s).df is s.df
    assert np.allclose(dense(s), a.T) and np.allclose(dense(M.mat_transpose(s)), a)
    assert np.allclose(dense(M.mat_add(s, t)), a.T + b.T) and np.allclose(dense(M.mat_sub(s, t)), a.T - b.T)
    assert np.allclose(dense(M.hadamard(s, t)), a.T * b.T) and np.allclose(dense(M.mat_div(s, t)), a.T / b.T)
    assert np.isclose(M.mat_dot(s, t).first()["dot"], (a * b).sum())
    assert np.isclose(M.mat_dot(s, table(spark, b.T)).first()["dot"], (a * b).sum())
    assert np.allclose(dense(M.mat_row(s, 2)), a.T[2:3]) and np.allclose(dense(M.mat_col(s, 3)), a.T[:, 3:4])
    assert np.allclose(dense(M.mat_apply(s, F.exp)), np.exp(a.T)) and np.allclose(dense(M.matrix_rows(s)), a.T)
    assert M.element(s, 3, 1).first()["v"] == a[1, 3]


def test_product_across_rows(spark):
    """A'B adds X'Z per batch; rows that one side lacks add nothing; odd widths raise."""
    a, b = RNG.normal(size=(40, 3)), RNG.normal(size=(40, 6))
    left, right = table(spark, a, "rows", 4), table(spark, b, "rows", 2)
    for method in ("auto", "rows"):
        assert np.allclose(dense(M.matmul(M.mat_transpose(left), right, method)), a.T @ b)
    assert np.allclose(dense(M.matmul(M.mat_transpose(left), left)), a.T @ a)
    some = M.MatrixTable(right.df.filter("i % 2 = 0"), 40, 6, "rows")
    assert np.allclose(dense(M.matmul(M.mat_transpose(left), some)), a[::2].T @ b[::2])
    with pytest.raises(ValueError):
        M.matmul(left, right.__class__(right.df, 3, 40), "rows")
    odd = M.from_rows(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "id long, x array<double>"), "id", "x", 2, 2)
    with pytest.raises(Exception, match="does not have 2"):
        M.matmul(M.mat_transpose(odd), odd).df.collect()


@pytest.mark.parametrize("layout", ["cells", "rows"])
def test_missing_cells_and_rows_are_zeros(spark, layout):
    a, b = np.array([[4.0, 0, 3], [0, 0, 0], [0, 2, 0]]), np.array([[2.0, 0, 0], [0, 5, 0], [0, 0, 0]])

    def sparse(m):
        t = table(spark, m, layout)
        return t if layout == "cells" else M.MatrixTable(t.df.filter(F.exists("x", lambda v: v != 0)), 3, 3, "rows")

    got = np.zeros((3, 3))
    for r in M.mat_div(sparse(a), sparse(b)).cells().collect():
        got[r["i"], r["j"]] = r["v"]
    with np.errstate(divide="ignore", invalid="ignore"):
        assert np.array_equal(got, a * (1 / b), equal_nan=True)
    assert np.allclose(dense(M.mat_apply(sparse(a), lambda v: v + 1)), a + 1)
    rows = M.matrix_rows(sparse(a)).df.orderBy("i").collect()
    assert [r["i"] for r in rows] == [0, 1, 2] and np.array_equal([r["x"] for r in rows], a)


def test_counted_rows_tell_density(spark):
    df = spark.createDataFrame([(0, [1.0]), (2, [3.0])], "id long, x array<double>")
    assert not M.from_rows(df, "id", "x").dense and M.from_rows(df.filter("id = 0"), "id", "x").dense
    assert np.allclose(dense(M.mat_apply(M.from_rows(df, "id", "x"), F.exp)), np.exp([[1.0], [0], [3]]))
