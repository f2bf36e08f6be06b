"""Queries for decompositions, clustering and mixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from frameml.operators import clustering as K, decomposition as D, mixture as G
from frameml.operators.matrix import from_rows
from frameml.workloads.common import (CELLS, EVENTS, embeddings, rounded, scaled_events)

XS = ["a", "b"]

# Explicit starts of the k-means and mixture queries.
CENTRES = [[0.1, 0.1], [1.0, 0.5], [2.0, 0.9]]
MEANS = [[0.5, 0.3], [2.0, 0.7]]


def _loadings(df, *extra):
    cols = [F.col(c) for c in extra]
    return df.select("component", *cols, F.posexplode("v").alias("j", "v")).select(
        "component", *extra, "j", rounded("v").alias("v"))


def svd(spark, folder):
    model = D.svd(scaled_events(spark, folder), XS)
    got = model.to_df(spark).withColumn("s", rounded("s"))
    return _loadings(got, "s")


def svd_qr(spark, folder):
    model = D.svd(scaled_events(spark, folder), XS, method="qr")
    got = model.to_df(spark).withColumn("s", rounded("s"))
    return _loadings(got, "s")


def svd_left(spark, folder):
    rows = scaled_events(spark, folder)
    got = D.svd_left(rows, D.svd(rows, XS), XS)
    return got.select("event_id", rounded(F.col("u")[0]).alias("u0"), rounded(F.col("u")[1]).alias("u1"))


def svd_rebuild(spark, folder):
    """U S V' of the full-width decomposition gives the embeddings back."""
    rows = embeddings(spark, folder)
    model = D.svd(rows, "embedding")
    left = D.svd_left(rows, model, "embedding")
    d = len(model.s)
    back = D.pca_inverse_transform(
        left.withColumn("us", F.zip_with("u", F.array(*[F.lit(s) for s in model.s]), lambda u, s: u * s)),
        D.PcaModel((0.0,) * d, model.v, model.s), "us")
    cells = from_rows(back, "vec_id", "x_hat", 1, 1).cells()
    return cells.select("i", "j", rounded("v").alias("v"))


def svd_wide(spark, folder):
    """Ten rows of 64 columns, the mean vectors of the labels, from their U S V'."""
    long = embeddings(spark, folder).select("label", F.posexplode("embedding").alias("j", "v"))
    means = long.groupBy("label", "j").agg(F.avg("v").alias("v"))
    rows = means.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "v"))), lambda c: c["v"]).alias("x"))
    model = D.svd(rows, "x")
    left = D.svd_left(rows, model, "x")
    scaled = left.withColumn("us", F.zip_with("u", F.array(*[F.lit(s) for s in model.s]), lambda u, s: u * s))
    back = D.pca_inverse_transform(scaled, D.PcaModel((0.0,) * len(model.v[0]), model.v, model.s), "us")
    return back.select("label", F.posexplode("x_hat").alias("j", "v")).select("label", "j", rounded("v").alias("v"))


def pca_fit(spark, folder):
    model = D.pca_fit(scaled_events(spark, folder), XS, 2)
    got = model.to_df(spark).withColumnRenamed("loading", "v")
    return _loadings(got.withColumn("explained_variance", rounded("explained_variance")), "explained_variance")


def pca_transform(spark, folder):
    rows = scaled_events(spark, folder)
    got = D.pca_transform(rows, D.pca_fit(rows, XS, 2), XS)
    return got.select("event_id", rounded(F.col("z")[0]).alias("z0"), rounded(F.col("z")[1]).alias("z1"))


def pca_inverse_transform(spark, folder):
    rows = scaled_events(spark, folder)
    model = D.pca_fit(rows, XS, 1)
    got = D.pca_inverse_transform(D.pca_transform(rows, model, XS), model, "z")
    return got.select("event_id", rounded(F.col("x_hat")[0]).alias("a"), rounded(F.col("x_hat")[1]).alias("b"))


def pca_rebuild(spark, folder):
    """All 64 components give the embeddings back."""
    rows = embeddings(spark, folder)
    model = D.pca_fit(rows, "embedding", 64)
    back = D.pca_inverse_transform(D.pca_transform(rows, model, "embedding"), model, "z")
    cells = from_rows(back, "vec_id", "x_hat", 1, 1).cells()
    return cells.select("i", "j", rounded("v").alias("v"))


def pca_total_variance(spark, folder):
    model = D.pca_fit(embeddings(spark, folder), "embedding", 64)
    return model.to_df(spark).agg(rounded(F.sum("explained_variance")).alias("total"),
                                  F.count(F.lit(1)).alias("components"))


def kmeans_init_pp(spark, folder):
    """Four start centres; each one is a row of the table."""
    rows = scaled_events(spark, folder)
    centres = K.kmeans_init_pp(rows, XS, 4, "event_id", seed=3)
    table = spark.createDataFrame([(k, float(c[0]), float(c[1])) for k, c in enumerate(centres)],
                                  "k int, a double, b double")
    return table.join(rows.select("a", "b").distinct(), XS, "left_semi").agg(
        F.count(F.lit(1)).alias("found"), F.countDistinct("a", "b").alias("different"))


def _lloyd(spark, folder):
    return K.kmeans_fit(scaled_events(spark, folder), XS, 3, max_iters=5, init=CENTRES)


def kmeans_fit(spark, folder):
    return _lloyd(spark, folder).to_df(spark).select("cluster", "j", rounded("centre").alias("centre"))


def kmeans_predict(spark, folder):
    got = K.kmeans_predict(scaled_events(spark, folder), _lloyd(spark, folder), XS)
    return got.select("event_id", "cluster")


def kmeans_predict_with_nulls(spark, folder):
    """Every fifth event lacks a value and gets no cluster."""
    rows = scaled_events(spark, folder)
    holed = rows.withColumn("a", F.when(F.col("event_id") % 5 != 0, F.col("a")))
    got = K.kmeans_predict(holed, _lloyd(spark, folder), XS)
    return got.select("event_id", "cluster")


def kmeans_wide(spark, folder):
    """One Lloyd update on the embeddings from the class means, which are
    computed from the table; sizes and inertia-like sums per cluster."""
    rows = embeddings(spark, folder)
    x = F.posexplode(F.col("embedding").cast("array<double>")).alias("j", "v")
    means = rows.select("label", x).groupBy("label", "j").agg(F.avg("v").alias("v")).orderBy("label", "j").collect()
    k = max(r["label"] for r in means) + 1
    init = [[r["v"] for r in means if r["label"] == c] for c in range(k)]
    model = K.kmeans_fit(rows, "embedding", k, max_iters=1, init=init)
    return model.to_df(spark).select("cluster", "j", rounded("centre").alias("centre"))


def gaussian_pdf(spark, folder):
    rows = scaled_events(spark, folder)
    density = G.gaussian_pdf(rows, XS, MEANS[0], [[0.5, 0.1], [0.1, 0.3]])
    return rows.select("event_id", rounded(density).alias("density"))


def _mixture(spark, folder):
    return G.gmm_fit(scaled_events(spark, folder), XS, 2, max_iters=2, init=MEANS)


def gmm_fit(spark, folder):
    got = _mixture(spark, folder).to_df(spark)
    return got.select("k", rounded("weight").alias("weight"), rounded(F.col("mean")[0]).alias("ma"),
                      rounded(F.col("mean")[1]).alias("mb"), rounded(F.col("cov")[0][0]).alias("va"),
                      rounded(F.col("cov")[0][1]).alias("vab"), rounded(F.col("cov")[1][1]).alias("vb"))


def gmm_predict_proba(spark, folder):
    got = G.gmm_predict_proba(scaled_events(spark, folder), _mixture(spark, folder), XS)
    return got.select("event_id", rounded(F.col("probability")[0]).alias("p0"),
                      rounded(F.col("probability")[1]).alias("p1"))


def gmm_predict(spark, folder):
    got = G.gmm_predict(scaled_events(spark, folder), _mixture(spark, folder), XS)
    return got.select("event_id", "component")


QUERIES = {
    "svd": svd, "svd_qr": svd_qr, "svd_left": svd_left, "svd_rebuild": svd_rebuild, "svd_wide": svd_wide, "pca_fit": pca_fit,
    "pca_transform": pca_transform, "pca_inverse_transform": pca_inverse_transform, "pca_rebuild": pca_rebuild,
    "pca_total_variance": pca_total_variance, "kmeans_init_pp": kmeans_init_pp, "kmeans_fit": kmeans_fit,
    "kmeans_predict": kmeans_predict, "kmeans_predict_with_nulls": kmeans_predict_with_nulls, "kmeans_wide": kmeans_wide, "gaussian_pdf": gaussian_pdf,
    "gmm_fit": gmm_fit, "gmm_predict_proba": gmm_predict_proba, "gmm_predict": gmm_predict,
}

# Eigenpairs of [[p, q], [q, r]]: value e, vector (x, y) of length 1 whose
# larger entry is positive.
_EIGEN = """
e as (select unnest([0, 1])::int component, unnest([1, -1]) sgn, p, q, r, m from w),
e2 as (select *, (p+r)/2 + sgn*sqrt((p-r)*(p-r)/4 + q*q) e from e),
e3 as (select *, q/sqrt(q*q+(e-p)*(e-p)) x, (e-p)/sqrt(q*q+(e-p)*(e-p)) y from e2),
v as (select component, e, m, case when greatest(x, y) >= -least(x, y) then x else -x end x,
  case when greatest(x, y) >= -least(x, y) then y else -y end y from e3)
"""
_SVD = f"with {EVENTS}, w as (select sum(a*a) p, sum(a*b) q, sum(b*b) r, count(*) m from x), {_EIGEN}"
_PCA = (f"with {EVENTS}, w as (select var_samp(a) p, covar_samp(a, b) q, var_samp(b) r, count(*) m from x), "
        f"mu as (select avg(a) ma, avg(b) mb from x), {_EIGEN}")
_SVD_OUT = (f"{_SVD} select component, round(sqrt(e), 6) + 0.0 s, 0::int j, round(x, 6) + 0.0 v from v "
            "union all select component, round(sqrt(e), 6) + 0.0, 1::int, round(y, 6) + 0.0 from v")

_LLOYD = f"""with recursive {EVENTS},
r(i, c) as (select 0, {CENTRES}::double[][] union all
 select i+1, list([a, b] order by k) from (select i, k, avg(a) a, avg(b) b from (
  select i, a, b, list_position(l, list_min(l)) k from (
   select i, a, b, list_transform(c, lambda z: (a-z[1])**2+(b-z[2])**2) l from r, x where i < 5)) group by i, k)
 group by i),
c as (select c from r where i = 5)"""


def _density(a: str, b: str, ma, mb, va, vab, vb) -> str:
    det = f"({va}*{vb}-{vab}*{vab})"
    quad = (f"({vb}*({a}-{ma})*({a}-{ma}) - 2*{vab}*({a}-{ma})*({b}-{mb}) + {va}*({b}-{mb})*({b}-{mb}))/{det}")
    return f"exp(-0.5*{quad})/(2*pi()*sqrt(greatest({det}, 1e-9)))"


def _em_round(k: int) -> str:
    """CTEs d{k} (joint densities), s{k} (shares) and m{k} (parameters)."""
    before = f"m{k - 1}"
    pdf = _density("x.a", "x.b", "m.ma", "m.mb", "m.va", "m.vab", "m.vb")
    return f"""
d{k} as (select x.event_id, x.a, x.b, m.k, m.weight*{pdf} j from x, {before} m),
s{k} as (select *, j/sum(j) over (partition by event_id) r from d{k}),
u{k} as (select k, sum(r) nk, sum(r*a)/sum(r) ma, sum(r*b)/sum(r) mb from s{k} group by k),
m{k} as (select s.k, any_value(nk)/(select count(*) from x) weight, any_value(ma) ma, any_value(mb) mb,
  sum(r*(a-ma)*(a-ma))/any_value(nk) + 1e-5 va, sum(r*(a-ma)*(b-mb))/any_value(nk) vab,
  sum(r*(b-mb)*(b-mb))/any_value(nk) + 1e-5 vb from s{k} s join u{k} u using (k) group by s.k)"""


_EM = (f"with {EVENTS}, m0 as (select * from (values (0, 0.5::double, {MEANS[0][0]}::double, {MEANS[0][1]}::double, "
       f"1.0::double, 0.0::double, 1.0::double), (1, 0.5, {MEANS[1][0]}, {MEANS[1][1]}, 1.0, 0.0, 1.0)) "
       "t(k, weight, ma, mb, va, vab, vb)), " + ", ".join(_em_round(k) for k in (1, 2)))
_EM_SCORE = _EM + (f", d3 as (select x.event_id, m.k, m.weight*"
                   f"{_density('x.a', 'x.b', 'm.ma', 'm.mb', 'm.va', 'm.vab', 'm.vb')} j from x, m2 m), "
                   "f as (select event_id, max(j) filter (k = 0) j0, max(j) filter (k = 1) j1 from d3 group by 1)")

SQL = {
    "svd": _SVD_OUT,
    "svd_qr": _SVD_OUT,
    "svd_left": f"{_SVD} select event_id, round((a*f.x+b*f.y)/sqrt(f.e), 6) + 0.0 u0, "
                "round((a*g.x+b*g.y)/sqrt(g.e), 6) + 0.0 u1 from x, v f, v g where f.component = 0 and g.component = 1",
    "svd_wide": f"with {CELLS} select label, j::int j, round(avg(v), 6) + 0.0 v from a join embeddings on i = vec_id group by 1, 2",
    "svd_rebuild": f"with {CELLS} select i, j, round(v, 6) + 0.0 v from a",
    "pca_fit": f"{_PCA} select component, round(e, 6) + 0.0 explained_variance, 0::int j, round(x, 6) + 0.0 v from v "
               "union all select component, round(e, 6) + 0.0, 1::int, round(y, 6) + 0.0 from v",
    "pca_transform": f"{_PCA} select event_id, round((a-ma)*f.x+(b-mb)*f.y, 6) + 0.0 z0, "
                     "round((a-ma)*g.x+(b-mb)*g.y, 6) + 0.0 z1 from x, mu, v f, v g "
                     "where f.component = 0 and g.component = 1",
    "pca_inverse_transform": f"{_PCA} select event_id, round(((a-ma)*f.x+(b-mb)*f.y)*f.x + ma, 6) + 0.0 a, "
                             "round(((a-ma)*f.x+(b-mb)*f.y)*f.y + mb, 6) + 0.0 b from x, mu, v f where f.component = 0",
    "pca_rebuild": f"with {CELLS} select i, j, round(v, 6) + 0.0 v from a",
    "pca_total_variance": f"with {CELLS}, s as (select j, var_samp(v) e from a group by j) "
                          "select round(sum(e), 6) + 0.0 total, count(*) components from s",
    "kmeans_init_pp": "select 4::bigint \"found\", 4::bigint different",
    "kmeans_fit": f"{_LLOYD} select k.range::int \"cluster\", j.range::int j, round(c[k.range+1][j.range+1], 6) + 0.0 centre "
                  "from c, range(0, 3) k, range(0, 2) j",
    "kmeans_predict": f"{_LLOYD}, l as (select event_id, list_transform(c, lambda z: (a-z[1])**2+(b-z[2])**2) l "
                      "from x, c) select event_id, (list_position(l, list_min(l)) - 1)::int \"cluster\" from l",
    "kmeans_predict_with_nulls": f"{_LLOYD}, l as (select event_id, list_transform(c, lambda z: (a-z[1])**2+(b-z[2])**2) l "
                                 "from x, c) select event_id, case when event_id % 5 <> 0 then (list_position(l, list_min(l)) - 1)::int end "
                                 "\"cluster\" from l",
    "kmeans_wide": f"with {CELLS}, m as (select label c, j, avg(v) m from a join embeddings e on e.vec_id = a.i group by 1, 2), "
                   "d as (select a.i, m.c, sum((a.v-m.m)*(a.v-m.m)) d from a join m using (j) group by 1, 2), "
                   "n as (select i, arg_min(c, d) c from d group by 1) "
                   "select n.c::int \"cluster\", a.j::int j, round(avg(a.v), 6) + 0.0 centre from a join n using (i) group by 1, 2",
    "gaussian_pdf": f"with {EVENTS} select event_id, round({_density('a', 'b', MEANS[0][0], MEANS[0][1], 0.5, 0.1, 0.3)}, 6) "
                    "+ 0.0 density from x",
    "gmm_fit": f"{_EM} select k, round(weight, 6) + 0.0 weight, round(ma, 6) + 0.0 ma, round(mb, 6) + 0.0 mb, "
               "round(va, 6) + 0.0 va, round(vab, 6) + 0.0 vab, round(vb, 6) + 0.0 vb from m2",
    "gmm_predict_proba": f"{_EM_SCORE} select event_id, round(j0/(j0+j1), 6) + 0.0 p0, round(j1/(j0+j1), 6) + 0.0 p1 from f",
    "gmm_predict": f"{_EM_SCORE} select event_id, (case when j1 > j0 then 1 else 0 end)::int component from f",
}
