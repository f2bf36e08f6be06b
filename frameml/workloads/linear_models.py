"""Queries for statistics, regressions and per-group solves."""

from __future__ import annotations

from pyspark.sql import functions as F

from frameml.functions.activations import softmax
from frameml.operators import logistic as L
from frameml.operators import metrics, regression as R, solvers
from frameml.plans.moments import moments
from frameml.sources.tables import read_table
from frameml.workloads.common import (CELLS, EVENTS, LINES, embeddings, rounded, scaled_events, scaled_lineitem)

XS = ["q", "p"]


def _cells(m, spark, digits=4):
    return m.to_df(spark).select("name", "i", "j", rounded("value", digits).alias("value"))


def moments_query(spark, folder):
    return _cells(moments(scaled_lineitem(spark, folder), XS, "y"), spark)


def moments_weighted(spark, folder):
    rows = scaled_lineitem(spark, folder)
    return _cells(moments(rows, XS, "y", weight="p"), spark)


def moments_wide(spark, folder):
    return _cells(moments(embeddings(spark, folder), "embedding", "label"), spark, 6)


def column_means(spark, folder):
    got = metrics.column_means(read_table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return got.select(*[rounded(c).alias(c) for c in got.columns])


def variance_impurity(spark, folder):
    got = metrics.variance_impurity(scaled_lineitem(spark, folder), "y", "l_returnflag")
    return got.select("l_returnflag", rounded("impurity").alias("impurity"))


def gini(spark, folder):
    got = metrics.gini(read_table(spark, folder, "labels"), "quality", "toxic")
    return got.select("toxic", rounded("impurity").alias("impurity"))


def majority_class(spark, folder):
    rows = read_table(spark, folder, "labels").join(read_table(spark, folder, "documents"), "doc_id")
    return metrics.majority_class(rows, "quality", "lang")


def _scored(spark, folder):
    rows = scaled_lineitem(spark, folder)
    return R.linear_predict(rows, R.linear_fit(rows, XS, "y"), XS)


def mse(spark, folder):
    return metrics.mse(_scored(spark, folder), "prediction", "y").select(rounded("mse", 9).alias("mse"))


def half_mse(spark, folder):
    got = metrics.half_mse(_scored(spark, folder), "prediction", "y", "l_returnflag")
    return got.select("l_returnflag", rounded("half_mse", 9).alias("half_mse"))


def cross_entropy(spark, folder):
    x = F.col("embedding").cast("array<double>")
    rows = embeddings(spark, folder).withColumn("probs", softmax(F.transform(x, lambda v: v * 10)))
    return metrics.cross_entropy(rows, "probs", "label").select(rounded("cross_entropy").alias("cross_entropy"))


def generalized_variance(spark, folder):
    got = solvers.generalized_variance(scaled_lineitem(spark, folder), "l_returnflag", ["q", "y"])
    return got.select("l_returnflag", "n", rounded("det", 9).alias("det"))


def linear_fit_by_group(spark, folder):
    got = solvers.linear_fit_by_group(scaled_lineitem(spark, folder), "l_returnflag", XS, "y", reg=1.0)
    return got.select("l_returnflag", "n", "status", rounded(F.col("theta")[0]).alias("t0"),
                      rounded(F.col("theta")[1]).alias("t1"))


def whiten(spark, folder):
    got = solvers.whiten(scaled_events(spark, folder), ["a", "b"])
    return got.select("event_id", rounded("w0").alias("w0"), rounded("w1").alias("w1"))


def mahalanobis(spark, folder):
    got = solvers.mahalanobis(scaled_events(spark, folder), ["a", "b"], "event_type")
    return got.select("event_id", rounded("distance_sq").alias("distance_sq"))


def _theta(model, spark, digits=6):
    return model.to_df(spark).select("j", rounded("theta", digits).alias("theta"))


def linear_fit(spark, folder):
    return _theta(R.linear_fit(scaled_lineitem(spark, folder), XS, "y"), spark)


def ridge_fit(spark, folder):
    return _theta(R.linear_fit(scaled_lineitem(spark, folder), XS, "y", reg=10.0), spark)


def linear_fit_gd(spark, folder):
    return _theta(R.linear_fit_gd(scaled_lineitem(spark, folder), XS, "y", 200, 0.5, reg=0.01), spark)


def linear_gd_loss(spark, folder):
    model = R.linear_fit_gd(scaled_lineitem(spark, folder), XS, "y", 200, 0.5)
    return model.history_df(spark).select("epoch", rounded("loss", 9).alias("loss"))


def lasso_fit(spark, folder):
    return _theta(R.lasso_fit(scaled_lineitem(spark, folder), XS, "y", reg=0.05), spark)


def linear_predict(spark, folder):
    """Mean prediction and residual per return flag and line status."""
    scored = _scored(spark, folder)
    return scored.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("prediction")).alias("prediction"),
        rounded(F.avg(F.col("y") - F.col("prediction"))).alias("residual"))


def _price_rows(spark, folder):
    rows = scaled_lineitem(spark, folder)
    return rows.select("l_returnflag", "l_linestatus", F.lit(1.0).alias("one"), "q",
                       F.when(F.col("y") > 0.5, 1.0).otherwise(0.0).alias("high"))


def _newton(spark, folder):
    return L.logistic_fit(_price_rows(spark, folder), ["one", "q"], "high", max_iters=5)


def logistic_fit(spark, folder):
    return _theta(_newton(spark, folder), spark)


def logistic_gradient(spark, folder):
    """Squared gradient norm of every step, as a share of rows^2."""
    model = _newton(spark, folder)
    n = read_table(spark, folder, "lineitem").count()
    return model.history_df(spark).select("step", rounded(F.col("gradient_sq") / n / n, 9).alias("share"))


def logistic_predict_proba(spark, folder):
    scored = L.logistic_predict_proba(_price_rows(spark, folder), _newton(spark, folder), ["one", "q"])
    return scored.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("probability")).alias("probability"))


def logistic_predict(spark, folder):
    scored = L.logistic_predict(_price_rows(spark, folder), _newton(spark, folder), ["one", "q"], threshold=0.53)
    return scored.groupBy("l_returnflag", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _holed_lines(spark, folder):
    """Every line by its key, without a discount where that is 0."""
    rows = read_table(spark, folder, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", F.lit(1.0).alias("one"), (F.col("l_quantity") / 50).alias("q"),
                       F.expr("nullif(l_discount, 0) * 10").alias("p"))


def linear_predict_with_nulls(spark, folder):
    """Each line's prediction; null where the discount is."""
    model = R.linear_fit(scaled_lineitem(spark, folder), XS, "y")
    got = R.linear_predict(_holed_lines(spark, folder), model, XS)
    return got.select("l_orderkey", "l_linenumber", rounded("prediction").alias("prediction"))


def logistic_predict_by_row(spark, folder):
    """Each line's probability and class."""
    rows, model = _holed_lines(spark, folder), _newton(spark, folder)
    scored = L.logistic_predict_proba(rows, model, ["one", "q"])
    got = L.logistic_predict(scored, model, ["one", "q"], threshold=0.53)
    return got.select("l_orderkey", "l_linenumber", rounded("probability").alias("probability"), "prediction")


QUERIES = {
    "linear_predict_with_nulls": linear_predict_with_nulls, "logistic_predict_by_row": logistic_predict_by_row,
    "moments": moments_query, "moments_weighted": moments_weighted, "moments_wide": moments_wide,
    "column_means": column_means, "variance_impurity": variance_impurity, "gini": gini,
    "majority_class": majority_class, "mse": mse, "half_mse": half_mse, "cross_entropy": cross_entropy,
    "generalized_variance": generalized_variance, "linear_fit_by_group": linear_fit_by_group, "whiten": whiten,
    "mahalanobis": mahalanobis, "linear_fit": linear_fit, "ridge_fit": ridge_fit, "linear_fit_gd": linear_fit_gd,
    "linear_gd_loss": linear_gd_loss, "lasso_fit": lasso_fit, "linear_predict": linear_predict,
    "logistic_fit": logistic_fit, "logistic_gradient": logistic_gradient,
    "logistic_predict_proba": logistic_predict_proba, "logistic_predict": logistic_predict,
}

_SUMS = ("g as (select sum(q*q) a, sum(q*p) b, sum(p*p) d, sum(q*y) e, sum(p*y) f, sum(y*y) yy, "
         "count(*)::double n from x)")
_OLS = "t as (select (d*e-b*f)/(a*d-b*b) t0, (a*f-b*e)/(a*d-b*b) t1 from g)"
_SCORED = f"with {LINES}, {_SUMS}, {_OLS}, s as (select x.*, q*t0+p*t1 h from x, t)"


def _moments_sql(weight: str) -> str:
    terms = [("'n'", 0, 0, "count(*)::double"), ("'w'", 0, 0, f"sum({weight})"), ("'sy'", 0, 0, f"sum({weight}*y)"),
             ("'yy'", 0, 0, f"sum({weight}*y*y)"), ("'sx'", 0, 0, f"sum({weight}*q)"),
             ("'sx'", 1, 0, f"sum({weight}*p)"), ("'xy'", 0, 0, f"sum({weight}*q*y)"),
             ("'xy'", 1, 0, f"sum({weight}*p*y)"), ("'gram'", 0, 0, f"sum({weight}*q*q)"),
             ("'gram'", 0, 1, f"sum({weight}*q*p)"), ("'gram'", 1, 1, f"sum({weight}*p*p)")]
    parts = [f"select {n} \"name\", {i} i, {j} j, round({e}, 4) + 0.0 \"value\" from x" for n, i, j, e in terms]
    return f"with {LINES} " + " union all ".join(parts)


def _tall(name, value, i="0", j="0", source="a"):
    return f"select '{name}' \"name\", {i}::int i, {j}::int j, round({value}, 6) + 0.0 \"value\" from {source}"


_NEWTON = """
x as (select l_returnflag, l_linestatus, l_quantity/50 q,
  (case when l_extendedprice/1e5 > 0.5 then 1.0 else 0.0 end)::double y from lineitem),
r(i, t0, t1, gg) as (select 0, 0.0::double, 0.0::double, null::double union all
  select i+1, t0-(h11*g0-h01*g1)/(h00*h11-h01*h01), t1-(h00*g1-h01*g0)/(h00*h11-h01*h01), g0*g0+g1*g1 from (
    select any_value(i) i, any_value(t0) t0, any_value(t1) t1, sum(h-y) g0, sum(q*(h-y)) g1,
      sum(h*(1-h))+1e-4 h00, sum(h*(1-h)*q) h01, sum(h*(1-h)*q*q)+1e-4 h11
    from (select i, t0, t1, q, y, 1/(1+exp(-(t0+t1*q))) h from r, x where i < 5)) where i is not null)
"""

_GD = """
r(i, t0, t1, loss) as (select 0, 0.0::double, 0.0::double, null::double union all
  select i+1, t0-0.5*((a*t0+b*t1-e)/n + {reg}*t0), t1-0.5*((b*t0+d*t1-f)/n + {reg}*t1),
    (a*t0*t0+2*b*t0*t1+d*t1*t1 - 2*(t0*e+t1*f) + yy)/(2*n)
  from r, g where i < 200)
"""

_LASSO = """
r(i, t0, t1, big) as (select 0, 0.0::double, 0.0::double, 1.0::double union all
  select i+1, u0, u1, greatest(abs(u0-t0), abs(u1-t1)) from (
    select i, t0, t1, u0, case when abs(n1-t1) > 1e-5 then n1 else t1 end u1 from (
      select *, sign(f-b*u0)*greatest(abs(f-b*u0)-0.05*n, 0)/d n1 from (
        select *, case when abs(n0-t0) > 1e-5 then n0 else t0 end u0 from (
          select r.*, g.*, sign(e-b*t1)*greatest(abs(e-b*t1)-0.05*n, 0)/a n0
          from r, g where i < 100 and big >= 1e-4)))))
"""

_COV = ("c as (select {by} avg(a) ma, avg(b) mb, var_samp(a) va, var_samp(b) vb, covar_samp(a, b) vab from x {group})")

SQL = {
    "moments": _moments_sql("1.0::double"),
    "moments_weighted": _moments_sql("p"),
    "moments_wide": f"with {CELLS}, l as (select vec_id i, label::double y from embeddings) "
                    + " union all ".join([
                        _tall("n", "count(*)::double", source="l"), _tall("w", "count(*)::double", source="l"),
                        _tall("sy", "sum(y)", source="l"), _tall("yy", "sum(y*y)", source="l"),
                        _tall("sx", "sum(v)", "j") + " group by j",
                        _tall("xy", "sum(v*y)", "j", source="a join l using (i)") + " group by j",
                        _tall("gram", "sum(s.v*t.v)", "s.j", "t.j", "a s join a t on s.i = t.i and s.j <= t.j")
                        + " group by s.j, t.j"]),
    "column_means": "select round(avg(l_quantity), 6) + 0.0 mean_0, round(avg(l_extendedprice), 6) + 0.0 mean_1, "
                    "round(avg(l_discount), 6) + 0.0 mean_2, round(avg(l_tax), 6) + 0.0 mean_3 from lineitem",
    "variance_impurity": f"with {LINES} select l_returnflag, round(var_pop(y), 6) + 0.0 impurity from x group by 1",
    "gini": "with c as (select toxic, quality, count(*)::double n from labels group by 1, 2) select toxic, "
            "round(1 - sum(n*n)/(sum(n)*sum(n)), 6) + 0.0 impurity from c group by 1",
    "majority_class": "with c as (select lang, quality, count(*) n from labels join documents using (doc_id) "
                      "group by 1, 2) select lang, quality majority, n votes from c qualify "
                      "row_number() over (partition by lang order by n desc, quality) = 1",
    "mse": f"{_SCORED} select round(avg((h-y)*(h-y)), 9) + 0.0 mse from s",
    "half_mse": f"{_SCORED} select l_returnflag, round(avg((h-y)*(h-y))/2, 9) + 0.0 half_mse from s group by 1",
    "cross_entropy": f"with {CELLS}, m as (select i, j, v*10 v, max(v*10) over (partition by i) mx from a), "
                     "s as (select i, j, exp(v-mx)/sum(exp(v-mx)) over (partition by i) p from m) "
                     "select round(sum(-ln(p + 1e-7)), 6) + 0.0 cross_entropy from s join embeddings e "
                     "on e.vec_id = s.i and e.label = s.j",
    "generalized_variance": f"with {LINES} select l_returnflag, count(*) n, round(var_samp(q)*var_samp(y) - "
                            "covar_samp(q, y)**2, 9) + 0.0 det from x group by 1",
    "linear_fit_by_group": f"with {LINES}, g as (select l_returnflag, count(*) n, sum(q*q)+1 a, sum(q*p) b, "
                           "sum(p*p)+1 d, sum(q*y) e, sum(p*y) f from x group by 1) select l_returnflag, n, 'ok' status, "
                           "round((d*e-b*f)/(a*d-b*b), 6) + 0.0 t0, round((a*f-b*e)/(a*d-b*b), 6) + 0.0 t1 from g",
    "whiten": f"with {EVENTS}, {_COV.format(by='', group='')} select event_id, round((a-ma)/sqrt(va), 6) + 0.0 w0, "
              "round(((b-mb) - vab/va*(a-ma))/sqrt(vb - vab*vab/va), 6) + 0.0 w1 from x, c",
    "mahalanobis": f"with {EVENTS}, {_COV.format(by='event_type,', group='group by 1')} select event_id, "
                   "round((vb*(a-ma)**2 - 2*vab*(a-ma)*(b-mb) + va*(b-mb)**2)/(va*vb-vab*vab), 6) + 0.0 distance_sq "
                   "from x join c using (event_type)",
    "linear_fit": f"with {LINES}, {_SUMS}, {_OLS} select 0::int j, round(t0, 6) + 0.0 theta from t "
                  "union all select 1::int, round(t1, 6) + 0.0 from t",
    "ridge_fit": f"with {LINES}, {_SUMS}, t as (select ((d+10)*e-b*f)/((a+10)*(d+10)-b*b) t0, "
                 "((a+10)*f-b*e)/((a+10)*(d+10)-b*b) t1 from g) select 0::int j, round(t0, 6) + 0.0 theta from t "
                 "union all select 1::int, round(t1, 6) + 0.0 from t",
    "linear_fit_gd": f"with recursive {LINES}, {_SUMS}, {_GD.format(reg='0.01')} select 0::int j, round(t0, 6) + 0.0 theta "
                     "from r where i = 200 union all select 1::int, round(t1, 6) + 0.0 from r where i = 200",
    "linear_gd_loss": f"with recursive {LINES}, {_SUMS}, {_GD.format(reg='0.0')} select (i-1)::int epoch, "
                      "round(loss, 9) + 0.0 loss from r where i > 0 and (i-1) % 20 = 0",
    "lasso_fit": f"with recursive {LINES}, {_SUMS}, {_LASSO}, z as (select * from r order by i desc limit 1) "
                 "select 0::int j, round(t0, 6) + 0.0 theta from z union all select 1::int, round(t1, 6) + 0.0 from z",
    "linear_predict_with_nulls": f"with {LINES}, {_SUMS}, {_OLS} select l_orderkey, l_linenumber, case when l_discount <> 0 then "
                                 "round(l_quantity/50*t0 + l_discount*10*t1, 6) + 0.0 end prediction from lineitem, t",
    "logistic_predict_by_row": f"with recursive {_NEWTON} select l_orderkey, l_linenumber, "
                               "round(1/(1+exp(-(t0+t1*(l_quantity/50)))), 6) + 0.0 probability, (case when "
                               "1/(1+exp(-(t0+t1*(l_quantity/50)))) >= 0.53 then 1.0 else 0.0 end)::double prediction "
                               "from lineitem, r where i = 5",
    "linear_predict": f"{_SCORED} select l_returnflag, l_linestatus, count(*) n, round(avg(h), 6) + 0.0 prediction, "
                      "round(avg(y-h), 6) + 0.0 residual from s group by 1, 2",
    "logistic_fit": f"with recursive {_NEWTON} select 0::int j, round(t0, 6) + 0.0 theta from r where i = 5 "
                    "union all select 1::int, round(t1, 6) + 0.0 from r where i = 5",
    "logistic_gradient": f"with recursive {_NEWTON} select (i-1)::int step, round(gg/c/c, 9) + 0.0 share "
                         "from r, (select count(*)::double c from lineitem) where i > 0",
    "logistic_predict_proba": f"with recursive {_NEWTON} select l_returnflag, l_linestatus, count(*) n, "
                              "round(avg(1/(1+exp(-(t0+t1*q)))), 6) + 0.0 probability from x, r where i = 5 group by 1, 2",
    "logistic_predict": f"with recursive {_NEWTON} select l_returnflag, (case when 1/(1+exp(-(t0+t1*q))) >= 0.53 "
                        "then 1.0 else 0.0 end)::double prediction, count(*) n from x, r where i = 5 group by 1, 2",
}
