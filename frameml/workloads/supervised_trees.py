"""Queries for split search, trees and boosting."""

from __future__ import annotations

from pyspark.sql import functions as F

from frameml.operators import boosting as B, trees as T
from frameml.sources.tables import read_table
from frameml.workloads.common import embeddings, rounded, scaled_lineitem

BOOST_TREES = 3
BOOST_LR = 0.1


def _split(df, node="node"):
    return df.select(F.col("node").alias(node), "feature", "threshold", rounded("gain").alias("gain"), "n", "n_left")


def best_split_variance(spark, folder):
    return _split(T.best_split_variance(embeddings(spark, folder), "embedding", "label"))


def best_split_variance_by_group(spark, folder):
    rows = scaled_lineitem(spark, folder)
    return _split(T.best_split_variance(rows, ["q", "p"], F.col("y") * 10, by="l_returnflag"), "l_returnflag")


def best_split_gini(spark, folder):
    return _split(T.best_split_gini(embeddings(spark, folder), "embedding", "label"))


def best_split_gini_by_group(spark, folder):
    rows = scaled_lineitem(spark, folder)
    late = F.when(F.col("l_linestatus") == "O", 1).otherwise(0)
    return _split(T.best_split_gini(rows, ["q", "p"], late, by="l_returnflag"), "l_returnflag")


def best_split_gini_many_classes(spark, folder):
    """Every order is a class of its own."""
    rows = read_table(spark, folder, "lineitem").select((F.col("l_quantity") / 50).alias("q"), (F.col("l_discount") * 10).alias("p"),
                                                        "l_orderkey", "l_returnflag")
    return _split(T.best_split_gini(rows, ["q", "p"], "l_orderkey", by="l_returnflag"), "l_returnflag")


def _by_supplier(spark, folder):
    rows = read_table(spark, folder, "lineitem").select((F.col("l_quantity") / 50).alias("q"), (F.col("l_discount") * 10).alias("p"),
                                                        (F.col("l_suppkey") % 97).alias("supplier"))
    return T.tree_classifier_fit(rows, ["q", "p"], "supplier", max_depth=2)


def tree_classifier_many_classes(spark, folder):
    return _nodes(_by_supplier(spark, folder), spark)


def _nodes(model, spark):
    got = model.to_df(spark)
    return got.select("node", "is_leaf", rounded("value").alias("value"), "feature", "threshold")


def _regressor(spark, folder):
    return T.tree_regressor_fit(embeddings(spark, folder), "embedding", "label", max_depth=2)


def tree_regressor_fit(spark, folder):
    return _nodes(_regressor(spark, folder), spark)


def _classifier(spark, folder):
    return T.tree_classifier_fit(embeddings(spark, folder), "embedding", "label", max_depth=2)


def tree_classifier_fit(spark, folder):
    return _nodes(_classifier(spark, folder), spark)


def tree_predict(spark, folder):
    got = T.tree_predict(embeddings(spark, folder), _regressor(spark, folder), "embedding")
    return got.select("vec_id", rounded("prediction").alias("prediction"))


def tree_predict_class(spark, folder):
    got = T.tree_predict(embeddings(spark, folder), _classifier(spark, folder), "embedding")
    return got.select("vec_id", "prediction")


def _boosted(spark, folder):
    return B.gbt_fit(embeddings(spark, folder), "embedding", "label", BOOST_TREES, BOOST_LR, max_depth=1)


def gbt_fit(spark, folder):
    got = _boosted(spark, folder).to_df(spark)
    return got.select("tree", "node", "is_leaf", rounded("value").alias("value"), "feature", "threshold",
                      rounded("base").alias("base"))


def gbt_predict(spark, folder):
    got = B.gbt_predict(embeddings(spark, folder), _boosted(spark, folder), "embedding")
    return got.select("vec_id", rounded("prediction").alias("prediction"))


QUERIES = {
    "best_split_variance": best_split_variance, "best_split_variance_by_group": best_split_variance_by_group,
    "best_split_gini": best_split_gini, "best_split_gini_by_group": best_split_gini_by_group,
    "best_split_gini_many_classes": best_split_gini_many_classes,
    "tree_regressor_fit": tree_regressor_fit, "tree_classifier_fit": tree_classifier_fit,
    "tree_classifier_many_classes": tree_classifier_many_classes,
    "tree_predict": tree_predict, "tree_predict_class": tree_predict_class,
    "gbt_fit": gbt_fit, "gbt_predict": gbt_predict,
}


def _variance_level(rows: str, out: str) -> str:
    """CTE ``out``: best variance split per node of ``rows`` (id, node, y, f, v)."""
    return f"""
{out}c as (select node, f, v, count(*)::double n, sum(y) s, sum(y*y) ss from {rows} group by all),
{out}w as (select node, f, v, sum(n) over o nl, sum(s) over o sl, sum(n) over p n, sum(s) over p s, sum(ss) over p ss
  from {out}c window o as (partition by node, f order by v), p as (partition by node, f)),
{out}g as (select *, (ss - s*s/n)/n parent, (sl*sl/nl + (s-sl)*(s-sl)/(n-nl) - s*s/n)/n gain from {out}w where nl < n),
{out} as (select node, f, v, gain, n, nl, parent from {out}g qualify row_number() over (partition by node order by
  round(case when parent > 0 then gain/parent else 0 end, 9) desc, f, v) = 1)"""


def _gini_level(rows: str, out: str) -> str:
    """CTE ``out``: best Gini split per node of ``rows``, on the value x class grid."""
    return f"""
{out}k as (select distinct y from {rows}),
{out}v as (select distinct node, f, v from {rows}),
{out}n as (select node, f, v, y, count(*)::double n from {rows} group by all),
{out}r as (select v.node, v.f, v.v, k.y, sum(coalesce(n.n, 0)) over (partition by v.node, v.f, k.y order by v.v) l,
  sum(coalesce(n.n, 0)) over (partition by v.node, v.f, k.y) t
  from {out}v v cross join {out}k k left join {out}n n using (node, f, v, y)),
{out}s as (select node, f, v, sum(l) nl, sum(t) n, sum(l*l) ll, sum((t-l)*(t-l)) rr, sum(t*t) tt from {out}r group by all),
{out}g as (select *, 1 - tt/(n*n) parent, (ll/nl + rr/(n-nl) - tt/n)/n gain from {out}s where nl < n),
{out} as (select node, f, v, gain, n, nl, parent from {out}g qualify row_number() over (partition by node order by
  round(case when parent > 0 then gain/parent else 0 end, 9) desc, f, v) = 1)"""


_LONG = ("l0 as (select vec_id id, 0 node, label::double y, unnest(range(0, len(embedding)))::int f, "
         "unnest(embedding)::double v from embeddings)")
_LINE_LONG = ("x as (select l_returnflag node, {y} y, l_quantity/50 q, l_discount*10 p from lineitem), "
              "l0 as (select node, y, unnest([0, 1])::int f, unnest([q, p]) v from x)")
_OUT = "select node {name}, f::int feature, v threshold, round(gain, 6) + 0.0 gain, n::bigint n, nl::bigint n_left from s0"


def _descend(rows: str, splits: str, out: str) -> str:
    """CTE ``out``: rows of split nodes moved to their children 2n+1, 2n+2."""
    return f"""
{out}d as (select r.id, case when r.v <= s.v then 2*r.node+1 else 2*r.node+2 end node
  from {rows} r join {splits} s on r.node = s.node and r.f = s.f),
{out} as (select r.id, d.node, r.y, r.f, r.v from {rows} r join {out}d d using (id))"""


def _tree(level, value: str, keep: str, long: str = "") -> str:
    """Depth-2 tree: node values and splits as CTE ``t``; final nodes ``z``."""
    return f"""with {long or _LONG}, {level('l0', 's0a')}, s0 as (select * from s0a where {keep}), {_descend('l0', 's0', 'l1')},
{level('l1', 's1a')}, s1 as (select * from s1a where {keep}), {_descend('l1', 's1', 'l2')},
rows_all as (select node, y from l0 where f = 0 union all select node, y from l1 where f = 0
  union all select node, y from l2 where f = 0),
vals as ({value}),
cuts as (select * from s0 union all select * from s1),
t as (select vals.node heap, (row_number() over (order by vals.node) - 1)::int node, cuts.node is null is_leaf, vals.val "value", cuts.f feature, cuts.v threshold
  from vals left join cuts on vals.node = cuts.node),
z as (select id, max(node) node from (select id, node from l0 union all select id, node from l1
  union all select id, node from l2) group by id)"""


_MEAN = "select node, avg(y) val from rows_all group by node"
_MODE = ("select node, y val from (select node, y, count(*) n from rows_all group by 1, 2) "
         "qualify row_number() over (partition by node order by n desc, y) = 1")
_REG = _tree(_variance_level, _MEAN, "gain >= 1e-5")
_CLS = _tree(_gini_level, _MODE, "parent >= 1e-6")
_MANY = _tree(_gini_level, _MODE, "parent >= 1e-6", """x as (select row_number() over () id, (l_suppkey % 97)::double y,
  l_quantity/50 q, l_discount*10 p from lineitem),
l0 as (select id, 0 node, y, unnest([0, 1])::int f, unnest([q, p]) v from x)""")
_NODES = "select node, is_leaf, round(\"value\", 6) + 0.0 \"value\", feature, threshold from t"


def _boost() -> str:
    """Stumps on residuals, one after another."""
    parts = [f"with {_LONG}", "b as (select avg(label::double) base from embeddings)",
             "y0 as (select id, 0 node, y - base y, f, v from l0, b)"]
    for t in range(BOOST_TREES):
        parts.append(_variance_level(f"y{t}", f"c{t}"))
        parts.append(f"side{t} as (select r.id, r.y, case when r.v <= s.v then 1 else 2 end side "
                     f"from y{t} r join c{t} s on r.f = s.f)")
        parts.append(f"leaf{t} as (select side, avg(y) val from side{t} group by side)")
        parts.append(f"y{t + 1} as (select r.id, 0 node, r.y - {BOOST_LR}*l.val y, r.f, r.v from y{t} r "
                     f"join side{t} d using (id) join leaf{t} l using (side))")
    return ", ".join(parts)


def _boost_nodes() -> str:
    out = []
    for t in range(BOOST_TREES):
        out.append(f"select {t}::int tree, 0::int node, false is_leaf, (select avg(y) from side{t}) val, "
                   f"f feature, v threshold from c{t} union all "
                   f"select {t}::int, side::int, true, val, null, null from leaf{t}")
    return (f"{_boost()}, nodes as ({' union all '.join(out)}) select tree, node, is_leaf, "
            "round(val, 6) + 0.0 \"value\", feature, threshold, round(base, 6) + 0.0 base from nodes, b")


def _boost_scores() -> str:
    total = " + ".join(f"l{t}v.val" for t in range(BOOST_TREES))
    joins = " ".join(f"join side{t} d{t} using (id) join leaf{t} l{t}v on l{t}v.side = d{t}.side"
                     for t in range(BOOST_TREES))
    return (f"{_boost()}, ids as (select vec_id id from embeddings) select ids.id vec_id, "
            f"round(base + {BOOST_LR}*({total}), 6) + 0.0 prediction from b, ids {joins}")


SQL = {
    "best_split_variance": f"with {_LONG}, {_variance_level('l0', 's0')} {_OUT.format(name='node')}",
    "best_split_variance_by_group": f"with {_LINE_LONG.format(y='l_extendedprice/1e5*10')}, "
                                    f"{_variance_level('l0', 's0')} {_OUT.format(name='l_returnflag')}",
    "best_split_gini": f"with {_LONG}, {_gini_level('l0', 's0')} {_OUT.format(name='node')}",
    "best_split_gini_by_group": "with " + _LINE_LONG.format(y="case when l_linestatus = 'O' then 1 else 0 end")
                                + f", {_gini_level('l0', 's0')} {_OUT.format(name='l_returnflag')}",
    "best_split_gini_many_classes": "with " + _LINE_LONG.format(y="l_orderkey") + f", {_gini_level('l0', 's0')} "
                                    + _OUT.format(name="l_returnflag"),
    "tree_regressor_fit": f"{_REG} {_NODES}",
    "tree_classifier_many_classes": f"{_MANY} {_NODES}",
    "tree_classifier_fit": f"{_CLS} {_NODES}",
    "tree_predict": f"{_REG} select z.id vec_id, round(t.\"value\", 6) + 0.0 prediction from z join t on z.node = t.heap",
    "tree_predict_class": f"{_CLS} select z.id vec_id, t.\"value\" prediction from z join t on z.node = t.heap",
    "gbt_fit": _boost_nodes(),
    "gbt_predict": _boost_scores(),
}
