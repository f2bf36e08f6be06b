"""Queries for network training and scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from frameml.operators import neural as N
from frameml.workloads.common import CELLS, LINES, embeddings, rounded, scaled_lineitem

# Explicit start of the network queries, by rule.
INPUTS, HIDDEN, CLASSES = 64, 4, 10
LR = 0.5


def start_weights(n_in: int, n_out: int) -> np.ndarray:
    """((7 i + 3 k) % 11 - 5) / 10."""
    i, k = np.mgrid[0:n_in, 0:n_out]
    return ((7 * i + 3 * k) % 11 - 5) / 10


def start_network(outputs: int) -> N.Network:
    bias = lambda n: np.arange(n) / 20
    return N.Network((N.Layer("linear", start_weights(INPUTS, HIDDEN), bias(HIDDEN)), N.Layer("relu"),
                      N.Layer("linear", start_weights(HIDDEN, outputs), bias(outputs))))


def _weights(network, spark):
    rows = []
    for at, layer in enumerate(network.linear):
        rows += [(at, i, k, float(layer.w[i, k])) for i in range(layer.w.shape[0]) for k in range(layer.w.shape[1])]
        rows += [(at, -1, k, float(b)) for k, b in enumerate(layer.b)]
    return spark.createDataFrame(rows, "layer int, i int, k int, w double").select(
        "layer", "i", "k", rounded("w").alias("w"))


def _classifier(spark, folder):
    return N.mlp_fit(embeddings(spark, folder), ("embedding", INPUTS), "label", start_network(CLASSES), loss="ce", lr=LR)


def mlp_fit_cross_entropy(spark, folder):
    """Weights after one full-batch step; i = -1 marks a bias."""
    return _weights(_classifier(spark, folder), spark)


def _regressor(spark, folder):
    target = F.col("label") / 10
    return N.mlp_fit(embeddings(spark, folder), ("embedding", INPUTS), target, start_network(1), loss="mse", lr=LR)


def mlp_fit_squared_error(spark, folder):
    return _weights(_regressor(spark, folder), spark)


def mlp_predict(spark, folder):
    got = N.mlp_predict(embeddings(spark, folder), _regressor(spark, folder), ("embedding", INPUTS))
    return got.select("vec_id", rounded(F.col("out")[0]).alias("out"))


def mlp_predict_probabilities(spark, folder):
    rows = embeddings(spark, folder)
    got = N.mlp_predict(rows, start_network(CLASSES), ("embedding", INPUTS), probabilities=True)
    return got.select("vec_id", F.posexplode("out").alias("k", "p")).select(
        "vec_id", F.col("k").cast("long").alias("k"), rounded("p").alias("p"))


def mlp_train_adam(spark, folder):
    """Random start, dropout, hash batches, Adam: loss history."""
    rows = embeddings(spark, folder)
    net = N.mlp(INPUTS, [16, CLASSES], seed=5, hidden="tanh", dropout=0.2)
    model = N.mlp_fit(rows, ("embedding", INPUTS), "label", net, loss="ce", optimizer="adam", lr=0.01,
                      epochs=3, batches=2, id="vec_id", clip=1.0, seed=5)
    return model.history_df(spark)


# One layer on scaled lineitem, a few steps: start, rate and clip of the optimiser queries.
START, STEP_LR, CLIP, STEPS, MOMENTUM, BETAS = (0.1, 0.2, 0.3), 0.05, 0.4, 5, 0.9, (0.8, 0.99)


def _one_layer(spark, folder, **rule):
    net = N.Network((N.Layer("linear", np.array([[START[0]], [START[1]]]), np.array([START[2]])),))
    return _weights(N.mlp_fit(scaled_lineitem(spark, folder), ["q", "p"], "y", net, lr=STEP_LR, epochs=STEPS, clip=CLIP, **rule), spark)


def mlp_fit_momentum(spark, folder):
    """Five clipped full-batch steps with momentum."""
    return _one_layer(spark, folder, momentum=MOMENTUM)


def mlp_fit_adam(spark, folder):
    """Five clipped full-batch Adam steps with other betas than the default."""
    return _one_layer(spark, folder, optimizer="adam", betas=BETAS)


def mlp_predict_with_nulls(spark, folder):
    """Rows whose first feature is null score null."""
    rows = embeddings(spark, folder)
    x = F.when(F.col("label") % 3 == 0, F.concat(F.array(F.lit(None).cast("float")), F.slice("embedding", 2, INPUTS - 1)))
    got = N.mlp_predict(rows.withColumn("x", F.coalesce(x, "embedding")), start_network(1), ("x", INPUTS))
    return got.select("vec_id", rounded(F.col("out")[0]).alias("out"))


QUERIES = {
    "mlp_fit_momentum": mlp_fit_momentum, "mlp_fit_adam": mlp_fit_adam, "mlp_predict_with_nulls": mlp_predict_with_nulls,
    "mlp_fit_cross_entropy": mlp_fit_cross_entropy, "mlp_fit_squared_error": mlp_fit_squared_error,
    "mlp_predict": mlp_predict, "mlp_predict_probabilities": mlp_predict_probabilities,
    "mlp_train_adam": mlp_train_adam,
}


def _forward_sql(outputs: int) -> str:
    """h (hidden before and after relu) and o (outputs) of the start network."""
    return f"""with {CELLS}, n as (select count(*)::double n from embeddings),
w1 as (select i.range::int i, k.range::int k, ((7*i.range + 3*k.range) % 11 - 5)/10.0::double w
  from range(0, {INPUTS}) i, range(0, {HIDDEN}) k),
w2 as (select i.range::int i, k.range::int k, ((7*i.range + 3*k.range) % 11 - 5)/10.0::double w
  from range(0, {HIDDEN}) i, range(0, {outputs}) k),
h as (select a.i id, w1.k, greatest(sum(a.v*w1.w) + w1.k/20.0::double, 0) h from a join w1 on a.j = w1.i group by 1, 2),
o as (select h.id, w2.k, sum(h.h*w2.w) + w2.k/20.0::double o from h join w2 on h.k = w2.i group by 1, 2),
p as (select id, k, o, exp(o)/sum(exp(o)) over (partition by id) p from o)"""


def _step_sql(outputs: int, grad: str) -> str:
    """All parameters after one step against the mean gradient."""
    return f"""{_forward_sql(outputs)},
d2 as (select p.id, p.k, {grad} d from p join embeddings e on e.vec_id = p.id),
g2 as (select h.k i, d2.k, sum(h.h*d2.d) g from h join d2 using (id) group by 1, 2),
d1 as (select d2.id, w2.i k, case when any_value(h.h) > 0 then sum(d2.d*w2.w) else 0 end d
  from d2 join w2 on w2.k = d2.k join h on h.id = d2.id and h.k = w2.i group by 1, 2),
g1 as (select a.j i, d1.k, sum(a.v*d1.d) g from a join d1 on a.i = d1.id group by 1, 2),
u as (select 0 layer, w1.i, w1.k, w - {LR}*g/n w from w1 join g1 using (i, k), n
  union all select 1, w2.i, w2.k, w - {LR}*g/n from w2 join g2 using (i, k), n
  union all select 0, -1, k, k/20.0::double - {LR}*sum(d)/any_value(n) from d1, n group by k
  union all select 1, -1, k, k/20.0::double - {LR}*sum(d)/any_value(n) from d2, n group by k)"""


_CE_STEP = _step_sql(CLASSES, "p.p - (case when e.label = p.k then 1 else 0 end)")
_MSE_STEP = _step_sql(1, "2*(p.o - e.label/10.0::double)")
_WEIGHTS = "select layer::int layer, i::int i, k::int k, round(w, 6) + 0.0 w from u"

def _steps_sql(update: str) -> str:
    """Parameters w, moments m and v after STEPS rounds; ``update`` gives the new (m, v, change) from the clipped gradient g."""
    grads = ", ".join(f"greatest(least(avg(2*(w0*q+w1*p+w2-y){f}), {CLIP}), -{CLIP}) g{k}" for k, f in enumerate(("*q", "*p", "")))
    keep = ", ".join(f"any_value({c}{k}) {c}{k}" for c in "wmv" for k in range(3))
    new = ", ".join(update.format(k=k) for k in range(3))
    start = ", ".join(f"{v}::double w{k}, 0::double m{k}, 0::double v{k}" for k, v in enumerate(START))
    order = ", ".join(f"w{k}, m{k}, v{k}" for k in range(3))
    return f"""with recursive {LINES}, r(i, {order}) as (select 0, {start} union all
  select i + 1, {", ".join(f"w{k} + u{k}.d, u{k}.m, u{k}.v" for k in range(3))} from (select *, {new} from (
    select any_value(i) i, {keep}, {grads} from (select r.*, x.q, x.p, x.y from r, x where i < {STEPS}))) where i is not null)
select 0::int layer, i.k::int i, 0::int k, round(i.w, 6) + 0.0 w from (
  select unnest([0, 1, -1]) k, unnest([w0, w1, w2]) w from r where i = {STEPS}) i"""


_MOMENTUM_STEP = (f"{{{{'m': {MOMENTUM}*m{{k}} - {STEP_LR}*g{{k}}, 'v': 0::double, 'd': {MOMENTUM}*m{{k}} - {STEP_LR}*g{{k}}}}}} u{{k}}")
_M, _V = f"({BETAS[0]}*m{{k}} + (1-{BETAS[0]})*g{{k}})", f"({BETAS[1]}*v{{k}} + (1-{BETAS[1]})*g{{k}}*g{{k}})"
_ADAM_STEP = (f"{{{{'m': {_M}, 'v': {_V}, 'd': -{STEP_LR}*({_M}/(1-{BETAS[0]}**(i+1)))/(sqrt({_V}/(1-{BETAS[1]}**(i+1))) + 1e-8)}}}} u{{k}}")

SQL = {
    "mlp_fit_momentum": _steps_sql(_MOMENTUM_STEP),
    "mlp_fit_adam": _steps_sql(_ADAM_STEP),
    "mlp_predict_with_nulls": f"{_forward_sql(1)} select o.id vec_id, case when e.label % 3 <> 0 then round(o.o, 6) + 0.0 end "
                              "\"out\" from o join embeddings e on e.vec_id = o.id",
    "mlp_fit_cross_entropy": f"{_CE_STEP} {_WEIGHTS}",
    "mlp_fit_squared_error": f"{_MSE_STEP} {_WEIGHTS}",
    "mlp_predict": f"""{_MSE_STEP},
hh as (select a.i id, u.k, greatest(sum(a.v*u.w) + any_value(b.w), 0) h from a
  join u on u.layer = 0 and u.i = a.j join u b on b.layer = 0 and b.i = -1 and b.k = u.k group by 1, 2)
select hh.id vec_id, round(sum(hh.h*u.w) + any_value(b.w), 6) + 0.0 "out" from hh
  join u on u.layer = 1 and u.i = hh.k join u b on b.layer = 1 and b.i = -1 and b.k = u.k group by 1""",
    "mlp_predict_probabilities": f"{_forward_sql(CLASSES)} select id vec_id, k::bigint k, round(p, 6) + 0.0 p from p",
}
