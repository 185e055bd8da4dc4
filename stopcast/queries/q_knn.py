"""k-NN on scaled event features: the neighbours of
the newest fifth of the events among the older ones, the distance-weighted vote,
and every k with its best threshold."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.operators import knn as K
from stopcast.operators import metrics as M
from stopcast.operators.rowindex import holdout_split
from stopcast.queries.q_etl import _me, out
from stopcast.queries.q_eval import _metrics_cols
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, snap, with_
from stopcast.semantics import snap as snapped
from stopcast.session import materialize

FEATURES = {    # name -> (Spark expression, SQL); missing values count as 0
    "hour": ("hour(event_timestamp)", "hour(event_timestamp)"),
    "weekday": ("weekday(event_timestamp)", "isodow(event_timestamp) - 1"),
    "month_day": ("day(event_timestamp)", "day(event_timestamp)"),
    "dist": ("coalesce(dist_device_stop, 0)", "coalesce(dist_device_stop, 0)"),
    "freq": ("coalesce(user_frequency, 0)", "coalesce(user_frequency, 0)"),
    "lat": ("coalesce(device_lat, 0)", "coalesce(device_lat, 0)"),
    "lon": ("coalesce(device_lon, 0)", "coalesce(device_lon, 0)"),
    "stop_lat": ("coalesce(stop_lat_event, 0)", "coalesce(stop_lat_event, 0)"),
    "stop_lon": ("coalesce(stop_lon_event, 0)", "coalesce(stop_lon_event, 0)"),
    "route": ("coalesce(gtfs_route_id, 0)", "coalesce(gtfs_route_id, 0)"),
}
KS = [3, 5, 7, 11, 15, 21, 31]

_NEAR = with_(
    MODEL_EVENTS,
    "feats AS (SELECT event_id, target, row_number() OVER (ORDER BY event_timestamp, event_id) - 1 AS r, count(*) OVER () AS n, "
    + ", ".join(f"CAST({sql} AS DOUBLE) AS {f}" for f, (_, sql) in FEATURES.items()) + " FROM model_events)",
    "st AS (SELECT " + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURES) + " FROM feats WHERE r < floor(0.8 * n))",
    "z AS (SELECT event_id, target, r < floor(0.8 * n) AS old, " + ", ".join(
        snap(f"({f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END") + f" AS {f}" for f in FEATURES) + " FROM feats, st)",
    "pairs AS (SELECT q.event_id AS qid, t.event_id AS tid, t.target AS label, sqrt(" + " + ".join(
        f"(q.{f} - t.{f}) * (q.{f} - t.{f})" for f in FEATURES) + ") AS dist FROM z q, z t WHERE NOT q.old AND t.old)",
    f"""rk AS (SELECT qid, near.d AS dist, near.t AS tid, near.y AS label, row_number() OVER (PARTITION BY qid ORDER BY near.d, near.t) AS rank
         FROM (SELECT qid, unnest(min({{'d': dist, 't': tid, 'y': label}}, {max(KS)})) AS near FROM pairs GROUP BY qid))""")


def _vote(k: int) -> str:
    return (f"""SELECT qid, {snap('''CASE WHEN sum(CASE WHEN dist = 0 THEN 1 ELSE 0 END) > 0
      THEN sum(CASE WHEN dist = 0 THEN label ELSE 0 END) / sum(CASE WHEN dist = 0 THEN 1 ELSE 0 END)
      ELSE sum(CASE WHEN dist <> 0 THEN label / dist END) / sum(CASE WHEN dist <> 0 THEN 1.0 / dist END) END''')} AS score
  FROM rk WHERE rank <= {k} GROUP BY qid""")


def scaled_events(df):
    """(id, vec, label, is_train): features standardised by the older four fifths."""
    d = materialize(holdout_split(df, 0.8).select("event_id", F.col("target").alias("label"), "is_train", *[
        F.expr(e).cast("double").alias(f) for f, (e, _) in FEATURES.items()]))
    st = d.where("is_train = 1").agg(F.struct(*[x for f in FEATURES for x in (
        F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}"))]).alias("s")).scalar()
    scaled = [snapped((F.col(f) - st[f"m_{f}"]) / F.when(st[f"s_{f}"] == 0, 1.0).otherwise(st[f"s_{f}"])) for f in FEATURES]
    return d.select(F.col("event_id").alias("id"), F.array(*scaled).alias("vec"), "label", "is_train")


def event_neighbours(spark, sf, k, pairs=None):
    d = materialize(scaled_events(_me(spark, sf)))
    old, new = d.where("is_train = 1"), d.where("is_train = 0")
    return new, K.knn_join(new, old, k, carry=["label"], pairs=pairs)


@query("knn_events", _NEAR + f"\nSELECT qid, score FROM ({_vote(31)})")
def q_knn_events(spark, sf):
    """MD6: distance-weighted k = 31 vote of the older events for every new one."""
    _, near = event_neighbours(spark, sf, 31)
    return out(K.knn_scores(near, 31))


_GRID = ", ".join(f"({t / 100.0})" for t in M.GRID_KNN)
_SWEEP = (_NEAR + ",\nsc AS (" + "\nUNION ALL ".join(f"SELECT {k} AS k, v.qid, v.score, z.target AS label FROM ({_vote(k)}) v JOIN z ON z.event_id = v.qid"
                                                     for k in KS) + f"""),
auc AS (SELECT k, sum(pos * (2 * nb + neg)) / (sum(pos) * sum(neg) * 2.0) AS roc_auc FROM (
    SELECT *, coalesce(sum(neg) OVER (PARTITION BY k ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM (
      SELECT k, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg
      FROM sc GROUP BY k, score)) GROUP BY k),
grid AS (SELECT k, threshold, sum(CASE WHEN label <> 1 AND score < threshold THEN 1 ELSE 0 END) AS tn,
           sum(CASE WHEN label <> 1 AND score >= threshold THEN 1 ELSE 0 END) AS fp,
           sum(CASE WHEN label = 1 AND score < threshold THEN 1 ELSE 0 END) AS fn,
           sum(CASE WHEN label = 1 AND score >= threshold THEN 1 ELSE 0 END) AS tp
         FROM sc, (VALUES {_GRID}) g(threshold) GROUP BY k, threshold),
best AS (SELECT *, {_metrics_cols()} FROM grid QUALIFY row_number() OVER (PARTITION BY k ORDER BY f1_macro DESC, threshold) = 1)
SELECT CAST(best.k AS BIGINT) AS k, {snap('roc_auc')} AS roc_auc, {snap('threshold')} AS best_threshold, accuracy, precision, recall, f1, f1_macro
FROM best JOIN auc ON auc.k = best.k""")


@query("knn_events_sweep", _SWEEP)
def q_knn_events_sweep(spark, sf):
    """VS6: every k of the reference from one neighbour table, with its ROC-AUC and
    the threshold of the grid that has the best F1-macro."""
    new, near = event_neighbours(spark, sf, max(KS))
    sc = K.k_sweep_scores(near, KS).join(new.select(F.col("id").alias("qid"), "label"), "qid")
    sc = materialize(sc.select("k", "label", snapped("score").alias("score")))
    grid = M.grid_by(sc, "k", M.GRID_KNN)
    best = grid.groupBy("k").agg(F.max_by(F.struct("threshold", "accuracy", "precision", "recall", "f1", "f1_macro"),
                                          F.struct(snapped("f1_macro").alias("a"), (-F.col("threshold")).alias("b"))).alias("b"))
    auc = M.metrics_by(sc, "k").select("k", "roc_auc")
    return out(best.join(auc, "k").select(F.col("k").cast("long").alias("k"), "roc_auc", F.col("b.threshold").alias("best_threshold"),
                                          "b.accuracy", "b.precision", "b.recall", "b.f1", "b.f1_macro"))
