"""Remaining inventory keys: JN7 lookup_map, AG25 last_per_key, WN4 per
key, WN7 stop_hist_ext, MD7 per model type."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.operators import profiles as P
from stopcast.queries import q_history as QH
from stopcast.queries.q_etl import _me, out
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, snap, with_

LAST_COLS = ["dist_device_stop", "device_lat", "device_lon"]
_LAST_SQL = with_(MODEL_EVENTS) + "\nSELECT user_pseudo_id, " + ", ".join(
    f"{snap(f'arg_max({c}, (event_timestamp, event_id)) FILTER (WHERE {c} IS NOT NULL)')} AS {c}" for c in LAST_COLS) + \
    " FROM model_events WHERE user_pseudo_id IS NOT NULL GROUP BY user_pseudo_id"


@query("last_per_key", _LAST_SQL)
def q_last_per_key(spark, sf):
    """AG25: per user, the last non-NULL value of each column in time order."""
    return out(P.last_per_key(_me(spark, sf), "user_pseudo_id", LAST_COLS))


@query("lookup_map", "WITH l AS (" + _LAST_SQL.replace(snap("arg_max(dist_device_stop, (event_timestamp, event_id)) FILTER (WHERE dist_device_stop IS NOT NULL)"),
                                                        "arg_max(dist_device_stop, (event_timestamp, event_id)) FILTER (WHERE dist_device_stop IS NOT NULL)")
       + "), " + MODEL_EVENTS.strip() + f"""
SELECT m.event_id, {snap('coalesce(l.dist_device_stop, 0.0)')} AS dist_device_stop
FROM model_events m LEFT JOIN l ON m.user_pseudo_id = l.user_pseudo_id""")
def q_lookup_map(spark, sf):
    """JN7: key -> last known value (AG25) mapped onto every event, missing -> 0."""
    d = _me(spark, sf)
    last = P.last_per_key(d, "user_pseudo_id", ["dist_device_stop"])
    return out(P.lookup_map(d, last, "user_pseudo_id", ["dist_device_stop"]).select("event_id", "dist_device_stop"))


_U = [("user", "user_pseudo_id", True)]
_S = [("stop", "gtfs_stop_id", True)]
query("user_recency", QH._hist_sql(_U, 0))(QH._hist_query(_U, 0))
query("stop_recency", QH._hist_sql(_S, 0))(QH._hist_query(_S, 0))

_STOP_EXT = ["stop_hist_events", "stop_hist_conversions", "stop_hist_conversion_rate", "stop_avg_freq_hist"]


@query("stop_hist_ext", "SELECT event_id, " + ", ".join(_STOP_EXT) + " FROM (\n" + QH._KNN_SQL + "\n) t")
def q_stop_hist_ext(spark, sf):
    """WN7: prior events, conversions, rate and mean user_frequency per stop."""
    return QH.rounded(QH._knn_frame(spark, sf).select("event_id", *_STOP_EXT))


def _nb(kind):
    def run(spark, sf):
        from stopcast.operators import transforms as T
        from stopcast.plans import models as MD
        from stopcast.queries.q_models import training
        _, tr, te, feats = training(spark, sf)
        prep = {"gaussian": None, "multinomial": T.minmax_x100, "bernoulli": T.binarize_median}[kind]
        a, b = (tr, te) if prep is None else (prep(tr, feats, fit_on=tr), prep(te, feats, fit_on=tr))
        a = a.withColumns({c: F.col(c).cast("double") for c in feats})
        b = b.withColumns({c: F.col(c).cast("double") for c in feats})
        _, sc, _ = MD.fit_score(MD.naive_bayes(kind), a, b, feats)
        return sc
    run.__doc__ = f"MD7: {kind} naive Bayes (smoothing 1) score table on the holdout."
    return run


for _k in ("gaussian", "multinomial", "bernoulli"):
    query(f"{_k}_nb")(_nb(_k))
