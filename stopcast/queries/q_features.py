"""Queries for the feature formulas on history + per-stop statistics
(SURVEY §2.8 SC15-SC18, SC20, SC21, SC23-SC26, SC28)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.functions import features as FE
from stopcast.operators import history as H
from stopcast.operators import profiles as P
from stopcast.operators import transforms as T
from stopcast.queries.q_etl import _me, out
from stopcast.queries.q_history import RF_SPECS, _hist_sql, FRAME, ORDER
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, snap, with_


def frame(spark, sf):
    """model events + calendar + RF history (warm-up 100) + per-stop target
    statistics (stop_event_rate / count / total samples)."""
    d = cal.date_parts(_me(spark, sf), names={"hour": "hour", "day_of_week": "day_of_week"})
    d = H.rf_history(d)
    a = P.stop_label_stats_agg(d, label="target", event_value=1, dist="__none", headway="__none")
    d = d.join(a, "gtfs_stop_id", "left")
    d = d.withColumn("geo_distance", F.sqrt(F.pow(F.col("device_lat") - F.col("stop_lat_event"), 2)
                                            + F.pow(F.col("device_lon") - F.col("stop_lon_event"), 2)))
    return FE.with_rf_features(d)


FR = ("WITH hist AS (" + _hist_sql(RF_SPECS, 100, raw=True) + "),\n" + MODEL_EVENTS.strip() + """,
sa AS (SELECT gtfs_stop_id, sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) / count(*) AS stop_event_rate,
              sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS stop_event_count, count(target) AS stop_total_samples
       FROM model_events WHERE gtfs_stop_id IS NOT NULL GROUP BY gtfs_stop_id),
f AS (SELECT m.event_id, hour(m.event_timestamp) AS hour, CAST(isodow(m.event_timestamp) - 1 AS BIGINT) AS day_of_week,
             h.user_hist_conversion_rate, h.stop_hist_conversion_rate, h.line_hist_conversion_rate,
             h.user_hist_count, h.stop_hist_count, h.user_recency_days, h.stop_recency_days,
             sa.stop_event_rate, sa.stop_event_count, sa.stop_total_samples,
             sqrt(pow(m.device_lat - m.stop_lat_event, 2) + pow(m.device_lon - m.stop_lon_event, 2)) AS geo_distance,
             exp(-CAST(h.user_recency_days AS DOUBLE) / 7.0::DOUBLE) AS user_recency_score,
             exp(-CAST(h.stop_recency_days AS DOUBLE) / 7.0::DOUBLE) AS stop_recency_score
      FROM model_events m JOIN hist h ON m.event_id = h.event_id LEFT JOIN sa ON m.gtfs_stop_id = sa.gtfs_stop_id)""")


def _q(name: str, cols: dict[str, str], spark_cols, doc: str, prep=None):
    sql = FR + "\nSELECT event_id, " + ", ".join(f"{e} AS {n}" for n, e in cols.items()) + " FROM f"

    def run(spark, sf):
        d = frame(spark, sf)
        if prep:
            d = prep(d)
        return out(d.select("event_id", *spark_cols))
    run.__doc__ = doc
    query(name, sql)(run)


_q("recency_score", {"user_recency_score": snap("user_recency_score"), "stop_recency_score": snap("stop_recency_score")},
   ["user_recency_score", "stop_recency_score"], "SC15: exp(-days / 7) for user and stop.")
_q("recency_combo", {"combined_recency": "least(user_recency_days, stop_recency_days)",
                     "recency_ratio": snap("CAST(user_recency_days AS DOUBLE) / (stop_recency_days + 1)")},
   ["combined_recency", "recency_ratio"], "SC16: min(user, stop) recency; user / (stop + 1).", FE.with_scores)
_q("stop_ratios", {"stop_rate_per_sample": snap("stop_event_rate / (stop_total_samples + 1)"),
                   "stop_density": snap("stop_event_count / (stop_total_samples + 1)")},
   ["stop_rate_per_sample", "stop_density"], "SC17: rate / (samples + 1), count / (samples + 1).")
_q("poly_terms", {"stop_rate_squared": snap("stop_event_rate * stop_event_rate"), "stop_rate_log": snap("ln(1 + stop_event_rate)"),
                  "stop_rate_x_count": snap("stop_event_rate * stop_event_count"),
                  "user_stop_conv_product": snap("user_hist_conversion_rate * stop_hist_conversion_rate"),
                  "geo_distance_x_stop_rate": snap("geo_distance * stop_event_rate")},
   ["stop_rate_squared", "stop_rate_log", "stop_rate_x_count", "user_stop_conv_product", "geo_distance_x_stop_rate"],
   "SC18: polynomial and product terms of the top features.", FE.with_poly_terms)
_q("hist_interactions", {"user_stop_interaction": snap("user_hist_conversion_rate * stop_hist_conversion_rate"),
                         "user_line_interaction": snap("user_hist_conversion_rate * line_hist_conversion_rate"),
                         "stop_line_interaction": snap("stop_hist_conversion_rate * line_hist_conversion_rate")},
   ["user_stop_interaction", "user_line_interaction", "stop_line_interaction"], "SC20: products of history rates.")
_q("recency_x_rate", {"user_stop_recency_interaction": snap("user_recency_score * stop_event_rate")},
   ["user_stop_recency_interaction"], "SC23: user recency score x stop event rate.", FE.with_poly_terms)
_q("engagement_score", {"user_engagement_score": snap("ln(1 + user_hist_count) * user_hist_conversion_rate * user_recency_score")},
   ["user_engagement_score"], "SC24: ln(1 + count) x rate x recency score.", FE.with_scores)
_q("popularity_score", {"stop_popularity_score": snap("stop_event_rate * ln(1 + stop_total_samples) * ln(1 + stop_hist_count)")},
   ["stop_popularity_score"], "SC25: rate x ln(1 + samples) x ln(1 + history count).", FE.with_scores)
_q("recency_bin", {"user_recency_bin": "CAST(CASE WHEN user_recency_days > 0 AND user_recency_days <= 1 THEN 0 "
                                      "WHEN user_recency_days > 1 AND user_recency_days <= 3 THEN 1 "
                                      "WHEN user_recency_days > 3 AND user_recency_days <= 7 THEN 2 "
                                      "WHEN user_recency_days > 7 AND user_recency_days <= 30 THEN 3 "
                                      "WHEN user_recency_days > 30 AND user_recency_days <= 999 THEN 4 END AS BIGINT)"},
   ["user_recency_bin"], "SC28: recency bins [0,1,3,7,30,999] (right-closed).",
   lambda d: d.withColumn("user_recency_bin", cal.recency_bin("user_recency_days")))

_TIER = ("CASE WHEN x IS NULL OR x < e[1] OR x > list_max(e) THEN NULL WHEN x = e[1] THEN 0.0 "
         "ELSE CAST(len(list_filter(e, lambda v: v < x)) - 1 AS DOUBLE) END")
_TP = ("CASE WHEN hour > 0 AND hour <= 6 THEN 0.0 WHEN hour > 6 AND hour <= 9 THEN 1.0 WHEN hour > 9 AND hour <= 12 THEN 2.0 "
       "WHEN hour > 12 AND hour <= 14 THEN 3.0 WHEN hour > 14 AND hour <= 17 THEN 4.0 WHEN hour > 17 AND hour <= 19 THEN 5.0 "
       "WHEN hour > 19 AND hour <= 24 THEN 6.0 END")


@query("tier_cross", FR + """, g AS (SELECT *, stop_event_rate AS x FROM f),
ed AS (SELECT list_sort(list_distinct(quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM g)
SELECT event_id, """ + f"({_TIER}) * ({_TP}) AS stop_tier_x_time_period, ({_TIER}) * CAST(day_of_week >= 5 AS INTEGER) AS stop_tier_x_weekend"
       + " FROM g, ed")
def q_tier_cross(spark, sf):
    """SC26 (tier part): stop tier x time period, stop tier x weekend."""
    d = T.stop_tier(frame(spark, sf)).withColumn("is_weekend", cal.is_weekend("day_of_week"))
    d = FE.with_tier_cluster_cross(d)
    return out(d.select("event_id", "stop_tier_x_time_period", "stop_tier_x_weekend"))


_AFF = with_(MODEL_EVENTS, f"""h AS (SELECT *, count(*) OVER wu AS u_n, sum(target) OVER wu AS u_pos, count(target) OVER wu AS u_lab,
        avg(dist_device_stop) OVER wu AS u_dist, count(*) OVER ws AS s_n, sum(target) OVER ws AS s_pos, count(target) OVER ws AS s_lab,
        row_number() OVER (ORDER BY {ORDER}) AS rn
      FROM model_events WINDOW wu AS (PARTITION BY user_pseudo_id {FRAME}), ws AS (PARTITION BY gtfs_stop_id {FRAME}))""",
             """k AS (SELECT event_id, dist_device_stop,
        CASE WHEN rn <= 1 OR u_n = 0 THEN 0.0 ELSE u_pos / nullif(u_lab, 0) END AS ur,
        CASE WHEN rn <= 1 OR s_n = 0 THEN 0.0 ELSE s_pos / nullif(s_lab, 0) END AS sr,
        CASE WHEN rn <= 1 OR u_n = 0 THEN 0.0 ELSE u_n END AS ue, CASE WHEN rn <= 1 OR s_n = 0 THEN 0.0 ELSE s_n END AS se,
        CASE WHEN rn <= 1 OR u_n = 0 THEN 0.0 ELSE u_dist END AS ud FROM h)""")


@query("hist_affinity", _AFF + f"""
SELECT event_id, {snap('ur * sr')} AS hist_interaction, {snap('ue * se')} AS user_stop_hist_affinity,
       {snap('abs(dist_device_stop - ud)')} AS dist_deviation_hist, {snap('dist_device_stop / (ud + 1)')} AS dist_ratio_hist FROM k""")
def q_hist_affinity(spark, sf):
    """SC21: k-NN history interactions (rate product, events product,
    distance deviation and ratio to the user's history mean)."""
    d = cal.date_parts(_me(spark, sf), names={"hour": "hour"})
    d = FE.with_hist_affinity(H.knn_history(d))
    return out(d.select("event_id", "hist_interaction", "user_stop_hist_affinity", "dist_deviation_hist", "dist_ratio_hist"))
