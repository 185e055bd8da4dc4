"""Queries for the leak-free history operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.functions.calendar import date_parts
from stopcast.operators import history as H
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, snap, with_
from stopcast.semantics import rounded
from stopcast.sources.adapters import model_events

ORDER = "event_timestamp, event_id"
FRAME = f"ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _hist_sql(specs: list[tuple[str, str, bool]], warmup: int, raw: bool = False, extra: str = "") -> str:
    """Oracle for ``history_features``: plain SQL windows per key."""
    wins, sel, outs = [], [], []
    for p, key, rec in specs:
        wins.append(f"w_{p} AS (PARTITION BY {key} {FRAME})")
        sel.append(f"count(*) OVER w_{p} AS {p}_n, sum(target) OVER w_{p} AS {p}_pos, "
                   f"count(target) OVER w_{p} AS {p}_lab, max(event_timestamp) OVER w_{p} AS {p}_last")
        none = f"(rn <= {warmup} OR {key} IS NULL OR {p}_n = 0)"
        rate = f"CASE WHEN {none} THEN 0.0::DOUBLE ELSE coalesce({p}_pos / nullif({p}_lab, 0), 0.0::DOUBLE) END"
        outs.append((rate if raw else snap(rate))
                    + f" AS {p}_hist_conversion_rate")
        outs.append(f"CAST(CASE WHEN rn <= {warmup} OR {key} IS NULL THEN 0 ELSE {p}_n END AS BIGINT) AS {p}_hist_count")
        if rec:
            outs.append(f"CAST(CASE WHEN {none} THEN 999 ELSE floor((epoch_us(event_timestamp) - epoch_us({p}_last)) "
                        f"/ 86400000000) END AS BIGINT) AS {p}_recency_days")
    return (with_(MODEL_EVENTS,
                  f"o AS (SELECT *, row_number() OVER (ORDER BY {ORDER}) AS rn FROM model_events)",
                  f"h AS (SELECT *, {', '.join(sel)} FROM o WINDOW {', '.join(wins)})")
            + f"\nSELECT event_id, {extra}{', '.join(outs)} FROM h")


def _hist_query(specs, warmup):
    def run(spark, sf):
        df = model_events(spark, sf)
        out = H.history_features(df, specs, warmup=warmup)
        cols = ["event_id"]
        for p, _, rec in specs:
            cols += [f"{p}_hist_conversion_rate", f"{p}_hist_count"] + ([f"{p}_recency_days"] if rec else [])
        return rounded(out.select(*cols))
    return run


USER = ("user", "user_pseudo_id", False)
STOP = ("stop", "gtfs_stop_id", False)
LINE = ("line", "gtfs_route_id", False)
RF_SPECS = [("user", "user_pseudo_id", True), ("stop", "gtfs_stop_id", True), LINE]

query("user_hist", _hist_sql([USER], 0))(_hist_query([USER], 0))
query("stop_hist", _hist_sql([STOP], 0))(_hist_query([STOP], 0))
query("line_hist", _hist_sql([LINE], 0))(_hist_query([LINE], 0))
query("recency", _hist_sql([("user", "user_pseudo_id", True), ("stop", "gtfs_stop_id", True)], 0))(
    _hist_query([("user", "user_pseudo_id", True), ("stop", "gtfs_stop_id", True)], 0))
query("warmup", _hist_sql(RF_SPECS, H.WARMUP_ROWS))(_hist_query(RF_SPECS, H.WARMUP_ROWS))
query("hist_rates_basic", _hist_sql([USER, STOP], H.WARMUP_ROWS))(_hist_query([USER, STOP], H.WARMUP_ROWS))


# ---------------------------------------------------------------- WN6 / WN7
_KNN_SQL = with_(
    MODEL_EVENTS,
    f"o AS (SELECT *, hour(event_timestamp) AS hour, row_number() OVER (ORDER BY {ORDER}) AS rn FROM model_events)",
    f"""h AS (SELECT *,
        count(*) OVER wu AS u_n, sum(target) OVER wu AS u_pos, count(target) OVER wu AS u_lab,
        avg(hour) OVER wu AS u_hour, avg(dist_device_stop) OVER wu AS u_dist, stddev_samp(dist_device_stop) OVER wu AS u_std,
        count(*) OVER ws AS s_n, sum(target) OVER ws AS s_pos, count(target) OVER ws AS s_lab,
        avg(user_frequency) OVER ws AS s_freq
      FROM o WINDOW wu AS (PARTITION BY user_pseudo_id {FRAME}), ws AS (PARTITION BY gtfs_stop_id {FRAME}))""",
) + """
SELECT event_id,
  (floor((CASE WHEN rn <= 1 OR user_pseudo_id IS NULL OR u_n = 0 THEN 0.0::DOUBLE ELSE u_n::DOUBLE END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS user_hist_events,
  (floor((CASE WHEN rn <= 1 OR user_pseudo_id IS NULL OR u_n = 0 THEN 0.0::DOUBLE ELSE coalesce(u_pos, 0)::DOUBLE END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS user_hist_conversions,
  (floor((CASE WHEN rn <= 1 OR user_pseudo_id IS NULL OR u_n = 0 THEN 0.0::DOUBLE ELSE u_pos / nullif(u_lab, 0) END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS user_hist_conversion_rate,
  (floor((CASE WHEN rn <= 1 OR user_pseudo_id IS NULL OR u_n = 0 THEN 0.0::DOUBLE ELSE u_hour END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS user_avg_hour_hist,
  (floor((CASE WHEN rn <= 1 OR user_pseudo_id IS NULL OR u_n = 0 THEN 0.0::DOUBLE ELSE u_dist END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS user_avg_dist_hist,
  (floor((CASE WHEN rn <= 1 OR user_pseudo_id IS NULL OR u_n = 0 THEN 0.0::DOUBLE ELSE u_std END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS user_std_dist_hist,
  (floor((CASE WHEN rn <= 1 OR gtfs_stop_id IS NULL OR s_n = 0 THEN 0.0::DOUBLE ELSE s_n::DOUBLE END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS stop_hist_events,
  (floor((CASE WHEN rn <= 1 OR gtfs_stop_id IS NULL OR s_n = 0 THEN 0.0::DOUBLE ELSE coalesce(s_pos, 0)::DOUBLE END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS stop_hist_conversions,
  (floor((CASE WHEN rn <= 1 OR gtfs_stop_id IS NULL OR s_n = 0 THEN 0.0::DOUBLE ELSE s_pos / nullif(s_lab, 0) END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS stop_hist_conversion_rate,
  (floor((CASE WHEN rn <= 1 OR gtfs_stop_id IS NULL OR s_n = 0 THEN 0.0::DOUBLE ELSE s_freq END) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS stop_avg_freq_hist
FROM h"""

KNN_COLS = ["user_hist_events", "user_hist_conversions", "user_hist_conversion_rate", "user_avg_hour_hist",
            "user_avg_dist_hist", "user_std_dist_hist", "stop_hist_events", "stop_hist_conversions",
            "stop_hist_conversion_rate", "stop_avg_freq_hist"]


def _knn_frame(spark, sf):
    df = date_parts(model_events(spark, sf), names={"hour": "hour"})
    return H.knn_history(df)


@query("user_hist_ext", _KNN_SQL)
def q_user_hist_ext(spark, sf):
    """WN6 + WN7 (one query: the reference computes both in one loop)."""
    return rounded(_knn_frame(spark, sf).select("event_id", *KNN_COLS))


_LGBM_SQL = ("SELECT event_id, user_hist_conversion_rate AS user_conversion_rate_expanding, "
             "user_avg_hour_hist AS user_avg_hour_expanding, user_std_dist_hist AS user_std_dist_expanding, "
             "(floor(user_hist_events * stop_hist_events * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE) AS user_stop_affinity_expanding FROM (\n"
             + _KNN_SQL + "\n) t")


@query("expanding_lgbm", _LGBM_SQL)
def q_expanding_lgbm(spark, sf):
    df = date_parts(model_events(spark, sf), names={"hour": "hour"})
    out = H.lgbm_expanding(df)
    return rounded(out.select("event_id", "user_conversion_rate_expanding", "user_avg_hour_expanding",
                              "user_std_dist_expanding", "user_stop_affinity_expanding"))


@query("user_frequency", with_(MODEL_EVENTS) + "\nSELECT event_id, user_frequency FROM model_events")
def q_user_frequency(spark, sf):
    """WN9: events per user over the whole table."""
    return model_events(spark, sf).select("event_id", "user_frequency")
