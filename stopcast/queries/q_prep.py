"""Queries for row index, splits, sampling, cleaning and projections
(SURVEY §2.1, §2.2, §2.5 WN11/WN12, §2.6 SRT1, §2.11 VS1/VS2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.operators import cleaning as C
from stopcast.operators import headway as HW
from stopcast.operators import labels as L
from stopcast.operators import profiles as P
from stopcast.operators.rowindex import global_row_index, holdout_split, time_series_split
from stopcast.plans.training import clean_rf, rf_frame
from stopcast.queries.q_etl import LABEL_WIDTH, _HB, _JWL_SQL, _gtfs, _me, out
from stopcast.queries.q_history import _hist_sql, RF_SPECS
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, snap, with_
from stopcast.sources.sampling import systematic_sample

IDX = "(SELECT *, row_number() OVER (ORDER BY event_timestamp, event_id) - 1 AS row_idx, count(*) OVER () AS n FROM model_events)"


@query("global_row_index", with_(MODEL_EVENTS) + "\nSELECT event_id, row_number() OVER (ORDER BY event_timestamp, event_id) - 1 "
       "AS row_idx FROM model_events")
def q_global_row_index(spark, sf):
    """WN12 / G1: exact global position without a one-partition window."""
    return global_row_index(_me(spark, sf)).select("event_id", "row_idx")


@query("time_series_split", with_(MODEL_EVENTS) + f"""
SELECT event_id, row_idx,
  CAST(CASE WHEN row_idx >= n - 3 * (n // 4) THEN (row_idx - (n - 3 * (n // 4))) // (n // 4) ELSE -1 END AS BIGINT) AS fold,
  CAST(row_idx < n - n // 4 AS BIGINT) AS is_train, CAST(row_idx >= n - n // 4 AS BIGINT) AS is_test
FROM {IDX}""")
def q_time_series_split(spark, sf):
    """VS1: TimeSeriesSplit(3) folds; last fold = holdout."""
    return out(time_series_split(_me(spark, sf), 3).select("event_id", "row_idx", "fold", "is_train", "is_test"))


@query("holdout_80_20", with_(MODEL_EVENTS) + f"\nSELECT event_id, CAST(row_idx < floor(0.8 * n) AS BIGINT) AS is_train FROM {IDX}")
def q_holdout(spark, sf):
    """VS2: first 80 % train."""
    return out(holdout_split(_me(spark, sf), 0.8).select("event_id", "is_train"))


@query("systematic_sample", with_(MODEL_EVENTS) + f"""
SELECT event_id, row_idx FROM {IDX} WHERE n <= 1000 OR row_idx IN
  (SELECT DISTINCT CAST(floor(j * (n - 1) / 999) AS BIGINT) FROM (SELECT unnest(range(0, 1000)) AS j), (SELECT count(*) AS n FROM model_events))""")
def q_systematic_sample(spark, sf):
    """SRC6: 1000 evenly spaced rows in time order (sampling is the feature)."""
    df = global_row_index(_me(spark, sf))
    n = df.agg(F.count(F.lit(1))).scalar()
    return systematic_sample(df, 1000, n).select("event_id", "row_idx")


@query("train_only_aggs", with_(MODEL_EVENTS, f"s AS (SELECT *, CAST(row_idx < n - n // 4 AS INTEGER) AS is_train FROM {IDX})",
                                "a AS (SELECT gtfs_stop_id, avg(target) AS r, count(target) AS c FROM s WHERE is_train = 1 "
                                "GROUP BY gtfs_stop_id)") + f"""
SELECT s.event_id, {snap('a.r')} AS stop_train_rate, a.c AS stop_train_count FROM s LEFT JOIN a ON s.gtfs_stop_id = a.gtfs_stop_id
WHERE s.is_train = 0""")
def q_train_only_aggs(spark, sf):
    """WN11: per-stop target statistics learnt on the train part only,
    applied to the test part."""
    s = time_series_split(_me(spark, sf), 3)
    train = s.where("is_train = 1")
    a = train.groupBy("gtfs_stop_id").agg(F.avg("target").alias("stop_train_rate"),
                                          F.count("target").alias("stop_train_count"))
    return out(s.where("is_train = 0").join(a, "gtfs_stop_id", "left").select("event_id", "stop_train_rate", "stop_train_count"))


@query("sort_time", with_(MODEL_EVENTS) + "\nSELECT event_id, user_pseudo_id, target FROM model_events ORDER BY event_timestamp, event_id")
def q_sort_time(spark, sf):
    """SRT1: total order (range-partitioned sort)."""
    return out(_me(spark, sf).orderBy("event_timestamp", "event_id").select("event_id", "user_pseudo_id", "target"))


# ---------------------------------------------------------------- filters
@query("freq_quantile", with_(MODEL_EVENTS) + "\nSELECT event_id FROM model_events WHERE user_frequency >= "
       "(SELECT quantile_cont(user_frequency, 0.10) FROM model_events)")
def q_freq_quantile(spark, sf):
    """FLT1: user_frequency >= Q10."""
    return C.freq_quantile(_me(spark, sf), 0.10).select("event_id")


@query("freq_min", with_(MODEL_EVENTS) + "\nSELECT event_id FROM model_events WHERE user_frequency >= 2")
def q_freq_min(spark, sf):
    """FLT2."""
    return C.freq_min(_me(spark, sf), 2).select("event_id")


_COORDS = "NOT (device_lat IS NULL OR device_lon IS NULL) AND NOT (device_lat = 0 AND device_lon = 0)"


@query("coords_valid", with_(MODEL_EVENTS) + f"\nSELECT event_id FROM model_events WHERE {_COORDS}")
def q_coords_valid(spark, sf):
    """FLT3."""
    return C.coords_valid(_me(spark, sf)).select("event_id")


_KNN_CLEAN = with_(MODEL_EVENTS, "f1 AS (SELECT * FROM model_events WHERE user_frequency >= "
                   "(SELECT quantile_cont(user_frequency, 0.10) FROM model_events))",
                   f"f2 AS (SELECT * FROM f1 WHERE {_COORDS})")


@query("dist_quantile", _KNN_CLEAN + "\nSELECT event_id FROM f2 WHERE dist_device_stop <= "
       "(SELECT quantile_cont(dist_device_stop, 0.98) FROM f2)")
def q_dist_quantile(spark, sf):
    """FLT1 -> FLT3 -> FLT4 in sequence; Q98 taken on what is left."""
    from stopcast.plans.training import clean_knn
    return clean_knn(_me(spark, sf)).select("event_id")


@query("clean_report", _KNN_CLEAN + """,
q3 AS (SELECT quantile_cont(dist_device_stop, 0.98) AS q FROM f2),
c AS (SELECT (SELECT count(*) FROM model_events) AS n0, (SELECT count(*) FROM f1) AS n1, (SELECT count(*) FROM f2) AS n2,
             (SELECT count(*) FROM f2 WHERE dist_device_stop <= (SELECT q FROM q3)) AS n3)
SELECT * FROM (
  SELECT CAST(1 AS BIGINT) AS step_no, 'user_frequency>=Q10' AS step, n0 - n1 AS removed, """ + snap("100.0 * (n0 - n1) / n0") + """ AS removed_pct, n1 AS kept FROM c
  UNION ALL SELECT 2, 'coords_valid', n1 - n2, """ + snap("100.0 * (n1 - n2) / n1") + """, n2 FROM c
  UNION ALL SELECT 3, 'dist<=Q98', n2 - n3, """ + snap("100.0 * (n2 - n3) / n2") + """, n3 FROM c)""")
def q_clean_report(spark, sf):
    """FLT6: removed / kept per cumulative filter, one aggregate pass."""
    df = _me(spark, sf)
    q1 = C.quantile_scalar(df, "user_frequency", 0.10)
    p1 = F.col("user_frequency") >= q1
    p2 = C.coords_valid_pred()
    d2 = df.where(p1 & p2)
    p3 = F.col("dist_device_stop") <= C.quantile_scalar(d2, "dist_device_stop", 0.98)
    return out(C.clean_report(df, [("user_frequency>=Q10", p1), ("coords_valid", p2), ("dist<=Q98", p3)]))


_STOPFLT = _HB.replace("WITH ", "WITH " + MODEL_EVENTS.strip() + ",\n", 1) + """,
cnt AS (SELECT gtfs_stop_id, floor(epoch(event_timestamp) / 21600) AS b, count(DISTINCT user_pseudo_id) AS uc
        FROM model_events WHERE gtfs_stop_id IS NOT NULL GROUP BY ALL),
ev AS (SELECT e.event_id, e.gtfs_stop_id, coalesce(ha.headway_avg_stop_hour, 3600.0) AS hw,
              CASE WHEN c.uc = 1 THEN 'Baixa' WHEN c.uc > 1 THEN 'Nao_Baixa' END AS lbl
       FROM model_events e LEFT JOIN ha ON CAST(e.gtfs_stop_id AS VARCHAR) = ha.stop_id AND hour(e.event_timestamp) = ha.start_hour
       LEFT JOIN cnt c ON e.gtfs_stop_id = c.gtfs_stop_id AND floor(epoch(e.event_timestamp) / 21600) = c.b),
sa AS (SELECT gtfs_stop_id, sum(CASE WHEN lbl = 'Nao_Baixa' THEN 1 ELSE 0 END) AS sec FROM ev WHERE gtfs_stop_id IS NOT NULL GROUP BY ALL),
j AS (SELECT ev.*, sa.sec FROM ev LEFT JOIN sa ON ev.gtfs_stop_id = sa.gtfs_stop_id)
SELECT event_id FROM j WHERE sec >= (SELECT quantile_cont(sec, 0.10) FROM j) AND hw IS NOT NULL AND hw > 0 AND hw <= 3600"""


@query("stop_min_events", _STOPFLT)
def q_stop_min_events(spark, sf):
    """FLT5: stops with stop_event_count >= Q10 and a valid headway."""
    _, st, fr = _gtfs(spark, sf)
    df = HW.join_headway(cal.date_parts(_me(spark, sf), names={"hour": "time_hour"}), st, fr)
    df = P.join_stop_aggs(L.join_window_label(df, width=LABEL_WIDTH))
    return C.stop_min_events(df, 0.10).select("event_id")


@query("dropna_label", "SELECT event_id, lotacao_proxy_binaria FROM (" + _JWL_SQL + ") WHERE lotacao_proxy_binaria IS NOT NULL")
def q_dropna_label(spark, sf):
    """FLT7."""
    return C.dropna_label(L.join_window_label(_me(spark, sf), width=LABEL_WIDTH)).select("event_id", "lotacao_proxy_binaria")


_SPECIAL = ("CASE WHEN event_id % 7 = 0 THEN 'inf'::DOUBLE WHEN event_id % 11 = 0 THEN '-inf'::DOUBLE "
            "WHEN event_id % 13 = 0 THEN 'nan'::DOUBLE ELSE dist_device_stop END")


def _special(df):
    e = F.col("event_id")
    return df.withColumn("ratio", F.when(e % 7 == 0, F.lit(float("inf"))).when(e % 11 == 0, F.lit(float("-inf")))
                         .when(e % 13 == 0, F.lit(float("nan"))).otherwise(F.col("dist_device_stop")))


@query("inf_to_null", with_(MODEL_EVENTS) + f"""
SELECT event_id, {snap("CASE WHEN isnan(ratio) OR isinf(ratio) THEN NULL ELSE ratio END")} AS ratio
FROM (SELECT event_id, {_SPECIAL} AS ratio FROM model_events)""")
def q_inf_to_null(spark, sf):
    """FLT8: +-inf and NaN -> NULL."""
    return out(C.inf_to_null(_special(_me(spark, sf)).select("event_id", "ratio")))


@query("fill_null", with_(MODEL_EVENTS) + f"""
SELECT event_id, {snap('coalesce(dist_device_stop, 0)')} AS dist_device_stop, {snap('coalesce(device_lat, 0)')} AS device_lat,
       {snap('coalesce(device_lon, 0)')} AS device_lon FROM model_events""")
def q_fill_null(spark, sf):
    """FLT9: numeric NULL -> 0 (named defaults apply first when present)."""
    df = C.fill_null(_me(spark, sf), numeric_zero=True)
    return out(df.select("event_id", "dist_device_stop", "device_lat", "device_lon"))


_NR_COLS = ["event_id", "user_pseudo_id", "gtfs_stop_id", "target", "dist_device_stop", "device_lat", "device_lon",
            "stop_lat_event", "stop_lon_event", "user_frequency"]


_NR_NUM = {"event_id", "user_pseudo_id", "gtfs_stop_id", "target", "dist_device_stop", "device_lat", "device_lon",
           "stop_lat_event", "stop_lon_event", "user_frequency"}


def _nr_sql(stage: str, filled: bool) -> str:
    def isnull(c):
        return "FALSE" if (filled and c in _NR_NUM) else f"{c} IS NULL"
    cnt = "c AS (SELECT count(*) AS n, " + ", ".join(
        f"sum(CASE WHEN {isnull(c)} THEN 1 ELSE 0 END) AS n_{c}" for c in _NR_COLS) + " FROM model_events)"
    body = "\nUNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{c}' AS \"column\", CAST(n_{c} AS BIGINT) AS nulls, {snap(f'100.0 * n_{c} / n')} AS null_pct FROM c"
        for c in _NR_COLS)
    return f"SELECT * FROM (WITH {cnt} {body})"


@query("null_report", with_(MODEL_EVENTS) + "\n" + _nr_sql("before_fill", False) + "\nUNION ALL " + _nr_sql("after_fill", True))
def q_null_report(spark, sf):
    """FLT10: nulls and % per column before and after ``fillna(0)``, one
    aggregate pass each + stack."""
    d = _me(spark, sf).select(*_NR_COLS)
    before = C.null_report(d).withColumn("stage", F.lit("before_fill"))
    after = C.null_report(C.fill_null(d, {}, numeric_zero=True)).withColumn("stage", F.lit("after_fill"))
    return out(before.unionByName(after))


# ------------------------------------------------------------ projections
@query("sanitize_names", with_(MODEL_EVENTS) + f"\nSELECT event_id AS id0, CAST(target AS BIGINT) AS y_label, "
       f"{snap('dist_device_stop')} AS dist_m FROM model_events")
def q_sanitize_names(spark, sf):
    """PRJ4: column names cleaned for the boosting libraries."""
    df = _me(spark, sf).select(F.col("event_id").alias("id[0]"), F.col("target").alias("y:label"),
                               F.col("dist_device_stop").alias('dist,"m"'))
    return out(C.sanitize_names(df))


_NUMERIC = ["gtfs_route_id", "dist_device_stop", "device_lat", "device_lon", "stop_lat_event", "stop_lon_event", "user_frequency"]


@query("select_numeric", with_(MODEL_EVENTS) + "\nSELECT event_id, " + ", ".join(
    f"{c}" if c in ("gtfs_route_id", "user_frequency") else f"{snap(c)} AS {c}" for c in _NUMERIC) + " FROM model_events")
def q_select_numeric(spark, sf):
    """PRJ5: the numeric features of every event; target, ids, timestamps and text go."""
    df = _me(spark, sf).withColumns({"direction": F.lit("x"), "session_id": F.col("event_id") % 7, "int64_field_0": F.col("event_id")})
    return out(df.select("event_id", *C.select_numeric(df)))


@query("drop_categorical", with_(MODEL_EVENTS) + f"\nSELECT event_id, target, {snap('dist_device_stop')} AS dist_device_stop FROM model_events")
def q_drop_categorical(spark, sf):
    """PRJ6: string columns removed."""
    df = _me(spark, sf).select("event_id", F.col("user_pseudo_id").cast("string").alias("user_pseudo_id"),
                               F.lit("x").alias("direction"), "target", "dist_device_stop")
    return out(C.drop_categorical(df))


@query("cast_all_float", with_(MODEL_EVENTS) + f"""
SELECT event_id, CAST(gtfs_stop_id AS DOUBLE) AS gtfs_stop_id, CAST(user_frequency AS DOUBLE) AS user_frequency,
       {snap('dist_device_stop')} AS dist_device_stop, CAST(target AS BIGINT) AS target FROM model_events""")
def q_cast_all_float(spark, sf):
    """PRJ7: X -> double, y -> int."""
    df = _me(spark, sf).select("event_id", "gtfs_stop_id", "user_frequency", "dist_device_stop", "target")
    return out(C.cast_all_float(df, ["gtfs_stop_id", "user_frequency", "dist_device_stop"]))


@query("leak_guard", with_(MODEL_EVENTS) + "\nSELECT event_id, target, user_frequency FROM model_events")
def q_leak_guard(spark, sf):
    """PRJ8: target-derived columns removed (leaky profile joined first)."""
    df = cal.date_parts(_me(spark, sf), names={"hour": "time_hour"})
    df = P.profile_interactions(P.join_user_aggs(df, leaky=True))
    return out(C.leak_guard(df).select("event_id", "target", "user_frequency",
                                       *[c for c in C.LEAKY_COLUMNS if c in C.leak_guard(df).columns]))


# ------------------------------------------------------ leak-free frame (entry 2)
_RF_SQL = ("WITH hist AS (" + _hist_sql(RF_SPECS, 100, raw=True) + "),\n" + MODEL_EVENTS.strip() + """,
f AS (SELECT m.event_id, coalesce(m.user_frequency, 0) AS user_frequency, coalesce(m.device_lat, 0) AS device_lat,
             coalesce(m.device_lon, 0) AS device_lon, coalesce(m.dist_device_stop, 0) AS dist_device_stop,
             h.user_hist_conversion_rate, h.stop_hist_conversion_rate, h.user_recency_days, h.stop_recency_days
      FROM model_events m JOIN hist h ON m.event_id = h.event_id),
g AS (SELECT * FROM f WHERE user_frequency >= 2 AND NOT (device_lat = 0 AND device_lon = 0))
SELECT event_id, """ + snap("user_hist_conversion_rate * stop_hist_conversion_rate") + """ AS user_stop_interaction,
       """ + snap("exp(-user_recency_days / 7.0)") + """ AS user_recency_score,
       """ + snap("exp(-stop_recency_days / 7.0)") + """ AS stop_recency_score
FROM g WHERE dist_device_stop < (SELECT quantile_cont(dist_device_stop, 0.99) FROM g)""")


@query("leak_free_frame", _RF_SQL)
def q_leak_free_frame(spark, sf):
    """Entry 2 feature frame: history (warm-up 100) -> formulas -> fillna(0)
    -> user_frequency >= 2 -> coords -> dist < Q99."""
    df = clean_rf(rf_frame(_me(spark, sf)))
    return out(df.select("event_id", "user_stop_interaction", "user_recency_score", "stop_recency_score"))
