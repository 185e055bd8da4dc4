"""Queries for the ETL operators: sources, scalars, joins, labels, headway,
per-stop/user aggregates (SURVEY §2.1-2.4, §2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.functions import features as FE
from stopcast.functions.geo import euclid_deg, geodesic_m, haversine_m, parse_point, quadrant
from stopcast.functions.holidays import is_holiday
from stopcast.operators import cleaning as C
from stopcast.operators import headway as HW
from stopcast.operators import labels as L
from stopcast.operators import profiles as P
from stopcast.operators.nearest import nearest_join
from stopcast.plans.etl import build_features, calendar_features, parse_points
from stopcast.queries.registry import query
from stopcast.queries.sql import (FREQUENCIES, MODEL_EVENTS, RAW_EVENTS, STOP_TIMES, STOPS, geodesic_sql, point_lat,
                                  point_lon, snap, with_)
from stopcast.semantics import rounded
from stopcast.sources import adapters as A

TZ = "America/Sao_Paulo"
LABEL_WIDTH = "6 hours"      # SURVEY §7.4: the 2-minute bins of the reference are almost all single-user here


def _me(spark, sf):
    return A.model_events(spark, sf)


def _raw(spark, sf):
    return A.raw_events(spark, sf)


def _gtfs(spark, sf):
    return A.gtfs_stops(spark, sf), A.gtfs_stop_times(spark, sf), A.gtfs_frequencies(spark, sf)


def _long(df):
    """Integer columns -> bigint (one integer type for the comparison)."""
    from pyspark.sql.types import ByteType, IntegerType, ShortType
    return df.select(*[F.col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, (ByteType, ShortType, IntegerType))
                       else F.col(f.name) for f in df.schema.fields])


def out(df):
    return _long(rounded(df))


# ----------------------------------------------------------------- sources
@query("scan_limit", with_(MODEL_EVENTS) + "\nSELECT event_id, user_pseudo_id, target FROM model_events "
       "ORDER BY event_timestamp, event_id LIMIT 5000")
def q_scan_limit(spark, sf):
    """SRC1: ``SELECT * ... LIMIT n`` made deterministic by ordering first
    (top-n, ``TakeOrderedAndProject``); the limit is the feature."""
    from stopcast.sources.sampling import scan_limit
    return out(scan_limit(_me(spark, sf), 5000).select("event_id", "user_pseudo_id", "target"))


@query("scan_tablesample", with_(MODEL_EVENTS) + "\nSELECT event_id, target FROM model_events "
       "WHERE substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8) < '33333333'")
def q_scan_tablesample(spark, sf):
    """SRC2: reproducible 20 % sample by hash of (seed, id)."""
    from stopcast.sources.sampling import hash_sample
    return out(hash_sample(_me(spark, sf), 0.2, seed=42).select("event_id", "target"))


@query("cast_coords", with_(STOPS) + f"\nSELECT stop_id, {snap('CAST(stop_lat AS DOUBLE)')} AS stop_lat, "
       f"{snap('CAST(stop_lon AS DOUBLE)')} AS stop_lon FROM stops")
def q_cast_coords(spark, sf):
    """SRC5: GTFS string coordinates -> double (ANSI cast raises on garbage)."""
    s = A.gtfs_stops(spark, sf)
    return out(s.select("stop_id", F.col("stop_lat").cast("double").alias("stop_lat"),
                        F.col("stop_lon").cast("double").alias("stop_lon")))


# ----------------------------------------------------------- projections
@query("filter_event", with_(RAW_EVENTS) + "\nSELECT event_id, event_name FROM raw_events WHERE event_name = 'bstop_open'")
def q_filter_event(spark, sf):
    return C.filter_event(_raw(spark, sf)).select("event_id", "event_name")


@query("drop_existing", with_(RAW_EVENTS) + "\nSELECT event_id, user_pseudo_id, device_point, ctm_stop_point "
       "FROM raw_events")
def q_drop_existing(spark, sf):
    return C.drop_existing(_raw(spark, sf)).drop("event_timestamp")


@query("rename", with_(MODEL_EVENTS) + "\nSELECT event_id, gtfs_stop_id AS stop_id, time_bin FROM "
       "(SELECT event_id, gtfs_stop_id, strftime(to_timestamp(floor(epoch(event_timestamp) / 120) * 120), "
       "'%Y-%m-%d %H:%M:%S') AS time_bin FROM model_events)")
def q_rename(spark, sf):
    """PRJ3: rename after computing (event_timestamp floor -> time_bin, stop)."""
    df = _me(spark, sf).withColumn("event_timestamp", F.date_format(L.time_floor("event_timestamp"), "yyyy-MM-dd HH:mm:ss"))
    return out(C.rename(df, {"event_timestamp": "time_bin", "gtfs_stop_id": "stop_id"}).select("event_id", "stop_id", "time_bin"))


# ----------------------------------------------------------------- scalars
@query("parse_point", with_(RAW_EVENTS) + f"""
SELECT event_id, {snap(point_lat('device_point'))} AS device_lat, {snap(point_lon('device_point'))} AS device_lon,
       {snap(point_lat('ctm_stop_point'))} AS stop_lat_event, {snap(point_lon('ctm_stop_point'))} AS stop_lon_event
FROM raw_events""")
def q_parse_point(spark, sf):
    """SC1: POINT text -> lat/lon; NULL and garbage -> NULL."""
    return out(parse_points(_raw(spark, sf)).select("event_id", "device_lat", "device_lon", "stop_lat_event", "stop_lon_event"))


_HAV = ("2 * 6371008.8::DOUBLE * asin(sqrt(least(pow(sin((radians(slat) - radians(dlat)) / 2), 2) + "
        "cos(radians(dlat)) * cos(radians(slat)) * pow(sin((radians(slon) - radians(dlon)) / 2), 2), 1.0::DOUBLE)))")


@query("haversine_m", with_(RAW_EVENTS) + f"""
SELECT event_id, {snap(_HAV)} AS dist_haversine FROM (
  SELECT event_id, {point_lat('device_point')} AS dlat, {point_lon('device_point')} AS dlon,
         {point_lat('ctm_stop_point')} AS slat, {point_lon('ctm_stop_point')} AS slon FROM raw_events)""")
def q_haversine(spark, sf):
    """SC2 (pure-column variant): spherical metres device <-> stop."""
    df = parse_points(_raw(spark, sf))
    return out(df.select("event_id", haversine_m("device_lat", "device_lon", "stop_lat_event", "stop_lon_event")
                         .alias("dist_haversine")))


_PTS = ("(SELECT event_id, " + point_lat("device_point") + " AS dlat, " + point_lon("device_point") + " AS dlon, "
        + point_lat("ctm_stop_point") + " AS slat, " + point_lon("ctm_stop_point") + " AS slon FROM raw_events)")


@query("geodesic_m", with_(RAW_EVENTS) + f"""
SELECT p.event_id, {snap('g.dist')} AS dist_device_stop FROM {_PTS} p
LEFT JOIN {geodesic_sql(_PTS, 'event_id', 'dlat', 'dlon', 'slat', 'slon')} g ON p.event_id = g.gid""")
def q_geodesic(spark, sf):
    """SC2: WGS-84 ellipsoidal metres (vectorised Arrow UDF, fixed-pass Vincenty)."""
    df = parse_points(_raw(spark, sf))
    return out(df.select("event_id", geodesic_m("device_lat", "device_lon", "stop_lat_event", "stop_lon_event")
                         .alias("dist_device_stop")))


@query("geo_distance", with_(MODEL_EVENTS) + f"""
SELECT event_id, {snap('sqrt(pow(device_lat - stop_lat_event, 2) + pow(device_lon - stop_lon_event, 2))')} AS geo_distance
FROM model_events""")
def q_geo_distance(spark, sf):
    """SC3: Euclidean degrees device <-> stop."""
    return out(_me(spark, sf).select("event_id", euclid_deg("device_lat", "device_lon", "stop_lat_event",
                                                            "stop_lon_event").alias("geo_distance")))


@query("tz_convert", with_(RAW_EVENTS) + """
SELECT event_id, strftime(timezone('America/Sao_Paulo', timezone('UTC', event_timestamp)), '%Y-%m-%d %H:%M:%S') AS local_ts,
       hour(timezone('America/Sao_Paulo', timezone('UTC', event_timestamp))) AS local_hour
FROM raw_events""")
def q_tz_convert(spark, sf):
    """SC4: UTC -> America/Sao_Paulo wall time."""
    t = cal.tz_convert("event_timestamp", TZ)
    return out(_raw(spark, sf).select("event_id", F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("local_ts"),
                                      F.hour(t).alias("local_hour")))


@query("date_parts", with_(MODEL_EVENTS) + """
SELECT event_id, hour(event_timestamp) AS hour, CAST(isodow(event_timestamp) - 1 AS BIGINT) AS day_of_week,
       day(event_timestamp) AS day_of_month, month(event_timestamp) AS month, year(event_timestamp) AS year,
       minute(event_timestamp) AS minute, weekofyear(event_timestamp) AS week_of_year,
       dayname(event_timestamp) AS day_name, strftime(event_timestamp, '%Y-%m-%d') AS date
FROM model_events""")
def q_date_parts(spark, sf):
    """SC5: hour, weekday (Mon=0), day, month, year, minute, ISO week, day name, date."""
    df = cal.date_parts(_me(spark, sf))
    return out(df.select("event_id", "hour", "day_of_week", "day_of_month", "month", "year", "minute", "week_of_year",
                         "day_name", F.date_format("date", "yyyy-MM-dd").alias("date")))


@query("time_floor", with_(MODEL_EVENTS) + """
SELECT event_id, strftime(to_timestamp(floor(epoch(event_timestamp) / 120) * 120), '%Y-%m-%d %H:%M:%S') AS time_bin
FROM model_events""")
def q_time_floor(spark, sf):
    """SC6: floor to 2 minutes."""
    return _me(spark, sf).select("event_id", F.date_format(L.time_floor("event_timestamp", "2 minutes"),
                                                           "yyyy-MM-dd HH:mm:ss").alias("time_bin"))


# one-expression scalar queries over (hour h, weekday d, month m, day dd, iso week w) of model_events
_HD = ("(SELECT *, hour(event_timestamp) AS h, CAST(isodow(event_timestamp) - 1 AS BIGINT) AS d, "
       "month(event_timestamp) AS m, day(event_timestamp) AS dd, weekofyear(event_timestamp) AS w FROM model_events)")


def _hd(df):
    return cal.date_parts(df, names={"hour": "h", "day_of_week": "d", "month": "m", "day_of_month": "dd",
                                     "week_of_year": "w"})


def _scalar_query(name: str, sql_cols: dict[str, str], spark_cols, doc: str):
    sql = with_(MODEL_EVENTS) + "\nSELECT event_id, " + ", ".join(f"{e} AS {n}" for n, e in sql_cols.items()) + f" FROM {_HD}"

    def run(spark, sf):
        df = _hd(_me(spark, sf))
        return out(df.select("event_id", *[e.alias(n) for n, e in spark_cols().items()]))
    run.__doc__ = doc
    query(name, sql)(run)


_scalar_query("is_weekend", {"is_weekend": "CAST(d >= 5 AS BIGINT)"}, lambda: {"is_weekend": cal.is_weekend("d")},
              "SC7: weekday >= 5.")
_scalar_query("is_peak_hour", {"is_peak_hour": "CAST((h >= 6 AND h < 9) OR (h >= 17 AND h < 19) AS BIGINT)"},
              lambda: {"is_peak_hour": cal.is_peak_hour("h")}, "SC8: 6<=h<9 or 17<=h<19.")
_scalar_query("period_flags", {
    "is_morning_peak": "CAST(h BETWEEN 6 AND 9 AS BIGINT)", "is_evening_peak": "CAST(h BETWEEN 17 AND 19 AS BIGINT)",
    "is_lunch_time": "CAST(h BETWEEN 11 AND 14 AS BIGINT)", "is_night": "CAST(h >= 22 OR h <= 5 AS BIGINT)"},
    lambda: cal.period_flags("h"), "SC9: morning / evening / lunch / night flags.")
_scalar_query("cyclic", {
    **{f"{p}_{fn}": snap(f"{fn}(2 * pi() * {c} / {per})") for p, c, per in
       (("hour", "h", 24), ("day", "d", 7), ("month", "m", 12), ("day_of_month", "dd", 31), ("week", "w", 52))
       for fn in ("sin", "cos")}},
    lambda: {f"{p}_{fn}": cal.cyclic(c, per)[i] for p, c, per in
             (("hour", "h", 24), ("day", "d", 7), ("month", "m", 12), ("day_of_month", "dd", 31), ("week", "w", 52))
             for i, fn in enumerate(("sin", "cos"))},
    "SC10: sin/cos of 2*pi*x/P for hour, weekday, month, day of month, ISO week.")
_scalar_query("time_period", {"time_period": "CASE WHEN h > 0 AND h <= 6 THEN 0.0 WHEN h > 6 AND h <= 9 THEN 1.0 "
                                             "WHEN h > 9 AND h <= 12 THEN 2.0 WHEN h > 12 AND h <= 14 THEN 3.0 "
                                             "WHEN h > 14 AND h <= 17 THEN 4.0 WHEN h > 17 AND h <= 19 THEN 5.0 "
                                             "WHEN h > 19 AND h <= 24 THEN 6.0 END::DOUBLE"},
              lambda: {"time_period": cal.time_period("h")}, "SC11: right-closed hour bins; hour 0 -> NULL.")
_scalar_query("distance_from_peak", {"distance_from_peak": "least(abs(h - 8), abs(h - 18))"},
              lambda: {"distance_from_peak": cal.distance_from_peak("h")}, "SC13: min(|h-8|, |h-18|).")
_scalar_query("hour_weekday", {"hour_weekday_interaction": "h * d"},
              lambda: {"hour_weekday_interaction": F.col("h") * F.col("d")}, "SC14: hour x weekday.")
_scalar_query("weekend_peak", {"weekend_peak": "CAST(d >= 5 AND ((h >= 6 AND h < 9) OR (h >= 17 AND h < 19)) AS BIGINT)"},
              lambda: {"weekend_peak": cal.weekend_peak("d", "h")}, "SC28: weekend and peak.")
_scalar_query("quadrants", {
    "lat_quadrant": "CASE WHEN device_lat IS NULL THEN NULL WHEN device_lat < -23.60 THEN 0 WHEN device_lat >= -23.50 THEN 5 "
                    "ELSE CAST(floor(4 * (device_lat - -23.60::DOUBLE) / (-23.50::DOUBLE - -23.60::DOUBLE)) AS BIGINT) + 1 END - 1",
    "lon_quadrant": "CASE WHEN device_lon IS NULL THEN NULL WHEN device_lon < -46.70 THEN 0 WHEN device_lon >= -46.60 THEN 5 "
                    "ELSE CAST(floor(4 * (device_lon - -46.70::DOUBLE) / (-46.60::DOUBLE - -46.70::DOUBLE)) AS BIGINT) + 1 END - 1"},
    lambda: {"lat_quadrant": quadrant("device_lat", -23.60, -23.50), "lon_quadrant": quadrant("device_lon", -46.70, -46.60)},
    "SC28: 4 equal-width latitude / longitude bins of the device position.")


@query("split_hour", with_(FREQUENCIES) + "\nSELECT trip_id, start_time, CAST(split_part(start_time, ':', 1) AS BIGINT) "
       "AS start_hour FROM frequencies")
def q_split_hour(spark, sf):
    """SC27: 'HH:MM:SS' -> hour."""
    return out(A.gtfs_frequencies(spark, sf).select("trip_id", "start_time", HW.split_hour("start_time").alias("start_hour")))


# ------------------------------------------------------------------ joins
_NEAREST_SQL = with_(RAW_EVENTS, STOPS, f"""
ev AS (SELECT event_id, {point_lat('ctm_stop_point')} AS lat, {point_lon('ctm_stop_point')} AS lon FROM raw_events)""",
                     """
st AS (SELECT stop_id, CAST(stop_lat AS DOUBLE) AS slat, CAST(stop_lon AS DOUBLE) AS slon FROM stops)""", """
c AS (SELECT e.event_id, s.stop_id, row_number() OVER (PARTITION BY e.event_id
        ORDER BY (s.slat - e.lat) * (s.slat - e.lat) + (s.slon - e.lon) * (s.slon - e.lon), s.stop_id) AS r
      FROM ev e, st s WHERE e.lat IS NOT NULL AND e.lon IS NOT NULL)""") + """
SELECT ev.event_id, c.stop_id AS gtfs_stop_id FROM ev LEFT JOIN c ON ev.event_id = c.event_id AND c.r = 1"""


@query("nearest_stop", _NEAREST_SQL)
def q_nearest_stop(spark, sf):
    """JN1: nearest GTFS stop of the event's stop point (grid join, exact)."""
    df = parse_points(_raw(spark, sf))
    stops = A.gtfs_stops(spark, sf)
    return nearest_join(df, stops, lat="stop_lat_event", lon="stop_lon_event", out="gtfs_stop_id").select(
        "event_id", "gtfs_stop_id")


_NEAREST_DEV_SQL = _NEAREST_SQL.replace(point_lat("ctm_stop_point"), point_lat("device_point")).replace(
    point_lon("ctm_stop_point"), point_lon("device_point"))


@query("nearest_stop_device", _NEAREST_DEV_SQL)
def q_nearest_stop_device(spark, sf):
    """JN1 on the device position (points off the stop grid, real ties and
    cell-boundary cases)."""
    df = parse_points(_raw(spark, sf))
    stops = A.gtfs_stops(spark, sf)
    return nearest_join(df, stops, lat="device_lat", lon="device_lon", out="gtfs_stop_id").select("event_id", "gtfs_stop_id")


def _bin_sql(width_s: int) -> str:
    return f"strftime(to_timestamp(floor(epoch(event_timestamp) / {width_s}) * {width_s}), '%Y-%m-%d %H:%M:%S')"


@query("users_per_bin", with_(MODEL_EVENTS) + f"""
SELECT gtfs_stop_id, {_bin_sql(120)} AS time_bin, count(DISTINCT user_pseudo_id) AS user_count
FROM model_events WHERE gtfs_stop_id IS NOT NULL GROUP BY ALL""")
def q_users_per_bin(spark, sf):
    """AG1: distinct users per (stop, 2-minute bin)."""
    r = L.users_per_bin(_me(spark, sf), width="2 minutes")
    return out(r.withColumn("time_bin", F.date_format("time_bin", "yyyy-MM-dd HH:mm:ss")))


_LABEL_CLASS = ("CASE WHEN user_count > 0 AND user_count <= 1 THEN 'Baixa' WHEN user_count > 1 AND user_count <= 2 "
                "THEN 'Média' WHEN user_count > 2 THEN 'Alta' END")


@query("crowding_class", with_(MODEL_EVENTS) + f"""
SELECT lotacao_proxy, count(*) AS n_cells FROM (
  SELECT {_LABEL_CLASS} AS lotacao_proxy FROM (
    SELECT gtfs_stop_id, {_bin_sql(21600)} AS b, count(DISTINCT user_pseudo_id) AS user_count
    FROM model_events WHERE gtfs_stop_id IS NOT NULL GROUP BY ALL)) GROUP BY ALL""")
def q_crowding_class(spark, sf):
    """SC12: classes of (stop, 6-hour bin) cells."""
    c = L.users_per_bin(_me(spark, sf), width=LABEL_WIDTH)
    return c.groupBy(L.crowding_class("user_count").alias("lotacao_proxy")).agg(F.count(F.lit(1)).alias("n_cells"))


_JWL_SQL = with_(MODEL_EVENTS, f"""
cnt AS (SELECT gtfs_stop_id, floor(epoch(event_timestamp) / 21600) AS b, count(DISTINCT user_pseudo_id) AS user_count
        FROM model_events WHERE gtfs_stop_id IS NOT NULL GROUP BY ALL)""") + f"""
SELECT e.event_id, {_LABEL_CLASS} AS lotacao_proxy,
       CASE WHEN user_count = 1 THEN 'Baixa' WHEN user_count > 1 THEN 'Nao_Baixa' END AS lotacao_proxy_binaria
FROM model_events e LEFT JOIN cnt c ON e.gtfs_stop_id = c.gtfs_stop_id AND floor(epoch(e.event_timestamp) / 21600) = c.b"""


@query("join_window_label", _JWL_SQL)
def q_join_window_label(spark, sf):
    """JN2 (+ SC12, JN9): each event gets its (stop, 6-hour bin) crowding label."""
    return L.join_window_label(_me(spark, sf), width=LABEL_WIDTH).select("event_id", "lotacao_proxy", "lotacao_proxy_binaria")


@query("join_window_label_2min", _JWL_SQL.replace("21600", "120"))
def q_join_window_label_2min(spark, sf):
    """JN2 at the reference's own width of 2 minutes."""
    return L.join_window_label(_me(spark, sf), width="2 minutes").select("event_id", "lotacao_proxy", "lotacao_proxy_binaria")


@query("map_values", "SELECT lotacao_proxy_binaria, target, count(*) AS n FROM (SELECT lotacao_proxy_binaria, "
       "CASE WHEN lotacao_proxy_binaria = 'Baixa' THEN 0 WHEN lotacao_proxy_binaria = 'Nao_Baixa' THEN 1 END::BIGINT AS target "
       "FROM (" + _JWL_SQL + ")) GROUP BY ALL")
def q_map_values(spark, sf):
    """JN9: label name -> 0/1 (by dictionary)."""
    j = L.join_window_label(_me(spark, sf), width=LABEL_WIDTH)
    r = j.select("lotacao_proxy_binaria", L.binary_target("lotacao_proxy_binaria").cast("long").alias("target"))
    return r.groupBy("lotacao_proxy_binaria", "target").agg(F.count(F.lit(1)).alias("n"))


_HB = with_(STOP_TIMES, FREQUENCIES, """
hb AS (SELECT st.stop_id, st.trip_id, f.start_time, CAST(split_part(f.start_time, ':', 1) AS INTEGER) AS start_hour,
              CAST(f.headway_secs AS DOUBLE) AS headway_secs
       FROM stop_times st JOIN frequencies f ON st.trip_id = f.trip_id)""", """
dd AS (SELECT stop_id, start_hour, trip_id, arg_min(headway_secs, start_time) AS headway_secs FROM hb GROUP BY ALL)""", """
ha AS (SELECT stop_id, start_hour, avg(headway_secs) AS headway_avg_stop_hour FROM dd GROUP BY ALL)""")


@query("headway_base", _HB + "\nSELECT stop_id, trip_id, start_time, CAST(start_hour AS BIGINT) AS start_hour, headway_secs FROM hb")
def q_headway_base(spark, sf):
    """JN3: stop_times x frequencies on trip_id."""
    _, st, fr = _gtfs(spark, sf)
    return out(HW.headway_base(st, fr).select("stop_id", "trip_id", "start_time", "start_hour", "headway_secs"))


@query("dedupe", _HB + "\nSELECT stop_id, CAST(start_hour AS BIGINT) AS start_hour, trip_id, headway_secs FROM dd")
def q_dedupe(spark, sf):
    """AG6: one row per (stop, hour, trip), earliest start_time."""
    _, st, fr = _gtfs(spark, sf)
    return out(HW.dedupe(HW.headway_base(st, fr)))


@query("headway_avg", _HB + f"\nSELECT stop_id, CAST(start_hour AS BIGINT) AS start_hour, "
       f"{snap('headway_avg_stop_hour')} AS headway_avg_stop_hour FROM ha")
def q_headway_avg(spark, sf):
    """AG5: mean headway per (stop, hour)."""
    _, st, fr = _gtfs(spark, sf)
    return out(HW.headway_avg(st, fr))


@query("join_headway", _HB.replace("WITH ", "WITH " + MODEL_EVENTS.strip() + ",\n", 1) + f"""
SELECT e.event_id, {snap('coalesce(ha.headway_avg_stop_hour, 3600.0)')} AS headway_avg_stop_hour
FROM model_events e LEFT JOIN ha ON CAST(e.gtfs_stop_id AS VARCHAR) = ha.stop_id AND hour(e.event_timestamp) = ha.start_hour""")
def q_join_headway(spark, sf):
    """JN4: events x (stop, hour) headway with differently named keys; NULL -> 3600."""
    _, st, fr = _gtfs(spark, sf)
    df = cal.date_parts(_me(spark, sf), names={"hour": "time_hour"})
    return out(HW.join_headway(df, st, fr).select("event_id", "headway_avg_stop_hour"))


_HOLI_SQL = with_(MODEL_EVENTS, """
yrs AS (SELECT DISTINCT year(event_timestamp) AS y FROM model_events WHERE event_timestamp IS NOT NULL)""", """
fixed AS (SELECT * FROM (VALUES (1, 1, 0), (4, 21, 0), (5, 1, 0), (7, 9, 0), (9, 7, 0), (10, 12, 0), (11, 2, 0),
                                (11, 15, 0), (11, 20, 2024), (12, 25, 0)) t(m, d, y0))""", """
ea AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs)""", """
eb AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f, c // 4 AS i, c % 4 AS k FROM ea)""", """
ec AS (SELECT *, (19 * a + b - d - (b - f + 1) // 3 + 15) % 30 AS h FROM eb)""", """
ed AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM ec)""", """
ee AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS mm FROM ed)""", """
hol AS (SELECT make_date(CAST(y AS INTEGER), CAST(m AS INTEGER), CAST(d AS INTEGER)) AS hd FROM yrs, fixed WHERE y >= y0
        UNION SELECT CAST(make_date(CAST(y AS INTEGER), CAST((h + l - 7 * mm + 114) // 31 AS INTEGER),
                               CAST((h + l - 7 * mm + 114) % 31 + 1 AS INTEGER)) - INTERVAL 2 DAY AS DATE) FROM ee)""") + """
SELECT event_id, CAST(CAST(event_timestamp AS DATE) IN (SELECT hd FROM hol) AS BIGINT) AS is_holiday FROM model_events"""


@query("is_holiday", _HOLI_SQL)
def q_is_holiday(spark, sf):
    """JN8: generated holiday dimension (fixed dates + Good Friday), broadcast join."""
    return out(is_holiday(_me(spark, sf)).select("event_id", "is_holiday"))


# ----------------------------------------------------------- stop / user aggregates
_LBL = _JWL_SQL.replace("SELECT e.event_id,", "SELECT e.*,", 1)
_STOP_AGG_SQL = ("WITH lbl AS (" + _LBL + ")\nSELECT gtfs_stop_id, "
                 + snap("sum(CASE WHEN lotacao_proxy_binaria = 'Nao_Baixa' THEN 1 ELSE 0 END) / count(*)") + " AS stop_event_rate, "
                 "CAST(sum(CASE WHEN lotacao_proxy_binaria = 'Nao_Baixa' THEN 1 ELSE 0 END) AS BIGINT) AS stop_event_count, "
                 "count(lotacao_proxy_binaria) AS stop_total_samples, "
                 + snap("avg(dist_device_stop)") + " AS stop_dist_mean, " + snap("stddev_samp(dist_device_stop)")
                 + " AS stop_dist_std FROM lbl WHERE gtfs_stop_id IS NOT NULL GROUP BY gtfs_stop_id")


def _lbl(spark, sf):
    return L.join_window_label(_me(spark, sf), width=LABEL_WIDTH)


@query("stop_label_stats", _STOP_AGG_SQL.replace(", " + snap("avg(dist_device_stop)") + " AS stop_dist_mean, "
                                                 + snap("stddev_samp(dist_device_stop)") + " AS stop_dist_std", ""))
def q_stop_label_stats(spark, sf):
    """AG2: stop_event_rate (Nao_Baixa share of all rows), count, non-null labels."""
    a = P.stop_label_stats_agg(_lbl(spark, sf), dist="__none", headway="__none")
    return out(a)


@query("stop_dist_stats", "WITH lbl AS (" + _LBL + ")\nSELECT gtfs_stop_id, " + snap("avg(dist_device_stop)")
       + " AS stop_dist_mean, " + snap("stddev_samp(dist_device_stop)") + " AS stop_dist_std FROM lbl "
       "WHERE gtfs_stop_id IS NOT NULL GROUP BY gtfs_stop_id")
def q_stop_dist_stats(spark, sf):
    """AG3: mean and sample std of distance per stop."""
    a = P.stop_label_stats_agg(_lbl(spark, sf), headway="__none")
    return out(a.select("gtfs_stop_id", "stop_dist_mean", "stop_dist_std"))


@query("stop_headway_stats", _HB.replace("WITH ", "WITH " + MODEL_EVENTS.strip() + ",\n", 1) + f"""
, j AS (SELECT e.gtfs_stop_id, coalesce(ha.headway_avg_stop_hour, 3600.0) AS hw FROM model_events e
        LEFT JOIN ha ON CAST(e.gtfs_stop_id AS VARCHAR) = ha.stop_id AND hour(e.event_timestamp) = ha.start_hour)
SELECT gtfs_stop_id, {snap('avg(hw)')} AS stop_headway_mean, {snap('stddev_samp(hw)')} AS stop_headway_std
FROM j WHERE gtfs_stop_id IS NOT NULL GROUP BY gtfs_stop_id""")
def q_stop_headway_stats(spark, sf):
    """AG4: mean and sample std of headway per stop."""
    _, st, fr = _gtfs(spark, sf)
    df = HW.join_headway(cal.date_parts(_me(spark, sf), names={"hour": "time_hour"}), st, fr)
    a = P.stop_label_stats_agg(df, label="target", dist="__none")
    return out(a.select("gtfs_stop_id", "stop_headway_mean", "stop_headway_std"))


@query("join_stop_aggs", "WITH a AS (" + _STOP_AGG_SQL + "), lbl AS (" + _LBL + ")\n"
       "SELECT lbl.event_id, a.stop_event_rate, a.stop_event_count, a.stop_total_samples, a.stop_dist_mean, "
       "coalesce(a.stop_dist_std, 0.0) AS stop_dist_std FROM lbl LEFT JOIN a ON lbl.gtfs_stop_id = a.gtfs_stop_id")
def q_join_stop_aggs(spark, sf):
    """JN5: per-stop statistics joined back; std NULL -> 0."""
    j = P.join_stop_aggs(_lbl(spark, sf), headway="__none")
    return out(j.select("event_id", "stop_event_rate", "stop_event_count", "stop_total_samples", "stop_dist_mean",
                        "stop_dist_std"))


_UP = f"""SELECT user_pseudo_id, {snap('avg(target)')} AS user_conversion_rate, {snap('sum(target)')} AS user_total_conversions,
  count(target) AS user_total_events, {snap('avg(dist_device_stop)')} AS user_avg_dist, {snap('stddev_samp(dist_device_stop)')} AS user_std_dist,
  {snap('min(dist_device_stop)')} AS user_min_dist, {snap('max(dist_device_stop)')} AS user_max_dist,
  {snap('avg(time_hour)')} AS user_avg_hour, {snap('stddev_samp(time_hour)')} AS user_std_hour
FROM (SELECT *, hour(event_timestamp) AS time_hour FROM model_events) WHERE user_pseudo_id IS NOT NULL GROUP BY user_pseudo_id"""


@query("user_profile", with_(MODEL_EVENTS) + "\n" + _UP)
def q_user_profile(spark, sf):
    """AG7: per-user profile (leaky form with the target)."""
    df = cal.date_parts(_me(spark, sf), names={"hour": "time_hour"})
    return out(P.user_profile_agg(df))


_SP = f"""SELECT gtfs_stop_id, {snap('avg(target)')} AS stop_conversion_rate, count(target) AS stop_event_count_agg,
  {snap('avg(user_frequency)')} AS stop_user_freq_mean, {snap('quantile_cont(user_frequency, 0.5)')} AS stop_user_freq_median
FROM model_events WHERE gtfs_stop_id IS NOT NULL GROUP BY gtfs_stop_id"""


@query("stop_profile", with_(MODEL_EVENTS) + "\n" + _SP)
def q_stop_profile(spark, sf):
    """AG8: per-stop target mean / count, user_frequency mean / median."""
    return out(P.stop_profile_agg(_me(spark, sf)))


_UP_RAW = """SELECT user_pseudo_id, avg(target) AS user_conversion_rate, avg(dist_device_stop) AS user_avg_dist,
  stddev_samp(dist_device_stop) AS user_std_dist, avg(time_hour) AS user_avg_hour
FROM (SELECT *, hour(event_timestamp) AS time_hour FROM model_events) WHERE user_pseudo_id IS NOT NULL GROUP BY user_pseudo_id"""
_SP_RAW = """SELECT gtfs_stop_id, avg(target) AS stop_conversion_rate, count(target) AS stop_event_count_agg,
  quantile_cont(user_frequency, 0.5) AS stop_user_freq_median
FROM model_events WHERE gtfs_stop_id IS NOT NULL GROUP BY gtfs_stop_id"""


@query("join_user_aggs", with_(MODEL_EVENTS, "u AS (" + _UP_RAW + ")", "s AS (" + _SP_RAW + ")") + f"""
SELECT e.event_id, {snap('u.user_avg_dist')} AS user_avg_dist, {snap('u.user_std_dist')} AS user_std_dist,
       {snap('u.user_avg_hour')} AS user_avg_hour, {snap('s.stop_user_freq_median')} AS stop_user_freq_median,
       {snap('abs(e.dist_device_stop - u.user_avg_dist)')} AS dist_deviation,
       {snap('e.dist_device_stop / (u.user_avg_dist + 1)')} AS dist_ratio
FROM model_events e LEFT JOIN u ON e.user_pseudo_id = u.user_pseudo_id LEFT JOIN s ON e.gtfs_stop_id = s.gtfs_stop_id""")
def q_join_user_aggs(spark, sf):
    """JN6 + SC22 (leak-free profile: no target statistics)."""
    df = cal.date_parts(_me(spark, sf), names={"hour": "time_hour"})
    j = P.profile_interactions(P.join_user_aggs(df, leaky=False))
    return out(j.select("event_id", "user_avg_dist", "user_std_dist", "user_avg_hour", "stop_user_freq_median",
                        "dist_deviation", "dist_ratio"))


@query("profile_interactions", with_(MODEL_EVENTS, "u AS (" + _UP_RAW + ")", "s AS (" + _SP_RAW + ")") + f"""
SELECT e.event_id, {snap('u.user_conversion_rate * s.stop_conversion_rate')} AS conversion_interaction,
       CAST(e.user_frequency * s.stop_event_count_agg AS BIGINT) AS user_stop_affinity
FROM model_events e LEFT JOIN u ON e.user_pseudo_id = u.user_pseudo_id LEFT JOIN s ON e.gtfs_stop_id = s.gtfs_stop_id""")
def q_profile_interactions(spark, sf):
    """SC22 leaky form (whole-table target means)."""
    df = cal.date_parts(_me(spark, sf), names={"hour": "time_hour"})
    j = P.profile_interactions(P.join_user_aggs(df, leaky=True))
    return out(j.select("event_id", "conversion_interaction", "user_stop_affinity"))


# ------------------------------------------------------------------ the ETL
_EV = ("(SELECT event_id, timezone('America/Sao_Paulo', timezone('UTC', event_timestamp)) AS event_timestamp, event_name, "
       "user_pseudo_id, " + point_lat("device_point") + " AS device_lat, " + point_lon("device_point") + " AS device_lon, "
       + point_lat("ctm_stop_point") + " AS stop_lat_event, " + point_lon("ctm_stop_point") + " AS stop_lon_event "
       "FROM raw_events WHERE event_name = 'bstop_open')")
_ETL_SQL = _HB.replace("WITH ", "WITH " + RAW_EVENTS.strip() + ",\n" + STOPS.strip() + ",\n", 1) + f""",
ev AS {_EV},
gd AS {geodesic_sql('ev', 'event_id', 'device_lat', 'device_lon', 'stop_lat_event', 'stop_lon_event')},
st AS (SELECT stop_id, CAST(stop_lat AS DOUBLE) AS slat, CAST(stop_lon AS DOUBLE) AS slon FROM stops),
nn AS (SELECT e.event_id, s.stop_id, row_number() OVER (PARTITION BY e.event_id ORDER BY
         (s.slat - e.stop_lat_event) * (s.slat - e.stop_lat_event) + (s.slon - e.stop_lon_event) * (s.slon - e.stop_lon_event), s.stop_id) AS r
       FROM ev e, st s WHERE e.stop_lat_event IS NOT NULL AND e.stop_lon_event IS NOT NULL),
e2 AS (SELECT ev.*, gd.dist AS dist_device_stop, nn.stop_id AS gtfs_stop_id FROM ev LEFT JOIN gd ON ev.event_id = gd.gid
       LEFT JOIN nn ON ev.event_id = nn.event_id AND nn.r = 1),
cnt AS (SELECT gtfs_stop_id, floor(epoch(event_timestamp) / 21600) AS b, count(DISTINCT user_pseudo_id) AS uc
        FROM e2 WHERE gtfs_stop_id IS NOT NULL GROUP BY ALL),
e3 AS (SELECT e2.*, CASE WHEN c.uc = 1 THEN 'Baixa' WHEN c.uc > 1 THEN 'Nao_Baixa' END AS lotacao_proxy_binaria
       FROM e2 LEFT JOIN cnt c ON e2.gtfs_stop_id = c.gtfs_stop_id AND floor(epoch(e2.event_timestamp) / 21600) = c.b),
yrs AS (SELECT DISTINCT year(event_timestamp) AS y FROM e3),
fixed AS (SELECT * FROM (VALUES (1, 1, 0), (4, 21, 0), (5, 1, 0), (7, 9, 0), (9, 7, 0), (10, 12, 0), (11, 2, 0),
                                (11, 15, 0), (11, 20, 2024), (12, 25, 0)) t(m, d, y0)),
ea AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs),
eb AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f, c // 4 AS i, c % 4 AS k FROM ea),
ec AS (SELECT *, (19 * a + b - d - (b - f + 1) // 3 + 15) % 30 AS h FROM eb),
ed AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM ec),
ee AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS mm FROM ed),
hol AS (SELECT make_date(CAST(y AS INTEGER), CAST(m AS INTEGER), CAST(d AS INTEGER)) AS hd FROM yrs, fixed WHERE y >= y0
        UNION SELECT CAST(make_date(CAST(y AS INTEGER), CAST((h + l - 7 * mm + 114) // 31 AS INTEGER),
                               CAST((h + l - 7 * mm + 114) % 31 + 1 AS INTEGER)) - INTERVAL 2 DAY AS DATE) FROM ee),
e4 AS (SELECT *, hour(event_timestamp) AS th, CAST(isodow(event_timestamp) - 1 AS BIGINT) AS tdw,
              CAST(CAST(event_timestamp AS DATE) IN (SELECT hd FROM hol) AS BIGINT) AS is_holiday FROM e3),
e5 AS (SELECT e4.*, CAST(tdw >= 5 AS BIGINT) AS is_weekend,
              CAST((th >= 6 AND th < 9) OR (th >= 17 AND th < 19) AS BIGINT) AS is_peak_hour,
              coalesce(ha.headway_avg_stop_hour, 3600.0) AS hw
       FROM e4 LEFT JOIN ha ON e4.gtfs_stop_id = ha.stop_id AND e4.th = ha.start_hour),
sa AS (SELECT gtfs_stop_id, sum(CASE WHEN lotacao_proxy_binaria = 'Nao_Baixa' THEN 1 ELSE 0 END) / count(*) AS ser,
              sum(CASE WHEN lotacao_proxy_binaria = 'Nao_Baixa' THEN 1 ELSE 0 END) AS sec, count(lotacao_proxy_binaria) AS sts,
              avg(dist_device_stop) AS sdm, stddev_samp(dist_device_stop) AS sds, avg(hw) AS shm, stddev_samp(hw) AS shs
       FROM e5 WHERE gtfs_stop_id IS NOT NULL GROUP BY gtfs_stop_id),
e6 AS (SELECT e5.*, sa.ser, sa.sec, sa.sts, sa.sdm, coalesce(sa.sds, 0.0) AS sds, sa.shm, coalesce(sa.shs, 0.0) AS shs
       FROM e5 LEFT JOIN sa ON e5.gtfs_stop_id = sa.gtfs_stop_id WHERE lotacao_proxy_binaria IS NOT NULL)
SELECT CAST(dense_rank() OVER (ORDER BY coalesce(CAST(gtfs_stop_id AS VARCHAR), 'nan')) - 1 AS BIGINT) AS gtfs_stop_id,
  event_id, user_pseudo_id, {snap('device_lat')} AS device_lat, {snap('device_lon')} AS device_lon,
  {snap('stop_lat_event')} AS stop_lat_event, {snap('stop_lon_event')} AS stop_lon_event,
  {snap('dist_device_stop')} AS dist_device_stop, lotacao_proxy_binaria,
  CAST(dense_rank() OVER (ORDER BY coalesce(CAST(th AS VARCHAR), 'nan')) - 1 AS BIGINT) AS time_hour,
  CAST(dense_rank() OVER (ORDER BY coalesce(CAST(tdw AS VARCHAR), 'nan')) - 1 AS BIGINT) AS time_day_of_week,
  day(event_timestamp) AS time_day_of_month, month(event_timestamp) AS time_month, is_holiday, is_weekend, is_peak_hour,
  {snap('hw')} AS headway_avg_stop_hour, {snap('sin(2 * pi() * th / 24)')} AS hour_sin, {snap('cos(2 * pi() * th / 24)')} AS hour_cos,
  {snap('sin(2 * pi() * tdw / 7)')} AS day_sin, {snap('cos(2 * pi() * tdw / 7)')} AS day_cos,
  {snap('hw * th')} AS headway_x_hour, {snap('hw * is_weekend')} AS headway_x_weekend,
  {snap('dist_device_stop * is_peak_hour')} AS dist_x_peak, {snap('dist_device_stop * is_weekend')} AS dist_x_weekend,
  {snap('ser')} AS stop_event_rate, CAST(sec AS BIGINT) AS stop_event_count, sts AS stop_total_samples,
  {snap('sdm')} AS stop_dist_mean, {snap('sds')} AS stop_dist_std, {snap('shm')} AS stop_headway_mean, {snap('shs')} AS stop_headway_std,
  CAST(CASE WHEN lotacao_proxy_binaria = 'Baixa' THEN 0 ELSE 1 END AS BIGINT) AS target
FROM e6"""


@query("build_features", _ETL_SQL)
def q_build_features(spark, sf):
    """Whole ETL (entry 1): raw events + GTFS -> labelled, encoded features."""
    st, sti, fr = _gtfs(spark, sf)
    return out(build_features(_raw(spark, sf), st, sti, fr, bin_width=LABEL_WIDTH).drop("event_timestamp"))


@query("build_features_2min", _ETL_SQL.replace("21600", "120"))
def q_build_features_2min(spark, sf):
    """The whole ETL at the reference's own label width of 2 minutes."""
    st, sti, fr = _gtfs(spark, sf)
    return out(build_features(_raw(spark, sf), st, sti, fr, bin_width="2 minutes").drop("event_timestamp"))


@query("etl_interactions", with_(MODEL_EVENTS, """
hd AS (SELECT *, hour(event_timestamp) AS time_hour, CAST(isodow(event_timestamp) - 1 >= 5 AS INTEGER) AS is_weekend,
       CAST((hour(event_timestamp) >= 6 AND hour(event_timestamp) < 9) OR (hour(event_timestamp) >= 17 AND hour(event_timestamp) < 19) AS INTEGER) AS is_peak_hour
       FROM model_events)""") + f"""
SELECT event_id, {snap('dist_device_stop * is_peak_hour')} AS dist_x_peak, {snap('dist_device_stop * is_weekend')} AS dist_x_weekend FROM hd""")
def q_etl_interactions(spark, sf):
    """SC19 (distance part): dist x peak, dist x weekend."""
    df = cal.date_parts(_me(spark, sf), names={"hour": "time_hour", "day_of_week": "time_day_of_week"})
    df = df.withColumns({"is_weekend": cal.is_weekend("time_day_of_week"), "is_peak_hour": cal.is_peak_hour("time_hour"),
                         "headway_avg_stop_hour": F.lit(3600.0)})
    return out(FE.with_etl_interactions(df).select("event_id", "dist_x_peak", "dist_x_weekend"))


@query("calendar_features", with_(MODEL_EVENTS) + "\nSELECT event_id, hour(event_timestamp) AS time_hour, "
       "CAST(isodow(event_timestamp) - 1 AS BIGINT) AS time_day_of_week, day(event_timestamp) AS time_day_of_month, "
       "month(event_timestamp) AS time_month FROM model_events")
def q_calendar_features(spark, sf):
    """The ETL calendar block (time_* columns)."""
    df = cal.date_parts(_me(spark, sf), names={"hour": "time_hour", "day_of_week": "time_day_of_week",
                                               "day_of_month": "time_day_of_month", "month": "time_month"})
    return out(df.select("event_id", "time_hour", "time_day_of_week", "time_day_of_month", "time_month"))


__all__ = ["calendar_features"]
