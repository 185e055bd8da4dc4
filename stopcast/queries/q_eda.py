"""Queries for the exploratory aggregates, top-k and set operators
(SURVEY §2.4 AG9-AG28, §2.6, §2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.operators import eda as E
from stopcast.queries.q_etl import _me, out
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, snap, with_

FEATS = ["user_frequency", "dist_device_stop", "device_lat", "device_lon", "hour", "day_of_week", "gtfs_stop_id"]
BASE = ("base AS (SELECT *, hour(event_timestamp) AS hour, CAST(isodow(event_timestamp) - 1 AS BIGINT) AS day_of_week "
        "FROM model_events)")
W = with_(MODEL_EVENTS, BASE)


def _base(spark, sf):
    return cal.date_parts(_me(spark, sf), names={"hour": "hour", "day_of_week": "day_of_week"})


def _union(parts):
    return "\nUNION ALL ".join(parts)


@query("class_distribution", W + f"""
, c AS (SELECT target AS class, count(*) AS n FROM base GROUP BY target)
SELECT class, n, {snap('100.0 * n / sum(n) OVER ()')} AS pct, {snap('max(n) OVER () / min(n) OVER ()')} AS imbalance_ratio,
       CASE WHEN max(n) OVER () / min(n) OVER () > 3 THEN 'severe' WHEN max(n) OVER () / min(n) OVER () > 1.5 THEN 'moderate'
            ELSE 'balanced' END AS severity FROM c""")
def q_class_distribution(spark, sf):
    """AG9."""
    return out(E.class_distribution(_base(spark, sf)))


@query("events_by_hour", W + "\nSELECT hour, count(*) AS n_events FROM base GROUP BY hour")
def q_events_by_hour(spark, sf):
    """AG10 (the peak hour is ``E.peak``)."""
    return out(E.events_by(_base(spark, sf), F.col("hour"), "hour"))


@query("peak_hour", W + "\nSELECT arg_min(hour, (-n, hour)) AS peak_hour, max(n) AS peak_n_events FROM "
       "(SELECT hour, count(*) AS n FROM base GROUP BY hour)")
def q_peak_hour(spark, sf):
    """AG10: busiest hour (ties -> earliest)."""
    return out(E.peak(E.events_by(_base(spark, sf), F.col("hour"), "hour"), "hour"))


@query("events_by_weekday", W + """
, d AS (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
                              (5, 'Saturday'), (6, 'Sunday')) t(day_idx, day_name)),
c AS (SELECT day_of_week AS day_idx, count(*) AS n FROM base GROUP BY ALL),
j AS (SELECT d.day_idx, d.day_name, c.n AS n_events FROM d LEFT JOIN c ON d.day_idx = c.day_idx)
SELECT CAST(day_idx AS BIGINT) AS day_idx, day_name, n_events, CAST(n_events = max(n_events) OVER () AS BIGINT) AS is_busiest,
       CAST(n_events = min(n_events) OVER () AS BIGINT) AS is_quietest FROM j""")
def q_events_by_weekday(spark, sf):
    """AG11: Monday..Sunday with missing days NULL."""
    return out(E.events_by_weekday(_base(spark, sf)))


@query("rate_by_hour", W + f"\nSELECT hour, {snap('avg(target) * 100.0')} AS rate_pct FROM base GROUP BY hour")
def q_rate_by_hour(spark, sf):
    """AG12."""
    return out(E.rate_by(_base(spark, sf), F.col("hour"), "hour"))


@query("events_by_date", W + "\nSELECT strftime(event_timestamp, '%Y-%m-%d') AS date, count(*) AS n_events FROM base GROUP BY ALL")
def q_events_by_date(spark, sf):
    """AG13: daily series."""
    return out(E.events_by(_base(spark, sf), F.date_format("event_timestamp", "yyyy-MM-dd"), "date"))


@query("time_span", W + """
SELECT strftime(min(event_timestamp), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S') AS last_ts,
       CAST(floor((epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 86400000000) AS BIGINT) AS span_days FROM base""")
def q_time_span(spark, sf):
    """AG14."""
    r = E.time_span(_base(spark, sf))
    return out(r.select(F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
                        F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("last_ts"), "span_days"))


def _describe_sql(c):
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS feature, CAST(count({x}) AS DOUBLE) AS count, {snap(f'avg({x})')} AS mean, "
            f"{snap(f'stddev_samp({x})')} AS std, {snap(f'min({x})')} AS min, {snap(f'quantile_cont({x}, 0.25)')} AS q25, "
            f"{snap(f'quantile_cont({x}, 0.5)')} AS q50, {snap(f'quantile_cont({x}, 0.75)')} AS q75, {snap(f'max({x})')} AS max, "
            f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) AS missing, "
            f"{snap(f'100.0 * sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*)')} AS missing_pct FROM base")


@query("describe", W + "\n" + _union([_describe_sql(c) for c in FEATS]))
def q_describe(spark, sf):
    """AG15: describe + missing, long form."""
    return out(E.describe(_base(spark, sf), FEATS))


_ENT = {"user": "user_pseudo_id", "stop": "gtfs_stop_id", "route": "gtfs_route_id"}


@query("entity_stats", W + "\n" + _union([
    f"SELECT '{n}' AS entity, count(*) AS n_entities, {snap('quantile_cont(CAST(c AS DOUBLE), 0.5)')} AS median_events, "
    f"{snap('avg(c)')} AS mean_events, max(c) AS max_events FROM (SELECT {k}, count(*) AS c FROM base WHERE {k} IS NOT NULL GROUP BY {k})"
    for n, k in _ENT.items()]))
def q_entity_stats(spark, sf):
    """AG16: users / stops / routes: distinct count, median / mean / max events."""
    return out(E.entity_stats(_base(spark, sf), _ENT))


@query("quantile_points", W + f"""
SELECT {snap('quantile_cont(dist_device_stop, 0.95)')} AS p95, {snap('quantile_cont(dist_device_stop, 0.99)')} AS p99,
       {snap('avg(dist_device_stop)')} AS mean, {snap('quantile_cont(dist_device_stop, 0.5)')} AS median FROM base""")
def q_quantile_points(spark, sf):
    """AG17."""
    return out(E.quantile_points(_base(spark, sf), "dist_device_stop"))


IQR_FEATS = ["user_frequency", "dist_device_stop", "device_lat", "device_lon"]


def _iqr_sql(c):
    q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
    return (f"SELECT '{c}' AS feature, {snap('q1')} AS q1, {snap('q3')} AS q3, {snap('q3 - q1')} AS iqr, "
            f"{snap('q1 - 1.5 * (q3 - q1)')} AS lower, {snap('q3 + 1.5 * (q3 - q1)')} AS upper, "
            f"(SELECT count(*) FROM base WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers, "
            f"{snap(f'100.0 * (SELECT count(*) FROM base WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / (SELECT count(*) FROM base)')} "
            f"AS outlier_pct FROM (SELECT {q1} AS q1, {q3} AS q3 FROM base)")


@query("iqr_outliers", W + "\n" + _union([_iqr_sql(c) for c in IQR_FEATS]))
def q_iqr_outliers(spark, sf):
    """AG18: IQR fences and outliers for 4 features."""
    return out(E.iqr_outliers(_base(spark, sf), IQR_FEATS))


CORR_FEATS = ["user_frequency", "dist_device_stop", "device_lat", "device_lon", "hour", "day_of_week", "gtfs_stop_id",
              "gtfs_route_id", "stop_lat_event", "stop_lon_event"]
_CORR_SQL = W + "\n" + _union([f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE)) AS corr FROM base"
                               for c in CORR_FEATS])


def _corr(spark, sf):
    return E.corr_target(_base(spark, sf), CORR_FEATS)


@query("corr_target", f"SELECT feature, {snap('corr')} AS corr FROM ({_CORR_SQL})")
def q_corr_target(spark, sf):
    """AG19: Pearson r with the target for every numeric feature."""
    return out(_corr(spark, sf))


@query("nlargest_abs", f"SELECT feature, {snap('corr')} AS corr FROM ({_CORR_SQL}) WHERE corr IS NOT NULL "
       "ORDER BY abs(corr) DESC, feature LIMIT 15")
def q_nlargest_abs(spark, sf):
    """SRT6: the 15 largest |r|."""
    return out(E.top_abs(_corr(spark, sf), 15))


@query("top_bottom_corr", f"SELECT feature, {snap('corr')} AS corr, side FROM ("
       f"(SELECT *, 'top' AS side FROM ({_CORR_SQL}) WHERE corr IS NOT NULL ORDER BY corr DESC, feature LIMIT 15) UNION ALL "
       f"(SELECT *, 'bottom' AS side FROM ({_CORR_SQL}) WHERE corr IS NOT NULL ORDER BY corr ASC, feature LIMIT 15))")
def q_top_bottom_corr(spark, sf):
    """SRT3: highest and lowest correlations, concatenated."""
    return out(E.top_bottom(_corr(spark, sf), 15))


@query("topk_features", f"SELECT feature, {snap('abs(corr)')} AS score FROM ({_CORR_SQL}) WHERE corr IS NOT NULL "
       "ORDER BY abs(corr) DESC, feature LIMIT 20")
def q_topk_features(spark, sf):
    """SRT2: top-n features by score (here |r|; model importances in q_models)."""
    c = _corr(spark, sf).where(F.col("corr").isNotNull()).select("feature", F.abs("corr").alias("score"))
    return out(E.topk(c, "score", 20, "feature"))


MATRIX = ["user_frequency", "dist_device_stop", "device_lat", "device_lon", "stop_lat_event", "hour", "target"]
_PAIRS = [(a, b) for i, a in enumerate(MATRIX) for b in MATRIX[i + 1:]]
_PAIR_SQL = W + "\n" + _union([f"SELECT '{a}' AS f1, '{b}' AS f2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr "
                               "FROM base" for a, b in _PAIRS])


@query("corr_matrix", f"SELECT f1, f2, {snap('corr')} AS corr FROM ({_PAIR_SQL})")
def q_corr_matrix(spark, sf):
    """AG20: pairwise matrix of the selected features + target (long form)."""
    return out(E.corr_pairs(_base(spark, sf), MATRIX))


@query("collinear_pairs", f"SELECT f1, f2, {snap('corr')} AS corr FROM ({_PAIR_SQL}) WHERE abs(corr) > 0.8")
def q_collinear_pairs(spark, sf):
    """AG21: pairs with |r| > 0.8."""
    return out(E.collinear_pairs(E.corr_pairs(_base(spark, sf), MATRIX)))


PROFILE = {"event_id": "bigint", "event_timestamp": "timestamp", "user_pseudo_id": "bigint", "gtfs_stop_id": "int", "gtfs_route_id": "int",
           "target": "int", "dist_device_stop": "double", "device_lat": "double", "device_lon": "double", "stop_lat_event": "double",
           "stop_lon_event": "double", "user_frequency": "bigint"}


@query("column_profile", W + "\n" + _union([
    f"SELECT '{c}' AS \"column\", '{kind}' AS dtype, (SELECT count(DISTINCT {c}) FROM base) AS n_distinct, "
    f"(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM base WHERE {c} IS NOT NULL "
    f"ORDER BY v LIMIT 5)) AS examples" for c, kind in PROFILE.items()]))
def q_column_profile(spark, sf):
    """AG22: type, distinct count and 5 example values of every column."""
    return out(E.column_profile(_me(spark, sf), list(PROFILE)))


VAR_FEATS = ["user_frequency", "dist_device_stop", "device_lat", "device_lon", "hour", "day_of_week"]


@query("feature_variance", W + f"\nSELECT feature, {snap('variance')} AS variance FROM (" + _union(
    [f"SELECT '{c}' AS feature, var_pop(CAST({c} AS DOUBLE)) AS variance FROM base" for c in VAR_FEATS])
       + ") ORDER BY variance DESC, feature LIMIT 20")
def q_feature_variance(spark, sf):
    """AG23: population variance per feature, top n."""
    return out(E.feature_variance(_base(spark, sf), VAR_FEATS, 20))


@query("histogram", W + f"""
, h AS (SELECT CAST(least(floor(50.0 * (user_frequency - lo) / (CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END)), 49) AS BIGINT) AS bin, lo, hi
        FROM base, (SELECT min(user_frequency) AS lo, max(user_frequency) AS hi FROM base) WHERE user_frequency IS NOT NULL)
SELECT bin, count(*) AS n, {snap('any_value(lo) + bin * (CASE WHEN any_value(hi) = any_value(lo) THEN 1.0 ELSE any_value(hi) - any_value(lo) END) / 50.0')} AS bin_lo,
       {snap('any_value(lo) + (bin + 1) * (CASE WHEN any_value(hi) = any_value(lo) THEN 1.0 ELSE any_value(hi) - any_value(lo) END) / 50.0')} AS bin_hi
FROM h GROUP BY bin""")
def q_histogram(spark, sf):
    """AG26: 50 equal-width bins of user_frequency."""
    return out(E.histogram(_base(spark, sf), "user_frequency"))


@query("histogram_below_q99", W + f"""
, b AS (SELECT * FROM base WHERE dist_device_stop < (SELECT quantile_cont(dist_device_stop, 0.99) FROM base)),
h AS (SELECT CAST(least(floor(50.0 * (dist_device_stop - lo) / (CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END)), 49) AS BIGINT) AS bin, lo, hi
      FROM b, (SELECT min(dist_device_stop) AS lo, max(dist_device_stop) AS hi FROM b))
SELECT bin, count(*) AS n, {snap('any_value(lo) + bin * (CASE WHEN any_value(hi) = any_value(lo) THEN 1.0 ELSE any_value(hi) - any_value(lo) END) / 50.0')} AS bin_lo,
       {snap('any_value(lo) + (bin + 1) * (CASE WHEN any_value(hi) = any_value(lo) THEN 1.0 ELSE any_value(hi) - any_value(lo) END) / 50.0')} AS bin_hi
FROM h GROUP BY bin""")
def q_histogram_q99(spark, sf):
    """AG26: distance histogram below Q99."""
    return out(E.histogram(_base(spark, sf), "dist_device_stop", below_quantile=0.99))


_VALID = "NOT (device_lat IS NULL OR device_lon IS NULL) AND NOT (device_lat = 0 AND device_lon = 0)"


@query("hexbin_density", W + f"""
, v AS (SELECT * FROM base WHERE {_VALID}),
m AS (SELECT min(device_lat) AS a, max(device_lat) AS b, min(device_lon) AS c, max(device_lon) AS d FROM v)
SELECT CAST(least(floor(50.0 * (device_lat - a) / (CASE WHEN b = a THEN 1.0 ELSE b - a END)), 49) AS BIGINT) AS lat_cell,
       CAST(least(floor(50.0 * (device_lon - c) / (CASE WHEN d = c THEN 1.0 ELSE d - c END)), 49) AS BIGINT) AS lon_cell,
       count(*) AS n FROM v, m GROUP BY ALL""")
def q_hexbin(spark, sf):
    """AG27: 50x50 density grid over all valid coordinates."""
    return out(E.hexbin_density(_base(spark, sf)))


@query("geo_extent", W + f"""
SELECT count(*) AS n_valid, {snap('min(device_lat)')} AS lat_min, {snap('max(device_lat)')} AS lat_max,
       {snap('min(device_lon)')} AS lon_min, {snap('max(device_lon)')} AS lon_max FROM base WHERE {_VALID}""")
def q_geo_extent(spark, sf):
    """AG28."""
    return out(E.geo_extent(_base(spark, sf)))


@query("top_entities", W + "\n" + _union([
    f"(SELECT '{n}' AS entity, CAST({k} AS BIGINT) AS key, count(*) AS n_events FROM base WHERE {k} IS NOT NULL GROUP BY {k} "
    f"ORDER BY n_events DESC, {k} LIMIT 20)" for n, k in _ENT.items()]))
def q_top_entities(spark, sf):
    """SRT4: top 20 users / stops / routes by events."""
    parts = [E.top_entities(_base(spark, sf), k, 20).select(F.lit(n).alias("entity"), F.col(k).cast("long").alias("key"),
                                                                 "n_events") for n, k in _ENT.items()]
    r = parts[0]
    for p in parts[1:]:
        r = r.unionByName(p)
    return out(r)


@query("set_difference", f"SELECT feature FROM (SELECT unnest({CORR_FEATS!r}) AS feature) EXCEPT ALL "
       f"SELECT feature FROM ({_CORR_SQL}) WHERE abs(corr) >= 0.01")
def q_set_difference(spark, sf):
    """SET3: removed = all features - selected (|r| >= 0.01)."""
    allf = E.names_table(spark, CORR_FEATS)
    sel = _corr(spark, sf).where(F.abs("corr") >= 0.01)
    return E.set_difference(allf, sel)


@query("best_rate_hour", W + f"\nSELECT arg_max(hour, (r, -hour)) AS best_hour, {snap('max(r)')} AS best_rate_pct FROM "
       "(SELECT hour, avg(target) * 100.0 AS r FROM base GROUP BY hour)")
def q_best_rate_hour(spark, sf):
    """AG12: hour with the highest positive rate (ties -> earliest)."""
    r = E.rate_by(_base(spark, sf), F.col("hour"), "hour")
    return out(r.agg(F.max_by("hour", F.struct(F.col("rate_pct"), (-F.col("hour")).alias("h"))).alias("best_hour"),
                     F.max("rate_pct").alias("best_rate_pct")))


@query("histogram_marks", W + f"\nSELECT {snap('avg(user_frequency)')} AS mean, "
       f"{snap('quantile_cont(user_frequency, 0.5)')} AS median FROM base WHERE user_frequency IS NOT NULL")
def q_histogram_marks(spark, sf):
    """AG26: the mean and median marks drawn on the histogram."""
    from stopcast.operators.quantiles import quantile
    b = _base(spark, sf).where(F.col("user_frequency").isNotNull())
    return out(b.agg(F.avg("user_frequency").alias("mean")).select("mean", quantile(b, "user_frequency", 0.5).alias("median")))
