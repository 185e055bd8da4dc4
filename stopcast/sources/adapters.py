"""Stand-in inputs built from the given test tables.

The reference reads a warehouse table of model events, a raw app-event CSV
and five GTFS text files.  The functions here only *shape* rows of the test
tables into those schemas (column names, types, nulls); they do none of the
work of the operators.  Formulas are the fixed ones of FIXTURES.md §2 and are
mirrored by ``stopcast.queries.sql`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopcast.sources.tables import read_events, read_table

# Fixed values (FIXTURES.md §2): stop grid origin and pitch, device jitter.
STOP_LAT0 = -23.60
STOP_LON0 = -46.70
STOP_PITCH = 0.01
JITTER_DIV = 20000.0


def _stop_k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def stop_lat_expr(k: F.Column) -> F.Column:
    return F.lit(STOP_LAT0) + F.floor(k / F.lit(10)) * F.lit(STOP_PITCH)


def stop_lon_expr(k: F.Column) -> F.Column:
    return F.lit(STOP_LON0) + (k % F.lit(10)) * F.lit(STOP_PITCH)


def model_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training input table (``model_events`` of FIXTURES.md).

    ``user_frequency`` is an *input* column of the reference (never computed
    there); it is filled by the library's own per-key count operator.
    """
    from stopcast.operators.history import key_frequency

    ev = read_events(spark, sf_dir)
    k = _stop_k()
    eid = F.col("event_id")
    slat = stop_lat_expr(k)
    slon = stop_lon_expr(k)
    dlat = (F.when(eid % 41 == 0, F.lit(None).cast("double"))
            .when(eid % 97 == 0, F.lit(0.0))
            .otherwise(slat + ((eid * 37) % 100 - 50) / F.lit(JITTER_DIV)))
    dlon = (F.when(eid % 41 == 0, F.lit(None).cast("double"))
            .when(eid % 97 == 0, F.lit(0.0))
            .otherwise(slon + ((eid * 53) % 100 - 50) / F.lit(JITTER_DIV)))
    df = ev.select(
        eid.alias("event_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("user_id").alias("user_pseudo_id"),
        k.alias("gtfs_stop_id"),
        (k % 10).alias("gtfs_route_id"),
        (F.col("event_type") == "purchase").cast("int").alias("target"),
        F.when(eid % 53 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("dist_device_stop"),
        dlat.alias("device_lat"),
        dlon.alias("device_lon"),
        slat.alias("stop_lat_event"),
        slon.alias("stop_lon_event"),
    )
    return key_frequency(df, "user_pseudo_id", "user_frequency")


def _fmt(x: F.Column) -> F.Column:
    return F.format_string("%.6f", x)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw app events (``raw_events`` of FIXTURES.md): POINT text columns,
    string user ids, event names and a few columns the ETL drops."""
    ev = read_events(spark, sf_dir)
    k = _stop_k()
    eid = F.col("event_id")
    slat = stop_lat_expr(k)
    slon = stop_lon_expr(k)
    dlat = slat + ((eid * 37) % 100 - 50) / F.lit(JITTER_DIV)
    dlon = slon + ((eid * 53) % 100 - 50) / F.lit(JITTER_DIV)
    device_point = (F.when(eid % 41 == 0, F.lit(None).cast("string"))
                    .when(eid % 89 == 0, F.lit("POINT(garbage)"))
                    .otherwise(F.concat(F.lit("POINT("), _fmt(dlon), F.lit(" "), _fmt(dlat), F.lit(")"))))
    stop_point = (F.when(eid % 67 == 0, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("POINT ("), _fmt(slon), F.lit(" "), _fmt(slat), F.lit(")"))))
    return ev.select(
        eid.alias("event_id"),
        F.col("ts").alias("event_timestamp"),
        F.when(F.col("event_type") == "error", F.lit("app_error")).otherwise(F.lit("bstop_open")).alias("event_name"),
        F.col("user_id").cast("string").alias("user_pseudo_id"),
        device_point.alias("device_point"),
        stop_point.alias("ctm_stop_point"),
        F.lit("android").alias("platform"),
        F.col("props").alias("ga_session_id"),
    )


def gtfs_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GTFS ``stops`` (all strings): one stop per distinct ``k`` in events."""
    ev = read_table(spark, sf_dir, "events")
    ks = ev.select(_stop_k().alias("k")).where(F.col("k").isNotNull()).distinct()
    return ks.select(
        F.col("k").cast("string").alias("stop_id"),
        _fmt(stop_lat_expr(F.col("k"))).alias("stop_lat"),
        _fmt(stop_lon_expr(F.col("k"))).alias("stop_lon"),
    )


def gtfs_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").cast("string").alias("trip_id"),
                     (F.col("l_partkey") % 100).cast("string").alias("stop_id")).distinct()


def gtfs_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    su = read_table(spark, sf_dir, "supplier")
    hrs = su.select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    return hrs.select(
        F.col("s_suppkey").cast("string").alias("trip_id"),
        F.concat(F.lpad(F.col("h").cast("string"), 2, "0"), F.lit(":00:00")).alias("start_time"),
        (F.lit(300) + (F.col("s_suppkey") * 7 + F.col("h") * 13) % 3300).cast("string").alias("headway_secs"),
    )


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic score table ``(id, label, score)`` (FIXTURES.md §2).

    Scores are cut to 2 decimals with ``floor`` (not ``round``, whose
    half-way rule differs between engines) so that ties exist."""
    ev = read_events(spark, sf_dir)
    score = (((F.col("event_id") * 7919) % 1000) / F.lit(1000.0) * F.lit(0.6)
             + F.lit(0.4) * F.least(F.col("value") / F.lit(100.0), F.lit(1.0)))
    return ev.select(F.col("event_id").alias("id"),
                     (F.col("event_type") == "purchase").cast("int").alias("label"),
                     (F.floor(score * F.lit(100.0)) / F.lit(100.0)).alias("score"))
