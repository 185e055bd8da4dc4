"""ETL plan: raw app events + GTFS -> labelled feature table (entry 1 of the
reference), expressed as one lazy DataFrame plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.functions.features import with_etl_interactions
from stopcast.functions.geo import geodesic_m, haversine_m, parse_point
from stopcast.functions.holidays import is_holiday
from stopcast.operators import cleaning as C
from stopcast.operators.headway import join_headway
from stopcast.operators.labels import binary_target, join_window_label
from stopcast.operators.nearest import nearest_join
from stopcast.operators.profiles import join_stop_aggs
from stopcast.operators.transforms import label_encode

# Fixed value of the reference: columns label-encoded at the end of the ETL.
ENCODED = ["gtfs_stop_id", "time_day_of_week", "time_hour"]


def parse_points(df: DataFrame) -> DataFrame:
    """SC1 on both POINT columns -> device_lat/lon, stop_lat_event/lon_event."""
    dlat, dlon = parse_point("device_point")
    slat, slon = parse_point("ctm_stop_point")
    return (df.withColumns({"device_lat": dlat, "device_lon": dlon, "stop_lat_event": slat, "stop_lon_event": slon})
              .drop("device_point", "ctm_stop_point"))


def calendar_features(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """time_hour, time_day_of_week (Mon=0), time_day_of_month, time_month,
    is_holiday, is_weekend, is_peak_hour."""
    df = cal.date_parts(df, ts, {"hour": "time_hour", "day_of_week": "time_day_of_week",
                                 "day_of_month": "time_day_of_month", "month": "time_month"})
    df = is_holiday(df, ts)
    return df.withColumns({"is_weekend": cal.is_weekend("time_day_of_week"),
                           "is_peak_hour": cal.is_peak_hour("time_hour")})


def build_features(raw: DataFrame, stops: DataFrame, stop_times: DataFrame, frequencies: DataFrame, *,
                   tz: str | None = "America/Sao_Paulo", bin_width: str = "2 minutes", distance: str = "geodesic",
                   stop_aggs_fit: DataFrame | None = None, encode: bool = True) -> DataFrame:
    """Full ETL.  ``distance``: 'geodesic' (WGS-84, as the reference) or
    'haversine' (sphere, pure column expression).

    Two lineage cuts (reliable checkpoints in the shared folder): after the
    per-event stage (parse, distance UDF, nearest stop) and after the labelled
    features, because the label counts, holiday years, per-stop statistics
    and label codes each read the frame again."""
    from stopcast.semantics import require
    from stopcast.session import materialize
    require(raw, ["event_id", "event_timestamp", "event_name", "user_pseudo_id", "device_point", "ctm_stop_point"],
            "build_features")
    df = C.filter_event(raw)
    if tz:
        df = df.withColumn("event_timestamp", cal.tz_convert("event_timestamp", tz))
    df = C.drop_existing(df)
    df = parse_points(df)
    dist = geodesic_m if distance == "geodesic" else haversine_m
    df = df.withColumn("dist_device_stop", dist("device_lat", "device_lon", "stop_lat_event", "stop_lon_event"))
    df = materialize(nearest_join(df, stops, lat="stop_lat_event", lon="stop_lon_event", out="gtfs_stop_id"))
    df = join_window_label(df, width=bin_width).drop("lotacao_proxy")
    df = calendar_features(df)
    df = join_headway(df, stop_times, frequencies)
    df = cal.with_cyclic(df, {"hour": ("time_hour", 24), "day": ("time_day_of_week", 7)})
    df = materialize(with_etl_interactions(df))
    df = join_stop_aggs(df, fit_on=stop_aggs_fit)
    df = C.dropna_label(df)
    df = df.withColumn("target", binary_target("lotacao_proxy_binaria"))
    if encode:
        df = label_encode(df, ENCODED)
    return df
