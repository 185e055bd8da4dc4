"""Feature formulas of the reference (SC15-SC26), as column expressions.

Each ``with_*`` function adds a group of features when (and only when) its
input columns exist in the schema -- decided at plan-build time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.functions.geo import euclid_deg


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def recency_score(days: str) -> Column:
    """SC15: exp(-days / 7)."""
    return F.exp(-F.col(days) / F.lit(7.0))


def with_rf_features(df: DataFrame, hour: str = "hour", dow: str = "day_of_week") -> DataFrame:
    """Random-forest feature block: SC20, SC3, SC17, SC11, SC14, SC13, SC15."""
    out: dict[str, Column] = {}
    if _has(df, "user_hist_conversion_rate", "stop_hist_conversion_rate"):
        out["user_stop_interaction"] = F.col("user_hist_conversion_rate") * F.col("stop_hist_conversion_rate")
    if _has(df, "user_hist_conversion_rate", "line_hist_conversion_rate"):
        out["user_line_interaction"] = F.col("user_hist_conversion_rate") * F.col("line_hist_conversion_rate")
    if _has(df, "stop_hist_conversion_rate", "line_hist_conversion_rate"):
        out["stop_line_interaction"] = F.col("stop_hist_conversion_rate") * F.col("line_hist_conversion_rate")
    if _has(df, "device_lat", "device_lon", "stop_lat_event", "stop_lon_event"):
        out["geo_distance"] = euclid_deg("device_lat", "device_lon", "stop_lat_event", "stop_lon_event")
    if _has(df, "stop_event_rate", "stop_total_samples"):
        out["stop_rate_per_sample"] = F.col("stop_event_rate") / (F.col("stop_total_samples") + F.lit(1))
    if _has(df, "stop_event_count", "stop_total_samples"):
        out["stop_density"] = F.col("stop_event_count") / (F.col("stop_total_samples") + F.lit(1))
    out["time_period"] = cal.time_period(hour)
    out["hour_weekday_interaction"] = F.col(hour) * F.col(dow)
    out["distance_from_peak"] = cal.distance_from_peak(hour)
    if _has(df, "user_recency_days"):
        out["user_recency_score"] = recency_score("user_recency_days")
    if _has(df, "stop_recency_days"):
        out["stop_recency_score"] = recency_score("stop_recency_days")
    return df.withColumns(out)


def with_poly_terms(df: DataFrame) -> DataFrame:
    """SC18 + SC23: rate^2, ln(1+rate), rate x count, user x stop rate,
    geo x rate, recency x rate."""
    out: dict[str, Column] = {}
    if _has(df, "stop_event_rate"):
        out["stop_rate_squared"] = F.col("stop_event_rate") * F.col("stop_event_rate")
        out["stop_rate_log"] = F.log1p(F.col("stop_event_rate"))
    if _has(df, "stop_event_rate", "stop_event_count"):
        out["stop_rate_x_count"] = F.col("stop_event_rate") * F.col("stop_event_count")
    if _has(df, "user_hist_conversion_rate", "stop_hist_conversion_rate"):
        out["user_stop_conv_product"] = F.col("user_hist_conversion_rate") * F.col("stop_hist_conversion_rate")
    if _has(df, "geo_distance", "stop_event_rate"):
        out["geo_distance_x_stop_rate"] = F.col("geo_distance") * F.col("stop_event_rate")
    if _has(df, "user_recency_score", "stop_event_rate"):
        out["user_stop_recency_interaction"] = F.col("user_recency_score") * F.col("stop_event_rate")
    return df.withColumns(out) if out else df


def with_scores(df: DataFrame) -> DataFrame:
    """SC24 engagement, SC25 popularity, SC16 recency combos."""
    out: dict[str, Column] = {}
    if _has(df, "user_hist_count", "user_hist_conversion_rate", "user_recency_score"):
        out["user_engagement_score"] = (F.log1p(F.col("user_hist_count")) * F.col("user_hist_conversion_rate")
                                        * F.col("user_recency_score"))
    if _has(df, "stop_event_rate", "stop_total_samples", "stop_hist_count"):
        out["stop_popularity_score"] = (F.col("stop_event_rate") * F.log1p(F.col("stop_total_samples"))
                                        * F.log1p(F.col("stop_hist_count")))
    if _has(df, "user_recency_days", "stop_recency_days"):
        out["combined_recency"] = F.least(F.col("user_recency_days"), F.col("stop_recency_days"))
        out["recency_ratio"] = F.col("user_recency_days") / (F.col("stop_recency_days") + F.lit(1))
    return df.withColumns(out) if out else df


def with_tier_cluster_cross(df: DataFrame, hour: str = "hour") -> DataFrame:
    """SC26: tier x period, cluster x hour, tier x weekend, cluster x period."""
    out: dict[str, Column] = {}
    if _has(df, "stop_tier", "time_period"):
        out["stop_tier_x_time_period"] = F.col("stop_tier") * F.col("time_period")
    if _has(df, "geo_cluster"):
        out["geo_cluster_x_hour"] = F.col("geo_cluster") * F.col(hour)
    if _has(df, "stop_tier", "is_weekend"):
        out["stop_tier_x_weekend"] = F.col("stop_tier") * F.col("is_weekend")
    if _has(df, "geo_cluster", "time_period"):
        out["geo_cluster_x_time_period"] = F.col("geo_cluster") * F.col("time_period")
    return df.withColumns(out) if out else df


def with_etl_interactions(df: DataFrame) -> DataFrame:
    """SC19: headway x hour, headway x weekend, dist x peak, dist x weekend."""
    return df.withColumns({
        "headway_x_hour": F.col("headway_avg_stop_hour") * F.col("time_hour"),
        "headway_x_weekend": F.col("headway_avg_stop_hour") * F.col("is_weekend"),
        "dist_x_peak": F.col("dist_device_stop") * F.col("is_peak_hour"),
        "dist_x_weekend": F.col("dist_device_stop") * F.col("is_weekend"),
    })


def with_hist_affinity(df: DataFrame) -> DataFrame:
    """SC21: k-NN history interactions."""
    out = {
        "hist_interaction": F.col("user_hist_conversion_rate") * F.col("stop_hist_conversion_rate"),
        "user_stop_hist_affinity": F.col("user_hist_events") * F.col("stop_hist_events"),
    }
    if _has(df, "dist_device_stop"):
        out["dist_deviation_hist"] = F.abs(F.col("dist_device_stop") - F.col("user_avg_dist_hist"))
        out["dist_ratio_hist"] = F.col("dist_device_stop") / (F.col("user_avg_dist_hist") + F.lit(1))
    return df.withColumns(out)
