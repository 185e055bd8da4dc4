"""Per-key profile aggregates joined back to events (AG2-AG4, AG7, AG8,
AG24, AG25, JN5-JN7, WN11).

One ``groupBy().agg()`` per key computes every statistic in a single pass
(the reference runs three group-bys on the same key); the aggregate is
partial (map-side combined) so hot keys are pre-reduced before the shuffle.
The per-key table is joined back with a left equi-join that AQE turns into a
broadcast when the key table is small at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.operators.labels import BINARY_NOT_LOW
from stopcast.operators.quantiles import group_quantiles


def _join_back(df: DataFrame, agg: DataFrame, key: str) -> DataFrame:
    return df.join(agg, on=key, how="left")


def stop_label_stats_agg(df: DataFrame, *, stop: str = "gtfs_stop_id", label: str = "lotacao_proxy_binaria",
                         dist: str = "dist_device_stop", headway: str = "headway_avg_stop_hour",
                         event_value=BINARY_NOT_LOW) -> DataFrame:
    """AG2 + AG3 + AG4 as one aggregate per stop.

    ``stop_event_rate`` = share of rows labelled Nao_Baixa among *all* rows
    (NULL label counts as "not event"), ``stop_event_count`` = Nao_Baixa
    rows, ``stop_total_samples`` = non-NULL labels; mean and sample std of
    distance and headway (std of one row is NULL, filled with 0 later)."""
    ev = (F.col(label) == F.lit(event_value))
    aggs = [
        (F.sum(F.coalesce(ev, F.lit(False)).cast("long")) / F.count(F.lit(1))).alias("stop_event_rate"),
        F.sum(F.coalesce(ev, F.lit(False)).cast("long")).alias("stop_event_count"),
        F.count(F.col(label)).alias("stop_total_samples"),
    ]
    if dist in df.columns:
        aggs += [F.avg(dist).alias("stop_dist_mean"), F.stddev_samp(dist).alias("stop_dist_std")]
    if headway in df.columns:
        aggs += [F.avg(headway).alias("stop_headway_mean"), F.stddev_samp(headway).alias("stop_headway_std")]
    return df.where(F.col(stop).isNotNull()).groupBy(stop).agg(*aggs)


def join_stop_aggs(df: DataFrame, *, stop: str = "gtfs_stop_id", fit_on: DataFrame | None = None, **kw) -> DataFrame:
    """JN5: attach the per-stop statistics; std NULL -> 0.

    ``fit_on`` = the rows to learn from (default: the whole table, as the
    reference ETL does, which leaks the label; pass the train part for the
    leak-free WN11 form)."""
    agg = stop_label_stats_agg(fit_on if fit_on is not None else df, stop=stop, **kw)
    out = _join_back(df, agg, stop)
    return out.na.fill({c: 0.0 for c in ("stop_dist_std", "stop_headway_std") if c in out.columns})


def user_profile_agg(df: DataFrame, *, user: str = "user_pseudo_id", target: str | None = "target",
                     dist: str = "dist_device_stop", hour: str = "time_hour") -> DataFrame:
    """AG7: per-user profile.  With ``target`` (leaky form): conversion
    rate/total/events; always: distance mean/std/min/max, hour mean/std."""
    aggs: list[Column] = []
    if target:
        aggs += [F.avg(target).alias("user_conversion_rate"), F.sum(target).cast("double").alias("user_total_conversions"),
                 F.count(target).alias("user_total_events")]
    if dist in df.columns:
        aggs += [F.avg(dist).alias("user_avg_dist"), F.stddev_samp(dist).alias("user_std_dist"),
                 F.min(dist).alias("user_min_dist"), F.max(dist).alias("user_max_dist")]
    else:
        aggs += [F.avg(dist).alias("user_avg_dist")]
    if hour in df.columns:
        aggs += [F.avg(hour).alias("user_avg_hour"), F.stddev_samp(hour).alias("user_std_hour")]
    return df.where(F.col(user).isNotNull()).groupBy(user).agg(*aggs)


def stop_profile_agg(df: DataFrame, *, stop: str = "gtfs_stop_id", target: str | None = "target",
                     freq: str = "user_frequency", exact_median: bool = True) -> DataFrame:
    """AG8: per-stop target mean / non-null count (leaky form), and mean and
    median of ``user_frequency`` (median interpolated, by ranks within the stop:
    ``quantiles.group_quantiles``; ``percentile_approx`` when ``exact_median`` is
    False)."""
    aggs: list[Column] = []
    if target:
        aggs += [F.avg(target).alias("stop_conversion_rate"), F.count(target).alias("stop_event_count_agg")]
    aggs += [F.avg(freq).alias("stop_user_freq_mean")]
    known = df.where(F.col(stop).isNotNull())
    if not exact_median:
        med = F.percentile_approx(F.col(freq), F.lit(0.5), F.lit(10000)).cast("double")
        return known.groupBy(stop).agg(*aggs, med.alias("stop_user_freq_median"))
    med = group_quantiles(known, stop, freq, [0.5]).select(stop, F.col("q")[0].alias("stop_user_freq_median"))
    return known.groupBy(stop).agg(*aggs).join(med, stop, "left")


def join_user_aggs(df: DataFrame, *, leaky: bool = False, fit_on: DataFrame | None = None,
                   user: str = "user_pseudo_id", stop: str = "gtfs_stop_id", target: str = "target") -> DataFrame:
    """JN6: attach the user and stop profiles (AG7, AG8)."""
    src = fit_on if fit_on is not None else df
    t = target if leaky else None
    out = _join_back(df, user_profile_agg(src, user=user, target=t), user)
    if "user_frequency" in df.columns:
        out = _join_back(out, stop_profile_agg(src, stop=stop, target=t), stop)
    return out


def profile_interactions(df: DataFrame) -> DataFrame:
    """SC22: conversion_interaction, dist_deviation, dist_ratio,
    user_stop_affinity (each only when its inputs exist)."""
    c = set(df.columns)
    out = {}
    if {"user_conversion_rate", "stop_conversion_rate"} <= c:
        out["conversion_interaction"] = F.col("user_conversion_rate") * F.col("stop_conversion_rate")
    if {"user_avg_dist", "dist_device_stop"} <= c:
        out["dist_deviation"] = F.abs(F.col("dist_device_stop") - F.col("user_avg_dist"))
        out["dist_ratio"] = F.col("dist_device_stop") / (F.col("user_avg_dist") + F.lit(1))
    if {"user_frequency", "stop_event_count_agg"} <= c:
        out["user_stop_affinity"] = F.col("user_frequency") * F.col("stop_event_count_agg")
    return df.withColumns(out) if out else df


def last_per_key(df: DataFrame, key: str, cols: Sequence[str], order: Sequence[str] = ("event_timestamp", "event_id")) -> DataFrame:
    """AG25: pandas ``groupby(key).last()`` = last *non-null* value of each
    column in order; ``max_by`` over non-null rows, partial aggregation."""
    o = F.struct(*[F.col(c) for c in order])
    aggs = [F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), o)).alias(c) for c in cols]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def lookup_map(df: DataFrame, table: DataFrame, key: str, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    """JN7: key -> value map (``Series.map``), missing -> default."""
    j = df.drop(*[c for c in cols if c in df.columns]).join(table.select(key, *cols), on=key, how="left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(default)) for c in cols})


def cluster_target_rate(df: DataFrame, *, cluster: str = "geo_cluster", target: str = "target", k: int = 8,
                        fit_on: DataFrame | None = None) -> DataFrame:
    """AG24: target mean per cluster as ``k`` sparse columns
    ``cluster_{i}_conversion`` (= rate when the row is in cluster i, else 0)."""
    src = fit_on if fit_on is not None else df
    rates = src.groupBy(cluster).agg(F.avg(target).alias("__crate"))
    j = df.join(F.broadcast(rates), on=cluster, how="left")  # at most k rows
    out = {f"cluster_{i}_conversion": F.when(F.col(cluster) == i, F.coalesce(F.col("__crate"), F.lit(0.0))).otherwise(F.lit(0.0))
           for i in range(k)}
    return j.withColumns(out).drop("__crate")
