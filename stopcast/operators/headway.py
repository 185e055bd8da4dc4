"""GTFS service headway per (stop, hour) (JN3, AG6, AG5, JN4, SC27)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.semantics import col, require

# Fixed value of the reference: headway when a stop/hour has no service.
HEADWAY_DEFAULT = 3600.0


def split_hour(s: str | Column) -> Column:
    """SC27: 'HH:MM:SS' -> int hour (GTFS hours may exceed 23)."""
    return F.split(col(s), ":").getItem(0).cast("int")


def headway_base(stop_times: DataFrame, frequencies: DataFrame) -> DataFrame:
    """JN3: stop_times(trip_id, stop_id) x frequencies(trip_id, start_time,
    headway_secs) inner on trip_id -> (stop_id, trip_id, start_time,
    start_hour, headway_secs)."""
    f = frequencies.select("trip_id", "start_time", split_hour("start_time").alias("start_hour"),
                           F.col("headway_secs").cast("double").alias("headway_secs"))
    return stop_times.select("trip_id", "stop_id").join(f, on="trip_id", how="inner")


def dedupe(base: DataFrame) -> DataFrame:
    """AG6: one row per (stop, hour, trip).  'Keep first in file order' is
    made deterministic as the row with the earliest start_time (then the
    smallest headway)."""
    return (base.groupBy("stop_id", "start_hour", "trip_id")
                .agg(F.min_by("headway_secs", F.struct("start_time", "headway_secs")).alias("headway_secs")))


def headway_avg(stop_times: DataFrame, frequencies: DataFrame) -> DataFrame:
    """AG5: mean headway per (stop_id, start_hour) -> headway_avg_stop_hour.

    Both sides are de-duplicated before the join (which gives what ``dedupe``
    of the joined rows would): one row per (trip, hour) of the frequencies,
    one per (trip, stop) of the stop times."""
    f = (frequencies.select("trip_id", "start_time", split_hour("start_time").alias("start_hour"),
                            F.col("headway_secs").cast("double").alias("headway_secs"))
         .groupBy("trip_id", "start_hour")
         .agg(F.min_by("headway_secs", F.struct("start_time", "headway_secs")).alias("headway_secs")))
    d = stop_times.select("trip_id", "stop_id").distinct().join(f, "trip_id")
    return d.groupBy("stop_id", "start_hour").agg(F.avg("headway_secs").alias("headway_avg_stop_hour"))


def join_headway(df: DataFrame, stop_times: DataFrame, frequencies: DataFrame, *,
                 stop: str = "gtfs_stop_id", hour: str = "time_hour") -> DataFrame:
    """JN4: left join on (stop, hour) with differently named keys; NULL -> 3600.

    The (stop, hour) table is bounded by stops x hours; AQE broadcasts it at
    runtime when it fits, otherwise it is a shuffle join."""
    require(df, [stop, hour], "join_headway")
    require(stop_times, ["trip_id", "stop_id"], "join_headway (stop_times)")
    require(frequencies, ["trip_id", "start_time", "headway_secs"], "join_headway (frequencies)")
    h = headway_avg(stop_times, frequencies)
    cond = [F.col(stop).cast("string") == F.col("__hs"), F.col(hour) == F.col("__hh")]
    j = df.join(h.select(F.col("stop_id").alias("__hs"), F.col("start_hour").alias("__hh"), "headway_avg_stop_hour"),
                on=cond, how="left")
    return (j.drop("__hs", "__hh")
             .withColumn("headway_avg_stop_hour", F.coalesce("headway_avg_stop_hour", F.lit(HEADWAY_DEFAULT))))
