"""Streaming re-aims: run to completion on the
events file, then compared with the batch oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.queries.q_history import _hist_sql
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, snap, with_
from stopcast.semantics import rounded
from stopcast.streaming import live as L


@query("stream_users_per_bin", with_(MODEL_EVENTS) + """
SELECT gtfs_stop_id, strftime(to_timestamp(floor(epoch(event_timestamp) / 120) * 120), '%Y-%m-%d %H:%M:%S') AS time_bin,
       count(DISTINCT user_pseudo_id) AS user_count FROM model_events WHERE gtfs_stop_id IS NOT NULL GROUP BY ALL""")
def q_stream_users_per_bin(spark, sf):
    """ST1: AG1 as a watermarked streaming aggregation (update mode)."""
    s = L.users_per_bin_stream(L.read_events_stream(spark, sf))
    path = L.run_to_table(s, spark, "st1")
    r = L.latest(spark, path, ["gtfs_stop_id", "time_bin"], "gtfs_stop_id int, time_bin timestamp, user_count long")
    return r.select(F.col("gtfs_stop_id").cast("long").alias("gtfs_stop_id"),
                    F.date_format("time_bin", "yyyy-MM-dd HH:mm:ss").alias("time_bin"), "user_count")


_ST2 = ("SELECT event_id, user_pseudo_id AS key, user_hist_count AS hist_count, user_hist_conversion_rate AS "
        "hist_conversion_rate, user_recency_days AS recency_days FROM (" +
        _hist_sql([("user", "user_pseudo_id", True)], 0, extra="user_pseudo_id, ") + ")")


@query("stream_hist", _ST2)
def q_stream_hist(spark, sf):
    """ST2: per-user history carried in streaming state."""
    events, end = L.with_end(L.read_events_stream(spark, sf))
    path = L.run_to_table(L.history_stream(events), spark, "st2", mode="append", end=end)
    r = spark.read.parquet(path).drop("batch_id")
    return rounded(r)
