"""Crowding label from distinct users per (stop, time bin) (AG1, SC6, SC12, JN2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.semantics import col, require

# Fixed values of the reference: class names and the binary map.
CLASS_LOW, CLASS_MID, CLASS_HIGH = "Baixa", "Média", "Alta"
BINARY_LOW, BINARY_NOT_LOW = "Baixa", "Nao_Baixa"


def parse_width(width: str) -> int:
    """'2 minutes' / '6 hours' / '30 seconds' -> seconds."""
    n, unit = width.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def time_floor(ts: str | Column, width: str = "2 minutes") -> Column:
    """SC6: floor a timestamp to the bin width (epoch aligned, as pandas
    ``dt.floor`` for widths dividing a day)."""
    sec = parse_width(width)
    return F.timestamp_seconds(F.floor(F.unix_seconds(col(ts)) / F.lit(sec)) * F.lit(sec))


def users_per_bin(df: DataFrame, *, stop: str = "gtfs_stop_id", user: str = "user_pseudo_id",
                  ts: str = "event_timestamp", width: str = "2 minutes", approx: bool = False) -> DataFrame:
    """AG1: distinct users per (stop, tumbling bin) -> (stop, time_bin, user_count).

    Exact distinct is planned by Spark as a (stop, bin, user) partial
    aggregate first, so hot stops are combined map-side; ``approx`` switches
    to HyperLogLog++ for very large bins.  Rows with a NULL stop are dropped
    (pandas groupby drops NaN keys)."""
    cnt = F.approx_count_distinct(user) if approx else F.countDistinct(user)
    return (df.where(F.col(stop).isNotNull())
              .groupBy(F.col(stop).alias(stop), time_floor(ts, width).alias("time_bin"))
              .agg(cnt.cast("long").alias("user_count")))


def crowding_class(n: str | Column) -> Column:
    """SC12: pd.cut(n, [0,1,2,inf], right=True): 1 -> Baixa, 2 -> Média, >=3 -> Alta."""
    x = col(n)
    return (F.when((x > 0) & (x <= 1), F.lit(CLASS_LOW))
             .when((x > 1) & (x <= 2), F.lit(CLASS_MID))
             .when(x > 2, F.lit(CLASS_HIGH)))


def binary_class(c: str | Column) -> Column:
    """JN9: Baixa -> Baixa; Média, Alta -> Nao_Baixa."""
    x = col(c)
    return F.when(x == CLASS_LOW, F.lit(BINARY_LOW)).when(x.isin(CLASS_MID, CLASS_HIGH), F.lit(BINARY_NOT_LOW))


def binary_target(c: str | Column) -> Column:
    """JN9: Baixa -> 0, Nao_Baixa -> 1."""
    x = col(c)
    return F.when(x == BINARY_LOW, F.lit(0)).when(x == BINARY_NOT_LOW, F.lit(1))


def join_window_label(df: DataFrame, *, stop: str = "gtfs_stop_id", user: str = "user_pseudo_id",
                      ts: str = "event_timestamp", width: str = "2 minutes", approx: bool = False) -> DataFrame:
    """JN2: attach ``lotacao_proxy_binaria`` (and the 3-class proxy) to each event.

    Left equi-join of events with the (stop, bin) counts.  The count table
    is co-partitioned on (stop, bin) by its aggregate; AQE broadcasts it when
    small.  Events without stop get NULL labels."""
    require(df, [stop, user, ts], "join_window_label")
    counts = users_per_bin(df, stop=stop, user=user, ts=ts, width=width, approx=approx)
    ev = df.withColumn("time_bin", time_floor(ts, width))
    j = ev.join(counts, on=[stop, "time_bin"], how="left")
    return (j.withColumn("lotacao_proxy", crowding_class("user_count"))
             .withColumn("lotacao_proxy_binaria", binary_class("lotacao_proxy"))
             .drop("time_bin", "user_count"))
