"""Nearest-neighbour spatial join (JN1) over a static spatial index.

The index is a packed sort-tile tree in numpy arrays: stops are cut into strips
by longitude and sorted by latitude within them, LEAF consecutive stops share a
box, and FAN consecutive boxes share a box of the next level.  All points of a
batch are searched together, level by level: a greedy descent gives each point a
first stop, then branch and bound follows only boxes that are no farther than the
best stop so far.  Distances to boxes and to stops are rounded alike, so the
search is exact, ties included; points far from all stops cost as many steps as
any other.

A stop table of at most BROADCAST_STOPS rows (a checked bound) is one index that
is broadcast, and the points stay where they are.  A larger one is cut by space
into shards of SHARD_STOPS, each with the same index: the distinct coordinates
visit the shard whose box is nearest, then those whose box is no farther than
what was found there, and the answer is joined back.  Ties go to the smallest
stop id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from stopcast.semantics import require
from stopcast.session import materialize

BROADCAST_STOPS = 2_000_000     # 24 bytes each, their boxes and ids
SHARD_STOPS = 250_000
POINT_ROWS = 100_000            # coordinates that meet a shard in one block
LEAF, FAN = 16, 16
POINTS = 4096                   # points searched at once


class StopIndex:
    """Packed tree over stops; ``rank`` decides between stops of equal distance."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, rank: np.ndarray):
        n = len(lat)
        strips = max(1, math.ceil(math.sqrt(n / LEAF)))
        strip = np.empty(n, np.int64)
        strip[np.argsort(lon, kind="stable")] = np.arange(n) // max(1, math.ceil(n / strips))
        self.order = np.lexsort((lat, strip))
        self.lat, self.lon, self.rank = lat[self.order], lon[self.order], rank[self.order]
        self.levels: list[tuple[np.ndarray, ...]] = []      # leaves first; boxes (south, north, west, east)
        box = (self.lat, self.lat, self.lon, self.lon)
        width = LEAF
        while n and (not self.levels or len(self.levels[-1][0]) > FAN):
            cut = np.arange(0, len(box[0]), width)
            box = tuple(f.reduceat(b, cut) for f, b in zip((np.minimum, np.maximum) * 2, box, strict=True))
            self.levels.append(box)
            width = FAN

    def search(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of the nearest stop, squared distance) of every point; -1 without stops."""
        row, best = np.full(len(lat), -1), np.full(len(lat), np.inf)
        if len(self.lat):
            for a in range(0, len(lat), POINTS):
                s = slice(a, a + POINTS)
                row[s], best[s] = self._some(lat[s], lon[s])
        return np.where(row >= 0, self.order[row], -1) if len(self.lat) else row, best

    def _some(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(lat)
        best, low, row = np.full(n, np.inf), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)

        def look(who: np.ndarray, leaf: np.ndarray) -> None:
            """The stops of ``leaf`` for the points ``who``."""
            at = leaf[:, None] * LEAF + np.arange(LEAF)
            inside = at < len(self.lat)
            at = np.minimum(at, len(self.lat) - 1)
            gap, side = self.lat[at] - lat[who, None], self.lon[at] - lon[who, None]
            d2 = np.where(inside, gap * gap + side * side, np.inf).ravel()
            who, at = np.repeat(who, LEAF), at.ravel()
            by = np.lexsort((self.rank[at], d2, who))
            first = by[np.unique(who[by], return_index=True)[1]]
            p, d, r = who[first], d2[first], self.rank[at[first]]
            better = (d < best[p]) | ((d == best[p]) & (r < low[p]))
            best[p[better]], low[p[better]], row[p[better]] = d[better], r[better], at[first][better]

        every = np.arange(n)
        # greedy descent: the nearest box of every level
        top = len(self.levels[-1][0])
        node = self._from(-1, np.repeat(every, top), np.tile(np.arange(top), n), lat, lon).reshape(n, top).argmin(axis=1)
        for level in range(len(self.levels) - 2, -1, -1):
            child = node[:, None] * FAN + np.arange(FAN)
            d = self._from(level, np.repeat(every, FAN), child.ravel(), lat, lon).reshape(n, FAN)
            node = node * FAN + d.argmin(axis=1)
        look(every, node)
        # branch and bound: boxes no farther than the best so far
        who, nodes = np.repeat(every, top), np.tile(np.arange(top), n)
        for level in range(len(self.levels) - 1, -1, -1):
            near = self._from(level, who, nodes, lat, lon) <= best[who]
            who, nodes = who[near], nodes[near]
            if level:
                who, nodes = np.repeat(who, FAN), (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        for a in range(0, len(who), 65536):
            w, leaf = who[a:a + 65536], nodes[a:a + 65536]
            near = self._from(0, w, leaf, lat, lon) <= best[w]
            if near.any():
                look(w[near], leaf[near])
        return row, best

    def _from(self, level: int, who: np.ndarray, node: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        """Squared distances of points to boxes; infinite for boxes that are not there."""
        boxes = self.levels[level]
        there = node < len(boxes[0])
        south, north, west, east = (b[np.where(there, node, 0)] for b in boxes)
        return np.where(there, box_distance(lat[who], lon[who], south, north, west, east), np.inf)


def box_distance(lat: np.ndarray, lon: np.ndarray, south: np.ndarray, north: np.ndarray, west: np.ndarray,
                 east: np.ndarray) -> np.ndarray:
    gap = np.maximum(0.0, np.maximum(south - lat, lat - north))
    side = np.maximum(0.0, np.maximum(west - lon, lon - east))
    return gap * gap + side * side


def _finite(*cols: Column) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(ok, F.lit(False))


def _broadcast(left: DataFrame, s: DataFrame, lat: Column, lon: Column) -> DataFrame:
    """``left`` with ``__near`` (id, d2): the index of ``s`` is broadcast."""
    kind = s.schema["__sid"].dataType
    got = s.orderBy("__sid").toArrow()
    n = got.num_rows
    index = StopIndex(got["__slat"].to_numpy(), got["__slon"].to_numpy(), np.arange(n))
    sent = left.sparkSession.sparkContext.broadcast((got["__sid"].to_pandas().to_numpy(), index))

    @F.pandas_udf(StructType([StructField("id", kind), StructField("d2", DoubleType())]))
    def find(la: pd.Series, lo: pd.Series) -> pd.DataFrame:
        ids, index = sent.value
        la, lo = la.to_numpy("float64", na_value=np.nan), lo.to_numpy("float64", na_value=np.nan)
        row, d2 = np.full(len(la), -1), np.full(len(la), np.nan)
        ok = np.isfinite(la) & np.isfinite(lo)
        point, back = np.unique(la[ok] + 1j * lo[ok], return_inverse=True)
        r, d = index.search(point.real, point.imag)
        row[ok], d2[ok] = r[back], d[back]
        found = pd.Series([None] * len(la), dtype=object)
        found[row >= 0] = ids[row[row >= 0]]
        return pd.DataFrame({"id": found, "d2": pd.Series(d2).astype(object).where(row >= 0, None)})

    return left.withColumn("__near", find(lat, lon))


def _tiles(sample: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(longitude cuts, latitude cuts of every strip) from a sample of (lat, lon):
    strips of equal numbers, and tiles of equal numbers in each."""
    strips = math.ceil(math.sqrt(shards))
    per = math.ceil(shards / strips)
    at = np.arange(1, strips) / strips
    west = np.quantile(sample[:, 1], at) if strips > 1 else np.zeros(0)
    strip = np.searchsorted(west, sample[:, 1], "right")
    cuts = [np.quantile(sample[strip == i, 0], np.arange(1, per) / per) if (strip == i).any() else np.zeros(per - 1)
            for i in range(strips)]
    return west, np.array(cuts).reshape(strips, per - 1)


def _routed(left: DataFrame, s: DataFrame, n: int, lat: Column, lon: Column, shard_stops: int) -> DataFrame:
    """``left`` with ``__near`` (id, d2): shards by space, visited by the distinct coordinates."""
    spark = left.sparkSession
    kind = s.schema["__sid"].dataType
    shards = math.ceil(n / shard_stops)
    pick = F.pmod(F.xxhash64("__slat", "__slon"), F.lit(max(1, n // (256 * shards)))) == 0
    sample = s.where(pick).select("__slat", "__slon").limit(1024 * shards).toArrow()
    if not sample.num_rows:
        sample = s.select("__slat", "__slon").limit(1024 * shards).toArrow()
    west, south = _tiles(np.column_stack([c.to_numpy() for c in sample.columns]), shards)

    @F.pandas_udf(IntegerType())
    def tile(la: pd.Series, lo: pd.Series) -> pd.Series:
        strip = np.searchsorted(west, lo.to_numpy(), "right")
        inside = (la.to_numpy()[:, None] >= south[strip]).sum(axis=1)
        return pd.Series((strip * (south.shape[1] + 1) + inside).astype(np.int32))

    placed = materialize(s.withColumn("__tile", tile("__slat", "__slon")))
    rows = (placed.groupBy("__tile").agg(F.min("__slat"), F.max("__slat"), F.min("__slon"), F.max("__slon"))
            .orderBy("__tile").collect())       # one row a shard
    names, boxes = np.array([r[0] for r in rows]), tuple(np.array([r[i] for r in rows]) for i in range(1, 5))
    coords = (left.select(lat.alias("__plat"), lon.alias("__plon")).where(_finite(F.col("__plat"), F.col("__plon"))).distinct()
              .withColumn("__d2", F.lit(float("inf"))))

    def visits(rest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """The nearest shard of every point; then all others within its distance so far."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                la, lo, best = (b.column(c).to_numpy() for c in ("__plat", "__plon", "__d2"))
                step = max(1, 2_000_000 // len(names))
                for a in range(0, len(la), step):
                    d = box_distance(la[a:a + step, None], lo[a:a + step, None], *boxes)
                    first = d.argmin(axis=1)
                    if rest:
                        near = d <= best[a:a + step, None]
                        near[np.arange(len(d)), first] = False
                        i, j = np.nonzero(near)
                    else:
                        i, j = np.arange(len(d)), first
                    yield pa.RecordBatch.from_arrays([pa.array(la[a + i]), pa.array(lo[a + i]), pa.array(names[j].astype(np.int32))],
                                                     ["__plat", "__plon", "__tile"])
        return run

    schema = StructType([StructField("__plat", DoubleType()), StructField("__plon", DoubleType()), StructField("__d2", DoubleType()),
                         StructField("__sid", kind)])

    def meet(points: pa.Table, stops: pa.Table) -> pa.Table:
        if not (points.num_rows and stops.num_rows):
            return pa.Table.from_batches([], pa.schema([("__plat", pa.float64()), ("__plon", pa.float64()), ("__d2", pa.float64()),
                                                        ("__sid", stops.schema.field("__sid").type)]))
        ids = stops["__sid"].to_numpy(zero_copy_only=False)
        rank = np.empty(len(ids), np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        index = StopIndex(stops["__slat"].to_numpy(), stops["__slon"].to_numpy(), rank)
        row, d2 = index.search(points["__plat"].to_numpy(), points["__plon"].to_numpy())
        return pa.table({"__plat": points["__plat"], "__plon": points["__plon"], "__d2": pa.array(d2),
                         "__sid": stops["__sid"].take(pa.array(row))})

    def met(asks: DataFrame, rest: bool) -> DataFrame:
        seen = materialize(asks.mapInArrow(visits(rest), "__plat double, __plon double, __tile int"))
        parts = F.broadcast(spark.createDataFrame(     # one row a shard
            [(r[0], math.ceil(r[1] / POINT_ROWS)) for r in seen.groupBy("__tile").count().collect()], "__tile int, __parts int"))
        p = seen.join(parts, "__tile").select(
            F.col("__tile").alias("__t"), F.pmod(F.xxhash64("__plat", "__plon"), F.col("__parts")).cast("int").alias("__part"),
            F.col("__plat").alias("__plat"), F.col("__plon").alias("__plon"))
        q = placed.join(parts, "__tile").select(
            F.col("__tile").alias("__t"), F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"),
            *[F.col(c).alias(c) for c in ("__sid", "__slat", "__slon")])
        return p.groupBy("__t", "__part").cogroup(q.groupBy("__t", "__part")).applyInArrow(meet, schema)

    first = materialize(met(coords, False))
    found = first.unionByName(met(first.select("__plat", "__plon", "__d2"), True))
    best = (found.groupBy("__plat", "__plon")
            .agg(F.min(F.struct(F.col("__d2").alias("d2"), F.col("__sid").alias("id"))).alias("__near")))
    return left.join(best, (lat == F.col("__plat")) & (lon == F.col("__plon")), "left").drop("__plat", "__plon")


def nearest_join(left: DataFrame, stops: DataFrame, *, lat: str, lon: str, stop_id: str = "stop_id",
                 stop_lat: str = "stop_lat", stop_lon: str = "stop_lon", out: str = "nearest_stop_id",
                 out_dist: str | None = None, broadcast_stops: int = BROADCAST_STOPS, shard_stops: int = SHARD_STOPS) -> DataFrame:
    """Add ``out`` (and optionally ``out_dist``, Euclidean degrees) to every
    row of ``left``: the stop with the smallest Euclidean lat/lon distance.
    Rows with a null or non-finite coordinate get NULL; stops with such
    coordinates are ignored.  Of stops at one place the smallest id counts.  Up
    to ``broadcast_stops`` places are one broadcast index; beyond, shards of about
    ``shard_stops`` are visited."""
    require(left, [lat, lon], "nearest_join")
    require(stops, [stop_id, stop_lat, stop_lon], "nearest_join (stops)")
    s = (stops.select(F.col(stop_id).alias("__sid"), F.col(stop_lat).cast("double").alias("__slat"),
                      F.col(stop_lon).cast("double").alias("__slon"))
         .where(_finite(F.col("__slat"), F.col("__slon")) & F.col("__sid").isNotNull())
         .groupBy("__slat", "__slon").agg(F.min("__sid").alias("__sid")))
    la, lo = F.col(lat).cast("double"), F.col(lon).cast("double")
    if s.limit(broadcast_stops + 1).count() <= broadcast_stops:
        j = _broadcast(left, s, la, lo)
    else:
        s = materialize(s)
        j = _routed(left, s, s.count(), la, lo, shard_stops)
    o: list[Any] = [*[F.col(c) for c in left.columns], F.col("__near.id").alias(out)]
    if out_dist:
        o.append(F.sqrt("__near.d2").alias(out_dist))
    return j.select(*o)
