"""Exact top-k inner products by no-random-access aggregation.

Vectors become integers floor(scale * x).  Each dimension is a list of a
shard's candidates sorted by value; a query reads every list from its better
end (the largest values first where its weight is positive, the smallest where
it is negative), all lists to the same depth, and keeps for every candidate a
lower and an upper bound of its score: values not read yet lie between the
list's far end and the last value read.  Reading stops once the k-th best
lower bound beats the upper bound of all but a few candidates, those not yet
seen in any list included; the final scores of the few are then resolved.

Queries and candidates meet in a grid of bounded blocks; a block sends on at
most k rows a query, and a window ranks those of all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopcast.llm.common import stored

SHARD_ROWS = 8192       # candidates of a block
QUERY_ROWS = 16384      # queries of a block
CELLS = 2_000_000       # bounds held at once


class SortedLists:
    """A shard's candidates with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, uids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")      # ties go to the smaller id
        self.ids, self.uids, self.vectors = ids[order], uids[order], vectors[order]
        self.lists = np.sort(self.vectors, axis=0)

    def bounds(self, plus: np.ndarray, minus: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores after ``depth`` entries of each list."""
        v, lists, n = self.vectors, self.lists, len(self.vectors)
        top, bottom = lists[n - depth], lists[depth - 1]
        high = plus @ np.maximum(v, top).T + minus @ np.minimum(v, bottom).T
        low = plus @ np.where(v >= top, v, lists[0]).T + minus @ np.where(v <= bottom, v, lists[-1]).T
        return low, high

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query row, candidate rows, scores): its k best, own row left out."""
        n = len(self.vectors)
        biggest = float(np.abs(queries).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * max(1, queries.shape[1])
        kind = np.float32 if biggest < 1 << 24 else np.float64 if biggest < 1 << 53 else None
        place = {u: i for i, u in enumerate(self.uids.tolist())}
        mine = [place.get(u) for u in own.tolist()]
        if kind is None:        # beyond exact floating point: integers, no bounds
            for q, row in enumerate(queries):
                yield self._pick(q, np.arange(n), self.vectors @ row, mine[q], k)
            return
        as_kind = SortedLists.__new__(SortedLists)
        as_kind.vectors, as_kind.lists = self.vectors.astype(kind), self.lists.astype(kind)
        step = max(1, CELLS // max(1, n))
        for a in range(0, len(queries), step):
            some = queries[a:a + step].astype(kind)
            open_ = np.arange(len(some))
            for depth in sorted({max(1, n // 4), max(1, n // 2), n}):
                plus, minus = np.maximum(some[open_], 0), np.minimum(some[open_], 0)
                low, high = as_kind.bounds(plus, minus, depth)
                rows = [(i, mine[a + q]) for i, q in enumerate(open_.tolist()) if mine[a + q] is not None]
                if rows:
                    i, j = map(list, zip(*rows, strict=True))
                    low[i, j] = high[i, j] = -np.inf
                least = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(low), -np.inf, kind)
                alive = high >= least[:, None]
                done = (alive.sum(axis=1) <= 8 * k) | (depth == n)
                for i in np.flatnonzero(done).tolist():
                    q, few = a + int(open_[i]), np.flatnonzero(alive[i])
                    yield self._pick(q, few, self.vectors[few] @ queries[q], mine[q], k)
                open_ = open_[~done]
                if not len(open_):
                    break

    def _pick(self, q: int, rows: np.ndarray, scores: np.ndarray, own: int | None, k: int):
        if own is not None:
            rows, scores = rows[rows != own], scores[rows != own]
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return q, rows[best], scores[best]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer vectors as rows; shorter ones are padded with zeros."""
    column = column.combine_chunks()
    lens = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lens), width), np.int64)
    out[np.repeat(np.arange(len(lens)), lens), np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)] = \
        column.flatten().to_numpy()
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): every query row's k best other rows.

    Scores are exact integer inner products; ties go to the smaller vec_id.
    ``is_query`` is a condition on ``vectors``.  Other columns are ignored.
    Rows whose id or vector is null, or whose vector holds a null or
    non-finite component, take no part.  Vectors of other lengths count as
    padded with zeros.  Repeated rows are candidates (and queries) each for
    itself.  An empty table, or no query, gives an empty result.  Components
    must stay below 2**62 / scale in size, and scores within a long.
    """
    x = F.col("vector")
    ok = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    base = (vectors.select(vectors[id_col].cast("bigint").alias("id"), vectors[vector_col].cast("array<double>").alias("vector"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where(F.col("id").isNotNull() & ok)
            .select(F.monotonically_increasing_id().alias("uid"), "id", "asks",
                    F.transform(x, lambda v: F.floor(v * float(scale))).alias("vector")))
    base = stored(base, "vectors")
    n, asked, width = base.agg(F.count("*"), F.count(F.when(F.col("asks"), 1)), F.max(F.size("vector"))).first()
    shards, parts = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil((asked or 0) / QUERY_ROWS))

    def spread(to: int) -> Column:      # by row, so that no value lands in one block
        return F.pmod(F.xxhash64("uid"), F.lit(to)).cast("int")

    def every(to: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(to - 1)))

    row = [F.col("uid"), F.col("id"), F.col("vector")]
    asks = base.where("asks").select(spread(parts).alias("part"), every(shards).alias("shard"), *row)
    gives = base.select(spread(shards).alias("shard"), every(parts).alias("part"), *row)

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_uid": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            shard = SortedLists(right["id"].to_numpy(), right["uid"].to_numpy(), _matrix(right["vector"], width or 0))
            own, ids = left["uid"].to_numpy(), left["id"].to_numpy()
            for q, rows, scores in shard.top(_matrix(left["vector"], width or 0), own, k):
                out["query_uid"].append(np.full(len(rows), own[q]))
                out["query_id"].append(np.full(len(rows), ids[q]))
                out["vec_id"].append(shard.ids[rows])
                out["score"].append(scores.astype(np.int64))
        return pa.table({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()})

    found = asks.groupBy("part", "shard").cogroup(gives.groupBy("part", "shard")).applyInArrow(
        meet, "query_uid bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
