"""Hard-negative mining over rotated one-bit codes.

Vectors become integers floor(scale * x).  Each is coded in LEVELS layers: a layer
rotates what the layers before left over (a fixed random rotation), keeps the
signs, one bit a dimension, and stores how far the code vector and
that remainder align, and how long the rest is.  An anchor's product with a row
is estimated by popcounts of the row's bits and the anchor's bit planes.  What a
layer leaves over is perpendicular to its code vector, so by Cauchy and Schwarz
its product with the anchor is at most the length of the rest times the length
of the anchor's part perpendicular to the code vector.  This interval holds
always, not with a probability.  Layer after layer the intervals shrink, and
rows whose interval cannot matter drop out; what survives is scored in integers,
so results are exact.

Anchors meet rows in a grid of bounded blocks, twice: with the rows of their own
label for the positives, then with all rows for the negatives.  A label of many
rows is cut into chunks.  A block sends on a few rows for each anchor, and a
window ranks those of all blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopcast.llm.common import no_state, stored

SHARD_ROWS = 8192       # rows of a block
ANCHOR_ROWS = 4096      # anchors of a block
CELLS = 200_000         # intervals held at once
DENSE = 0.15            # share of living pairs down to which a layer takes all pairs of a block
FIRST_CUT = 3           # layers before which the intervals are too wide to drop a row
LEVELS = 6              # layers of a code
PLANES = 8              # bits of an anchor's component
SEED = 12
SLACK = 1e-9            # share of both lengths, far above the rounding of doubles


@lru_cache(2 * LEVELS)
def rotation(width: int, level: int) -> np.ndarray:
    """A layer's random rotation, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng((SEED, level)).standard_normal((width, width)))
    return q * np.sign(np.where(np.diag(r) == 0, 1, np.diag(r)))


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits of the last axis as 64-bit words."""
    width = -(-bits.shape[-1] // 64) * 64
    full = np.zeros((*bits.shape[:-1], width), bool)
    full[..., :bits.shape[-1]] = bits
    return np.packbits(full, axis=-1).view(np.uint64)


class Codes:
    """Codes of rows: ``bits[level, row, word]``, ``align[level, row]`` (the stored
    product of code vector and remainder) and ``rest[level, row]`` (its length after)."""

    def __init__(self, bits: np.ndarray, align: np.ndarray, rest: np.ndarray):
        self.bits, self.align, self.rest = bits, align, rest

    @classmethod
    def of(cls, vectors: np.ndarray) -> Codes:
        n, width = vectors.shape
        left = vectors.astype(float)
        bits, align, rest = [], [], []
        for level in range(LEVELS):
            left = left @ rotation(width, level).T if width else left
            up = left >= 0
            a = np.abs(left).sum(axis=1) / np.sqrt(max(1, width))
            left = left - np.where(up, 1.0, -1.0) * (a / np.sqrt(max(1, width)))[:, None]
            bits.append(_words(up))
            align.append(a)
            rest.append(np.sqrt((left * left).sum(axis=1)))
        return cls(np.stack(bits), np.stack(align), np.stack(rest))


class Anchors:
    """Anchors as bit planes, layer by layer: component = low + step * (0 .. 2**PLANES - 1),
    and a bound of what that rounds off."""

    def __init__(self, vectors: np.ndarray):
        width = vectors.shape[1]
        self.root = np.sqrt(max(1, width))
        turned = vectors.astype(float)
        self.length = np.sqrt((turned * turned).sum(axis=1))
        self.layers = []
        top = (1 << PLANES) - 1
        for level in range(LEVELS):
            turned = turned @ rotation(width, level).T if width else turned
            low = turned.min(axis=1) if width else np.zeros(len(turned))
            step = (turned.max(axis=1) - low) / top if width else low
            step = np.where(step > 0, step, 1.0)
            grade = np.clip(np.rint((turned - low[:, None]) / step[:, None]), 0, top).astype(np.int64)
            held = low[:, None] + step[:, None] * grade
            off = np.abs(turned - held).sum(axis=1) / self.root      # holds for any code vector
            planes = np.stack([_words((grade >> b & 1).astype(bool)) for b in range(PLANES)])
            self.layers.append((low, step, held.sum(axis=1), off, planes))

    def grid(self, level: int, bits: np.ndarray) -> np.ndarray:
        """Products of all anchors with the unit code vectors ``bits`` of a layer, by popcounts."""
        low, step, total, _, planes = self.layers[level]
        weight = np.zeros((len(low), len(bits)), np.int32)
        both = np.empty(weight.shape, np.uint64)
        for plane in planes[::-1]:
            weight <<= 1
            for w in range(bits.shape[1]):
                weight += np.bitwise_count(np.bitwise_and(plane[:, w, None], bits[None, :, w], out=both))
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        got = weight * (2.0 * step / self.root)[:, None]
        got += np.multiply.outer(2.0 * low / self.root, ones.astype(float))
        got -= (total / self.root)[:, None]
        return got

    def pairs(self, level: int, rows: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """The same for single pairs: anchor ``rows[i]`` with ``bits[i]``."""
        low, step, total, _, planes = self.layers[level]
        weight, ones = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for w in range(bits.shape[1]):
            mine = np.ascontiguousarray(bits[:, w])
            ones += np.bitwise_count(mine)
            for b in range(PLANES):
                weight += np.bitwise_count(mine & planes[b, :, w][rows]).astype(np.int64) << b
        return (2 * (low[rows] * ones + step[rows] * weight) - total[rows]) / self.root


def surviving(anchors: Anchors, codes: Codes, allowed: np.ndarray,
              cut: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the pairs that may matter.  ``allowed[anchor, row]`` are
    the pairs to look at; ``cut(low, high)`` says which still may matter, given
    the bounds of all scores (dead pairs: -inf, -inf).  All pairs of the block go
    through a layer together while many are alive, then the living ones alone."""
    size = np.sqrt(codes.align[0] ** 2 + codes.rest[0] ** 2)
    length = anchors.length
    missed = SLACK * np.multiply.outer(length, size) + SLACK
    estimate = np.zeros(allowed.shape)
    level, alive = 0, allowed.copy()
    while level < LEVELS and alive.mean() > DENSE:
        off, align = anchors.layers[level][3], codes.align[level]
        got = anchors.grid(level, codes.bits[level])
        estimate += got * align
        missed += np.multiply.outer(off, align)
        wide = _across(np.abs(got, out=got), off[:, None], length[:, None]) * codes.rest[level]
        wide += missed
        level += 1
        if level >= FIRST_CUT:
            low, high = np.where(alive, estimate - wide, -np.inf), np.where(alive, estimate + wide, -np.inf)
            alive &= cut(low, high)
    a, r = np.nonzero(alive)
    if level < LEVELS and len(a):
        estimate, missed = estimate[a, r], missed[a, r]
        while level < LEVELS:
            off, align = anchors.layers[level][3][a], codes.align[level][r]
            got = anchors.pairs(level, a, codes.bits[level][r])
            estimate += got * align
            missed += off * align
            wide = _across(np.abs(got), off, length[a]) * codes.rest[level][r] + missed
            level += 1
        low, high = np.full(alive.shape, -np.inf), np.full(alive.shape, -np.inf)
        low[a, r], high[a, r] = estimate - wide, estimate + wide
        a, r = np.nonzero(alive & cut(low, high))
    return a, r


def _across(got: np.ndarray, off: np.ndarray, length: np.ndarray) -> np.ndarray:
    """At most the length of the anchors' parts perpendicular to the code vectors."""
    along = np.maximum(0.0, got - off)
    along *= along
    return np.sqrt(np.maximum(0.0, length * length - along))


def kth(low: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of every line (-inf where there are fewer)."""
    n = low.shape[1]
    return np.partition(low, n - k, axis=1)[:, n - k] if n >= k else np.full(len(low), -np.inf)


class Rows:
    """Rows of one side of a block."""

    def __init__(self, table: pa.Table, width: int):
        by = np.lexsort((table["uid"].to_numpy(), table["id"].to_numpy()))     # ties go to the smaller id
        self.table = table = table.take(pa.array(by)).combine_chunks()
        self.uid, self.id = table["uid"].to_numpy(), table["id"].to_numpy()
        self.label = table["label"].to_numpy()
        self.vectors = matrix(table["vector"], width)

    def codes(self) -> Codes:
        n, width = self.vectors.shape
        bits = np.frombuffer(b"".join(self.table["bits"].to_pylist()), np.uint64).reshape(n, LEVELS, -(-width // 64))
        align, rest = (np.stack(self.table[c].to_pylist()).astype(float) for c in ("align", "rest"))
        return Codes(np.ascontiguousarray(bits.swapaxes(0, 1)), align.T, rest.T)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer vectors as rows; shorter ones are padded with zeros."""
    column = column.combine_chunks()
    lens = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lens), width), np.int64)
    at = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    out[np.repeat(np.arange(len(lens)), lens), at] = column.flatten().to_numpy()
    return out


def scored(a: np.ndarray, r: np.ndarray, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, pair by pair."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 65536):
        s = slice(i, i + 65536)
        out[s] = np.einsum("ij,ij->i", anchors[a[s]], rows[r[s]])
    return out


def _batches(n: int, rows: int) -> Iterator[slice]:
    step = max(1, CELLS // max(1, rows))
    return (slice(i, i + step) for i in range(0, n, step))


def best_of_label(left: Rows, right: Rows, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of each anchor's k best other rows; all rows have its label."""
    codes, found = right.codes(), []
    for s in _batches(len(left.uid), len(right.uid)):
        anchors = Anchors(left.vectors[s])
        allowed = left.uid[s][:, None] != right.uid[None, :]
        a, r = surviving(anchors, codes, allowed, lambda low, high: (high > -np.inf) & (high >= kth(low, k)[:, None]))
        score = scored(a, r, left.vectors[s], right.vectors)
        found.append(_firsts(a, r, score, a, k, s.start))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def _firsts(a: np.ndarray, r: np.ndarray, score: np.ndarray, group: np.ndarray, k: int,
            start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first of every group: highest score, then smallest row (rows are in id order)."""
    by = np.lexsort((r, -score, group))
    g = group[by]
    place = np.arange(len(g)) - np.searchsorted(g, g, "left")
    by = by[place < k]
    return a[by] + start, r[by], score[by]


def best_below(left: Rows, positives: list[np.ndarray], right: Rows, k: int, least: int,
               most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, positive score, row, score): for each of an anchor's distinct positive
    scores p the k best rows of other labels with least*p <= 100*score <= most*p."""
    codes, found = right.codes(), []
    depth = max((len(p) for p in positives), default=0)
    for s in _batches(len(left.uid), len(right.uid)):
        anchors = Anchors(left.vectors[s])
        n = len(left.uid[s])
        # bounds of the bands, a little outside and a little inside; an anchor with fewer positives has empty ones
        outer, inner = np.full((2, n, depth), np.inf), np.full((2, n, depth), np.inf)
        outer[1], inner[1] = -np.inf, -np.inf
        exact: list[tuple[int, int, int]] = []
        for i, scores in enumerate(positives[s]):
            for j, p in enumerate(scores.tolist()):
                lo, hi = -(-least * p // 100), most * p // 100
                if lo <= hi:
                    exact.append((i, lo, hi))
                    a, b = 1 + SLACK * abs(lo), 1 + SLACK * abs(hi)
                    outer[:, i, j], inner[:, i, j] = (lo - a, hi + b), (lo + a, hi - b)
        there = np.isfinite(inner[0])

        def cut(low: np.ndarray, high: np.ndarray, outer: np.ndarray = outer, inner: np.ndarray = inner) -> np.ndarray:
            # what surely lies in the bands of all positives bounds them all; the bands one by one only for the few
            sure = (low >= inner[0].max(axis=1, where=there, initial=-np.inf)[:, None]) & (
                high <= inner[1].min(axis=1, where=there, initial=np.inf)[:, None])
            least_kept = np.maximum(kth(np.where(sure, low, -np.inf), k), outer[0].min(axis=1))
            keep = (high >= least_kept[:, None]) & (low <= outer[1].max(axis=1)[:, None]) & (high > -np.inf)
            if keep.mean() > DENSE:
                return keep
            some = np.zeros(low.shape, bool)
            for j in range(depth):
                sure = (low >= inner[0][:, j, None]) & (high <= inner[1][:, j, None]) & keep
                third = kth(np.where(sure, low, -np.inf), k)[:, None]
                some |= (high >= np.maximum(outer[0][:, j, None], third)) & (low <= outer[1][:, j, None])
            return some & keep

        other = left.label[s][:, None] != right.label[None, :]
        a, r = surviving(anchors, codes, other, cut)
        score = scored(a, r, left.vectors[s], right.vectors)
        edge = np.searchsorted(a, np.arange(n + 1))
        done: dict[tuple[int, int], tuple] = {}
        for i, lo, hi in exact:
            part = slice(edge[i], edge[i + 1])
            ok = (score[part] >= lo) & (score[part] <= hi)
            rows, values = r[part][ok], score[part][ok]
            top = np.lexsort((rows, -values))[:k]
            done[i, lo, hi] = rows[top], values[top]
        for i, scores in enumerate(positives[s]):
            for p in scores.tolist():
                rows, values = done.get((i, -(-least * p // 100), most * p // 100), (np.zeros(0, np.int64),) * 2)
                found.append((np.full(len(rows), i + s.start), np.full(len(rows), p), rows, values))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4


def _coded(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_state()
        for batch in batches:
            if batch.num_rows:
                codes = Codes.of(matrix(pa.chunked_array([batch.column("vector")]), width))
                bits = np.ascontiguousarray(codes.bits.swapaxes(0, 1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([b.tobytes() for b in bits], pa.binary()),
                     *[pa.array(list(np.ascontiguousarray(x.T)), pa.list_(pa.float64())) for x in (codes.align, codes.rest)]],
                    [*batch.schema.names, "bits", "align", "rest"])
    return run


def mine(vectors: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
         scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its ``positives`` best other rows of its label; for
    each, the ``negatives`` best rows of other labels whose score n satisfies
    least * p <= 100 * n <= most * p (p the positive's score).  Scores are integer
    inner products of floor(scale * x), ties go to the smaller id.

    ``is_anchor`` and ``label`` are expressions over ``vectors`` (its column
    ``label`` if none is given); other columns are ignored.  Rows whose id, label
    or vector is null, or whose vector holds a null or non-finite component, take
    no part.  Shorter vectors count as padded with zeros.  Repeated rows are
    anchors, positives and negatives each for itself.  An empty table, or no
    anchor, gives an empty result.  Components must stay below 2**62 / scale in
    size, and scores times 100 within a long.
    """
    x = F.col("vector")
    ok = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    base = (vectors.select(vectors[id_col].cast("bigint").alias("id"), vectors[vector_col].cast("array<double>").alias("vector"),
                           F.coalesce(is_anchor, F.lit(False)).alias("asks"),
                           (label if label is not None else vectors["label"]).cast("bigint").alias("label"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ok)
            .select(F.monotonically_increasing_id().alias("uid"), "id", "label", "asks",
                    F.transform(x, lambda v: F.floor(v * float(scale))).alias("vector")))
    width = base.agg(F.max(F.size("vector"))).first()[0] or 0
    base = stored(base.mapInArrow(_coded(width), "uid bigint, id bigint, label bigint, asks boolean, vector array<bigint>, "
                                                 "bits binary, align array<double>, rest array<double>"), "codes")
    def own(*names: str) -> list[Column]:      # each side of a block with columns of its own
        return [F.col(c).alias(c) for c in names]

    row = ["uid", "id", "label", "vector"]
    code = ["bits", "align", "rest"]

    def spread(c: str, to: Column) -> Column:      # by row, so that no value lands in one block
        return F.pmod(F.xxhash64(c), to).cast("int")

    def every(to: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), (to - 1).cast("int")))

    def blocks(n: str, size: int) -> Column:
        return F.ceil(F.col(n) / size).cast("int")

    # positives: an anchor meets the chunks of its label
    labels = (base.groupBy("label").agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("m"))
              .where("m > 0").select("label", blocks("n", SHARD_ROWS).alias("chunks"), blocks("m", ANCHOR_ROWS).alias("parts")))
    both = base.join(labels, "label")
    asks = both.where("asks").select(spread("uid", F.col("parts")).alias("part"), every(F.col("chunks")).alias("chunk"), *own(*row))
    gives = both.select(spread("uid", F.col("chunks")).alias("chunk"), every(F.col("parts")).alias("part"), *own(*row, *code))

    def own_label(left: pa.Table, right: pa.Table) -> pa.Table:
        no_state()
        names = ["anchor", "anchor_id", "positive", "positive_id", "score"]
        if not (left.num_rows and right.num_rows):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        q, t = Rows(left, width), Rows(right, width)
        a, r, score = best_of_label(q, t, positives)
        return pa.table(dict(zip(names, (q.uid[a], q.id[a], t.uid[r], t.id[r], score), strict=True)))

    near = asks.groupBy("label", "chunk", "part").cogroup(gives.groupBy("label", "chunk", "part")).applyInArrow(
        own_label, "anchor bigint, anchor_id bigint, positive bigint, positive_id bigint, score bigint")
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id", "positive")
    near = stored(near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives).drop("n"), "positives")

    # negatives: an anchor with its positives' scores (a few) meets all shards
    total, asked = base.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    shards, parts = (F.lit(max(1, -(-n // size))) for n, size in ((total, SHARD_ROWS), (asked, ANCHOR_ROWS)))
    wanted = near.groupBy("anchor").agg(F.collect_set("score").alias("scores"))
    asks = (base.where("asks").join(wanted, F.col("uid") == F.col("anchor"))
            .select(spread("uid", parts).alias("part"), every(shards).alias("shard"), *own(*row, "scores")))
    gives = base.select(spread("uid", shards).alias("shard"), every(parts).alias("part"), *own(*row, *code))

    def other_labels(left: pa.Table, right: pa.Table) -> pa.Table:
        no_state()
        names = ["anchor", "score", "negative", "negative_id", "negative_score"]
        if not (left.num_rows and right.num_rows):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        q, t = Rows(left, width), Rows(right, width)
        scores = [np.array(p, np.int64) for p in q.table["scores"].to_pylist()]
        a, p, r, score = best_below(q, scores, t, negatives, least, most)
        return pa.table(dict(zip(names, (q.uid[a], p, t.uid[r], t.id[r], score), strict=True)))

    far = asks.groupBy("part", "shard").cogroup(gives.groupBy("part", "shard")).applyInArrow(
        other_labels, "anchor bigint, score bigint, negative bigint, negative_id bigint, negative_score bigint")
    # ranked once for each score of an anchor; positives of equal scores share the rows
    order = Window.partitionBy("anchor", "score").orderBy(F.desc("negative_score"), "negative_id", "negative")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return (near.join(far, ["anchor", "score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"))
