"""Decision trees and forests over large tables, a tree a task (MD1, MD2, MD11).

MLlib grows all trees level by level with a shuffle of statistics of every node, so
deep trees cost nodes times partitions.  Here every feature is cut into bins once
(bounds from a bounded sample, as MLlib's), a row is one byte a feature, and the
table of bytes, at most PACK_BYTES, goes to the executors.  A task grows whole trees
from it, one at a time, adds up the scores of the test rows and lets the tree go:
nobody holds a forest.  Larger tables keep MLlib.

Trees are MLlib's: Gini impurity over weighted rows, Poisson bootstrap, a random
subset of the features at every node, at least ``least`` drawn rows a leaf, sibling
leaves of one prediction merged, importances normalised tree by tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

PACK_BYTES = 160_000_000    # of the training and test rows' bytes together
SAMPLE_ROWS = 10_000        # rows that the bounds of the bins come from (MLlib's number)
BLOCK = 20_000              # rows of a block
LEAST_GAIN = 1e-14          # of a split; less is rounding


@dataclass
class Rule:
    """What a tree is grown by; ``some``: features looked at in a node."""
    depth: int
    least: int
    some: int
    bootstrap: bool
    seed: int


@dataclass
class Tree:
    """Nodes level by level: feature (-1: a leaf), bin up to which rows go left, left child
    (the right one is next), weight of class 0 and 1, decrease of the weighted impurity."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    w0: np.ndarray
    w1: np.ndarray
    gain: np.ndarray
    starts: list[int]

    @property
    def nodes(self) -> int:
        return 2 * int((self.feature >= 0).sum()) + 1

    @property
    def depth(self) -> int:
        inner = np.flatnonzero(self.feature >= 0)
        return int(np.searchsorted(self.starts, inner[-1], "right")) if len(inner) else 0

    def merge(self) -> None:
        """Sibling leaves of one prediction become one leaf, from the deepest up."""
        says = self.w1 > self.w0
        for a, b in zip(self.starts[-2::-1], self.starts[:0:-1], strict=True):
            at = a + np.flatnonzero(self.feature[a:b] >= 0)
            lo = self.left[at]
            gone = at[(self.feature[lo] < 0) & (self.feature[lo + 1] < 0) & (says[lo] == says[lo + 1])]
            self.feature[gone] = -1

    def importances(self, features: int) -> np.ndarray:
        inner = self.feature >= 0
        got = np.bincount(self.feature[inner], weights=self.gain[inner], minlength=features)
        return got / (got.sum() or 1.0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Share of class 1 in every row's leaf."""
        at, on, flat = np.zeros(len(x), np.int32), np.arange(len(x)), x.ravel()
        while len(on):
            here = at[on]
            f = self.feature[here]
            inner = f >= 0
            on, here, f = on[inner], here[inner], f[inner]
            at[on] = self.left[here] + (flat[on * x.shape[1] + f] > self.cut[here])
        return (self.w1 / np.maximum(self.w0 + self.w1, 1e-300))[at]


def _subsets(rng: np.random.Generator, nodes: int, features: int, some: int) -> np.ndarray:
    """``some`` distinct features for every node (Floyd's draw)."""
    out = np.empty((nodes, some), np.int64)
    for s in range(some):
        top = features - some + s
        draw = rng.integers(0, top + 1, nodes)
        out[:, s] = np.where((out[:, :s] == draw[:, None]).any(axis=1), top, draw)
    return out


def _cells(cell: np.ndarray, cells: int, cnt: np.ndarray, wt: np.ndarray, w1: np.ndarray) -> tuple[np.ndarray, ...]:
    """The cells that have rows, in order, and the running sums of count, weight and weight of class 1
    up to each: from tables of all cells where they are few, by sorting the rows otherwise."""
    if cells <= 2 * len(cell):
        n = np.bincount(cell, weights=cnt, minlength=cells)
        at = np.flatnonzero(n)
        return at, np.cumsum(n[at]), *(np.cumsum(np.bincount(cell, weights=w, minlength=cells)[at]) for w in (wt, w1))
    shift = max(1, len(cell) - 1).bit_length()
    key = np.sort((cell << shift) | np.arange(len(cell)))
    row, at = key & ((1 << shift) - 1), key >> shift
    end = np.flatnonzero(np.append(at[1:] != at[:-1], True))
    return at[end], *(np.cumsum(w[row])[end] for w in (cnt, wt, w1))


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray | None, rule: Rule, tree: int) -> Tree:
    """A tree on rows of bins ``x`` with labels ``y`` (bool) and weights."""
    rng = np.random.default_rng([rule.seed & 0xFFFFFFFF, tree])
    drawn = rng.poisson(1.0, len(x)).astype(np.uint8) if rule.bootstrap else np.ones(len(x), np.uint8)
    features, bins, flat = x.shape[1], int(x.max(initial=0)) + 1, x.ravel()
    rows = np.flatnonzero(drawn)
    cnt = drawn[rows].astype(float)
    wt = cnt if w is None else cnt * w[rows]
    w1 = wt * y[rows]
    node = np.zeros(len(rows), np.int64)
    level = [np.array([a]) for a in (cnt.sum(), wt.sum(), w1.sum())]        # of the level's nodes
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("feature", "cut", "left", "w0", "w1", "gain")}
    starts, made, deep = [0], 1, 0
    while True:
        n, p, p1 = level
        is_open = (p1 > 0) & (p - p1 > 1e-12 * p) & (n >= 2 * rule.least) & (n > 1) & (deep < rule.depth)
        number = np.full(len(n), -1)
        number[is_open] = np.arange(is_open.sum())
        node = number[node]
        on = node >= 0
        rows, node, cnt, wt, w1 = rows[on], node[on], cnt[on], wt[on], w1[on]
        opened = np.flatnonzero(is_open)
        k = len(opened)
        best, feature, cut = np.full(k, -np.inf), np.full(k, -1), np.zeros(k, np.int64)
        took = np.zeros((3, k))
        chosen = _subsets(rng, k, features, rule.some) if k and rule.some < features else None
        on, op, o1 = n[opened], p[opened], p1[opened]
        for s in range(rule.some if k else 0):
            f = chosen[:, s] if chosen is not None else np.full(k, s)
            at, *sums = _cells(node * bins + flat[rows * features + f[node]], k * bins, cnt, wt, w1)
            own = at // bins
            first = np.searchsorted(own, np.arange(k))
            # running sums inside the node: what goes left if the cut is here
            ln, lw, l1 = (c - np.concatenate([[0.0], c])[first][own] for c in sums)
            i = np.flatnonzero((ln >= rule.least) & (on[own] - ln >= rule.least) & (own == np.append(own[1:], -1)))
            if not len(i):
                continue
            who, a, a1 = own[i], lw[i], l1[i]
            b, b1 = op[who] - a, o1[who] - a1
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.nan_to_num((a1 * a1 + (a - a1) ** 2) / a + (b1 * b1 + (b - b1) ** 2) / b, nan=-np.inf)
            begin = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
            top = np.maximum.reduceat(score, begin)
            holder = who[begin]
            good = top > best[holder]
            hit = np.flatnonzero(score == np.repeat(top, np.diff(np.append(begin, len(who)))))
            hit = hit[np.append(True, who[hit][1:] != who[hit][:-1])][good]        # the first of each node
            holder = holder[good]
            best[holder], feature[holder], cut[holder] = top[good], f[holder], at[i[hit]] % bins
            took[:, holder] = ln[i[hit]], a[hit], a1[hit]
        with np.errstate(invalid="ignore"):
            gain = best - (o1 * o1 + (op - o1) ** 2) / op
        split = gain > LEAST_GAIN * op
        for name, v, none in (("feature", feature, -1), ("cut", cut, 0), ("gain", gain, 0.0)):
            whole = np.full(len(n), none)
            whole[opened[split]] = v[split]
            out[name].append(whole)
        kids = np.full(len(n), 0)
        kids[opened[split]] = made + 2 * np.arange(split.sum())
        out["left"].append(kids)
        out["w0"].append(p - p1)
        out["w1"].append(p1)
        starts.append(made)
        if not split.any():
            break
        deep += 1
        made += 2 * int(split.sum())
        place = np.cumsum(split) - 1
        stay = split[node]
        rows, node, cnt, wt, w1 = rows[stay], node[stay], cnt[stay], wt[stay], w1[stay]
        node = 2 * place[node] + (flat[rows * features + feature[node]] > cut[node])
        low = took[:, split]
        both = np.stack([low, np.stack([on, op, o1])[:, split] - low], axis=2).reshape(3, -1)
        level = [both[0], both[1], np.clip(both[2], 0.0, both[1])]
    t = Tree(*(np.concatenate(out[k]) for k in ("feature", "cut", "left", "w0", "w1", "gain")), starts)
    t.feature, t.cut, t.left = t.feature.astype(np.int32), t.cut.astype(np.uint8), t.left.astype(np.int32)
    return t


def _row(features: Sequence[str] | None) -> Column:
    return vector_to_array("features") if features is None else F.array(*[F.col(c).cast("double") for c in features])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def bounds(sample: np.ndarray, max_bins: int) -> list[np.ndarray]:
    """Bounds of every feature's bins: all middles between distinct values, or, if they are too
    many, those nearest to equal shares of the rows."""
    out = []
    for x in sample.T:
        v, n = np.unique(x[~np.isnan(x)], return_counts=True)
        mid = v[:-1] / 2 + v[1:] / 2
        if len(mid) >= max_bins:
            run = np.cumsum(n)[:-1]
            ask = np.arange(1, max_bins) * (n.sum() / max_bins)
            hi = np.clip(np.searchsorted(run, ask), 1, len(run) - 1)
            mid = mid[np.unique(np.where(ask - run[hi - 1] <= run[hi] - ask, hi - 1, hi))]
        out.append(mid)
    return out


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """A byte a value: the bounds below it (a missing value comes last)."""
    return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _blocks(df: DataFrame, cuts: list[np.ndarray], carry: Sequence[str]) -> DataFrame:
    """Rows as blocks, written once: number, bytes, and the columns of ``carry`` as arrays."""
    from stopcast.session import materialize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i = 0
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                b = batch.slice(a, BLOCK)
                ends = pa.array([0, b.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(TaskContext.get().partitionId() << 32) + i]), pa.array([_binned(_matrix(b.column("__x")), cuts).tobytes()], pa.binary()),
                     *[pa.ListArray.from_arrays(ends, b.column(c)) for c in carry]], ["block", "x", *carry])
                i += 1
    return materialize(df.mapInArrow(run, StructType([StructField("block", LongType()), StructField("x", BinaryType()),
                                                      *[StructField(c, ArrayType(df.schema[c].dataType)) for c in carry]])))


def fits(rows: int, features: int) -> bool:
    return rows * features <= PACK_BYTES


def rule_of(estimator, features: int) -> tuple[Rule, int]:
    """Rule and number of trees of an MLlib tree or forest."""
    forest = isinstance(estimator, RandomForestClassifier)
    trees = estimator.getNumTrees() if forest else 1
    some = estimator.getFeatureSubsetStrategy() if forest else "all"
    some = "sqrt" if some == "auto" and trees > 1 else some
    if some in ("all", "auto"):
        m = features
    elif some in ("sqrt", "log2", "onethird"):
        m = {"sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}[some]
    else:
        m = min(int(some), features) if "." not in some else max(1, math.ceil(float(some) * features))
    return Rule(estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), m, forest and trees > 1 and estimator.getBootstrap(), estimator.getSeed()), trees


def fit(estimator, train: DataFrame, features: Sequence[str] | None, test: DataFrame | None = None, id_col: str = "event_id",
        ) -> tuple[dict, DataFrame | None]:
    """Grows a tree or forest: (importances, trees with a split, nodes and depth of the largest tree),
    and the scores (id, label, score) of ``test``."""
    spark = train.sparkSession
    weight = estimator.getWeightCol() if estimator.isDefined(estimator.weightCol) and estimator.getWeightCol() else None
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    ready = train.select(_row(features).alias("__x"), F.col("label").cast("double").alias("y"), w.alias("w"))
    n = ready.count()
    if ready.where("y IS NULL OR y NOT IN (0, 1) OR w IS NULL OR w < 0 OR isnan(w)").limit(1).count():
        raise ValueError("labels must be 0 or 1, weights numbers from 0 on")
    picked = ready.select("__x").sample(min(1.0, 1.2 * SAMPLE_ROWS / max(1, n)), seed=estimator.getSeed() & 0x7FFFFFFF).limit(2 * SAMPLE_ROWS).toArrow()["__x"]
    sample = _matrix(picked.combine_chunks())
    cuts = bounds(sample, min(estimator.getMaxBins(), 256))
    width = len(cuts)
    rule, trees = rule_of(estimator, width)
    kept = ["y", "w"] if weight else ["y"]
    got = _blocks(ready.select("__x", *kept), cuts, kept).toArrow()
    known = {"x": _bytes(got["x"]).reshape(-1, width), "y": got["y"].combine_chunks().flatten().to_numpy() == 1,
             "w": got["w"].combine_chunks().flatten().to_numpy() if weight else None, "test": None, "blocks": []}
    del got
    tested = None
    if test is not None:
        tested = _blocks(test.select(_row(features).alias("__x"), F.col(id_col).alias("id"), F.col("label").cast("int").alias("label")), cuts, ["id", "label"])
        asked = tested.select("block", "x").toArrow()
        known["test"] = _bytes(asked["x"]).reshape(-1, width)
        known["blocks"] = [(int(b), len(x.as_buffer()) // width) for b, x in zip(asked["block"].to_numpy(), asked["x"], strict=True)]
    table = spark.sparkContext.broadcast(known)
    del known
    tasks = max(1, min(trees, 4 * spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        for b in batches:
            for task in b.column("task").to_pylist():
                total = np.zeros(len(t["test"]) if t["test"] is not None else 0)
                weights, split, nodes, depth = np.zeros(width), 0, 0, 0
                for i in range(task, trees, tasks):
                    one = grow(t["x"], t["y"], t["w"], rule, i)
                    one.merge()
                    weights += one.importances(width)
                    split, nodes, depth = split + (one.nodes > 1), max(nodes, one.nodes), max(depth, one.depth)
                    if len(total):
                        total += one.scores(t["test"])
                yield pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "block": pa.array([-1], pa.int64()), "found": pa.array(
                    [[float(split), float(nodes), float(depth), *weights.tolist()]], pa.list_(pa.float64()))})
                a = 0
                for block, size in t["blocks"]:
                    yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([block], pa.int64()), pa.ListArray.from_arrays(
                        pa.array([0, size], pa.int32()), pa.array(total[a:a + size]))], ["task", "block", "found"])
                    a += size

    def add(group: pa.Table) -> pa.Table:
        group = group.sort_by("task")
        total = sum(np.asarray(v.values) for v in group["found"]) / trees
        return pa.table({"block": group["block"][:1], "scores": pa.array([total.tolist()], pa.list_(pa.float64()))})

    from stopcast.session import materialize
    work = spark.range(0, tasks, 1, tasks).select(F.col("id").cast("int").alias("task"))
    parts = materialize(work.mapInArrow(run, "task int, block long, found array<double>"))
    summary = np.array([r["found"] for r in parts.where("block = -1").orderBy("task").collect()])
    table.unpersist()
    split = summary[:, 0].sum()
    about = {"importances": (summary[:, 3:].sum(axis=0) / (summary[:, 3:].sum() or 1.0)).tolist(), "split": int(split),
             "nodes": int(summary[:, 1].max()), "depth": int(summary[:, 2].max())}
    if tested is None:
        return about, None
    sums = parts.where("block <> -1").groupBy("block").applyInArrow(add, "block long, scores array<double>")
    rows = tested.join(sums, "block").select(F.explode(F.arrays_zip("id", "label", F.col("scores").alias("score"))).alias("r")).select("r.*")
    return about, materialize(rows)


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.frombuffer(v.as_buffer(), np.uint8) for v in column]) if len(column) else np.zeros(0, np.uint8)
