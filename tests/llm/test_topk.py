import numpy as np
from pyspark.sql import functions as F

from stopcast.llm import topk


def brute(rows, k, scale=64):
    ok = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(ok):
        if q % 20:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), c) for b, (c, w) in enumerate(ok) if a != b)
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, uid string")
    got = topk.top_k(df.repartition(3), F.col("vec_id") % 20 == 0, k)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, got.collect()))


def test_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(0)
    rows = [(i, r.normal(0, 0.1, 16).astype(float).tolist()) for i in range(700)]
    monkeypatch.setattr(topk, "SHARD_ROWS", 150)
    monkeypatch.setattr(topk, "QUERY_ROWS", 10)
    assert run(spark, rows) == brute(rows, 20)


def test_ties_nulls_and_repeats(spark):
    rows = [(i, [0.5, -0.5, float(i % 2)]) for i in range(60)]
    rows += [(100, None), (None, [1.0, 1.0, 1.0]), (101, [None, 1.0, 1.0]), (102, [float("nan"), 0.0, 0.0]),
             (103, [float("inf"), 0.0, 0.0]), (104, []), (7, [0.5, -0.5, 1.0]), (120, [0.25])]
    assert run(spark, rows) == brute(rows, 20)
    assert run(spark, rows[:3], 5) == brute(rows[:3], 5)
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []


def test_large_values(spark):
    rows = [(i, [1e6 * (i % 7 - 3), 2e6 * (i % 5), -3e5 * i]) for i in range(50)]
    assert run(spark, rows) == brute(rows, 20)


def test_bounds_enclose_the_scores():
    r = np.random.default_rng(1)
    v, q = r.integers(-60, 60, (300, 8)), r.integers(-60, 60, (5, 8)).astype(float)
    lists = topk.SortedLists(np.arange(300), np.arange(300), v)
    for depth in (1, 10, 150, 300):
        low, high = lists.bounds(np.maximum(q, 0), np.minimum(q, 0), depth)
        true = q @ lists.vectors.T
        assert (low <= true).all() and (true <= high).all()
    assert (low == high).all()
