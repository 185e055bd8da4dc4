import numpy as np
from pyspark.sql import functions as F

from stopcast.llm import hard_negatives as hn


def brute(rows, positives=5, negatives=3, scale=256):
    ok = [(i, (y + 1) % 10 if i % 7 == 0 else y, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, y in rows
          if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, y, v) in enumerate(ok):
        if i % 50:
            continue
        scores = [(sum(p * q for p, q in zip(v, w, strict=False)), j, z) for b, (j, z, w) in enumerate(ok) if a != b]
        near = sorted((-s, j) for s, j, z in scores if z == y)[:positives]
        for p, j in near:
            far = sorted((-s, n) for s, n, z in scores if z != y and 50 * -p <= 100 * s <= 95 * -p)[:negatives]
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n) in enumerate(far)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows],
                               "vec_id long, embedding array<float>, label int, score string, uid int").repartition(3)
    y = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hn.mine(df, F.col("vec_id") % 50 == 0, label=y, **kw)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    return sorted(map(tuple, got.collect()))


def cloud(seed, n, width, labels=4):
    r = np.random.default_rng(seed)
    v = r.normal(0, 1, (n, width)) + 2 * r.normal(0, 1, (labels, width))[r.integers(0, labels, n)] * (r.random((n, 1)) < 0.5)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, x.tolist(), int(y)) for i, x, y in zip(range(n), v, r.integers(0, labels, n), strict=True)]


def test_against_brute_force(spark, monkeypatch):
    rows = cloud(0, 900, 24)
    assert len(brute(rows)) > 100 and run(spark, rows) == brute(rows)
    monkeypatch.setattr(hn, "SHARD_ROWS", 130)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 5)
    monkeypatch.setattr(hn, "CELLS", 300)
    assert run(spark, rows) == brute(rows)
    assert run(spark, cloud(1, 400, 70, 10)) == brute(cloud(1, 400, 70, 10))


def test_ties_nulls_and_repeats(spark):
    rows = [(i, [0.5, -0.5, float(i % 3) / 4], i % 2) for i in range(160)]
    rows += [(200, None, 1), (None, [1.0, 1.0, 1.0], 1), (250, [None, 1.0, 1.0], 1), (300, [float("nan"), 0.0, 0.0], 0),
             (301, [float("inf"), 0.0, 0.0], 0), (350, [], 0), (351, [0.5, -0.5, 0.2], None), (400, [0.25], 1), (50, [0.5, -0.5, 0.5], 0)]
    assert run(spark, rows) == brute(rows)
    few = [(50, [0.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, [0.0, 0.0], 2)]
    assert run(spark, few) == brute(few) == [(50, 2, 1, 3, 0, 0)]
    negative = [(50, [1.0, 0.0], 1), (2, [-1.0, 0.0], 1), (3, [-0.7, 0.0], 2)]
    assert run(spark, negative) == brute(negative) == []
    assert run(spark, []) == [] and run(spark, [(50, [1.0], 1)]) == [] and run(spark, [(50, [], 1), (51, [], 1), (52, [], 2)]) == brute(
        [(50, [], 1), (51, [], 1), (52, [], 2)])


def test_large_values(spark):
    rows = [(i, [3e5 * (i % 7 - 3), 2e5 * (i % 5), -3e4 * (i % 11)], i % 3) for i in range(150)]
    assert run(spark, rows) == brute(rows)


def test_intervals_hold_and_shrink(monkeypatch):
    """Bounds enclose the scores after every layer, for all pairs together and pair by pair."""
    r = np.random.default_rng(5)
    v, q = r.integers(-90, 90, (400, 70)), r.integers(-90, 90, (30, 70))
    true, widths = (q @ v.T).astype(float), []

    def look(low, high):
        assert (low <= true).all() and (true <= high).all()
        widths.append(float((high - low).mean()))
        return np.ones(low.shape, bool)

    anchors, codes = hn.Anchors(q), hn.Codes.of(v)
    monkeypatch.setattr(hn, "FIRST_CUT", 1)
    a, _ = hn.surviving(anchors, codes, np.ones(true.shape, bool), look)
    assert len(a) == true.size and len(widths) == hn.LEVELS and all(b < 0.75 * a for a, b in zip(widths, widths[1:]))
    monkeypatch.setattr(hn, "DENSE", 2.0)
    hn.surviving(anchors, codes, np.ones(true.shape, bool), look)
    assert np.isclose(widths[-1], widths[-2]) and len(widths) == hn.LEVELS + 1


def test_few_rows_survive():
    """The intervals spare most integer products: figures in the README."""
    rows = cloud(3, 4000, 64, 10)
    v = np.floor(256 * np.array([x for _, x, _ in rows])).astype(np.int64)
    a, _ = hn.surviving(hn.Anchors(v[:50]), hn.Codes.of(v), np.ones((50, 4000), bool),
                        lambda low, high: (high > -np.inf) & (high >= hn.kth(low, 5)[:, None]))
    assert len(a) < 0.1 * 50 * 4000


def test_the_rotation_turns():
    q, p = hn.rotation(40, 0), hn.rotation(40, 1)
    assert np.allclose(q @ q.T, np.eye(40)) and not np.allclose(p, q)
