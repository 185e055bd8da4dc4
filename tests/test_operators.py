"""Operator tests against brute force and hand-written rows."""

import datetime as dt
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.functions.holidays import is_holiday
from stopcast.operators import metrics as M
from stopcast.operators.knn import knn_join
from stopcast.operators.nearest import StopIndex, nearest_join
from stopcast.operators.resample import smote, undersample_ratio
from stopcast.operators.rowindex import global_row_index, prefix_before, time_series_split
from stopcast.operators.transforms import label_encode, stop_tier


def test_nearest_join_matches_bruteforce_incl_far_points(spark):
    rnd = random.Random(7)
    stops = [(f"s{i:03d}", -23.6 + rnd.random() * 0.3, -46.7 + rnd.random() * 0.3) for i in range(60)]
    pts = [(i, -23.6 + rnd.random() * 0.3, -46.7 + rnd.random() * 0.3) for i in range(300)]
    pts += [(1000, 10.0, 10.0), (1001, -80.0, 170.0), (1002, None, -46.6), (1003, -23.5, -46.5)]
    sdf = spark.createDataFrame(stops, "stop_id string, stop_lat double, stop_lon double")
    pdf = spark.createDataFrame(pts, "id long, lat double, lon double")
    got = {r["id"]: r["nearest_stop_id"] for r in
           nearest_join(pdf, sdf, lat="lat", lon="lon").select("id", "nearest_stop_id").collect()}
    for i, la, lo in pts:
        if la is None:
            assert got[i] is None
            continue
        best = min(stops, key=lambda s: ((s[1] - la) * (s[1] - la) + (s[2] - lo) * (s[2] - lo), s[0]))
        assert got[i] == best[0], i
    assert len(got) == len(pts)
    # shards by space, visited by the coordinates, give the same answer
    small = {r["id"]: r["nearest_stop_id"] for r in
             nearest_join(pdf, sdf, lat="lat", lon="lon", shard_stops=7, broadcast_stops=0).select("id", "nearest_stop_id").collect()}
    assert small == got


@pytest.mark.parametrize("n", [1, 15, 16, 17, 300, 5000])
def test_stop_index_against_all_stops(n):
    r = np.random.default_rng(n)
    lat, lon, rank = r.normal(size=n).round(1) - 23, r.normal(size=n).round(1) - 46, r.permutation(n)
    points = np.concatenate([np.column_stack([lat, lon])[:200] + 0.05, r.normal(size=(100, 2)) * 3 - [23, 46],
                             [[0, 0], [90, 180], [-90, -180], [90, 0], [1e300, 1e300], [-23, 1e9]]])
    row, d2 = StopIndex(lat, lon, rank).search(points[:, 0], points[:, 1])
    for i, (a, b) in enumerate(points):
        with np.errstate(over="ignore"):
            d = (lat - a) * (lat - a) + (lon - b) * (lon - b)
        assert d2[i] == d.min() and rank[row[i]] == rank[d == d.min()].min()


def test_stop_index_far_points_are_cheap():
    """(0, 0) and the poles against two million stops: as few steps as for any other point."""
    r = np.random.default_rng(0)
    lat, lon = -23.5 + r.random(2_000_000) * 0.5, -46.7 + r.random(2_000_000) * 0.5
    index = StopIndex(lat, lon, np.arange(len(lat)))
    far = np.array([[0.0, 0.0], [90.0, 0.0], [-90.0, 180.0], [0.0, 180.0]])
    start = time.process_time()
    row, d2 = index.search(far[:, 0], far[:, 1])
    assert time.process_time() - start < 1.0
    for (a, b), i, d in zip(far, row, d2, strict=True):
        every = (lat - a) * (lat - a) + (lon - b) * (lon - b)
        assert d == every.min() and i == every.argmin()


def test_nearest_join_routed_over_shards_with_ties_and_hot_points(spark):
    r = np.random.default_rng(4)
    stops = [(int(i), float(a), float(b)) for i, (a, b) in enumerate(r.integers(0, 40, (1500, 2)) / 10.0)]
    stops += [(9000, None, 1.0), (9001, float("nan"), 1.0), (None, 0.0, 0.0)]
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(r.integers(-20, 60, (400, 2)) / 10.0)]
    pts += [(1000 + i, 0.0, 0.0) for i in range(300)] + [(5000, float("nan"), 0.0), (5001, None, None), (5002, -90.0, 1e12)]
    sdf = spark.createDataFrame(stops, "stop_id long, stop_lat double, stop_lon double").repartition(3)
    pdf = spark.createDataFrame(pts, "id long, lat double, lon double").repartition(3)
    plans = [{r["id"]: (r["nearest_stop_id"], r["d"]) for r in nearest_join(pdf, sdf, lat="lat", lon="lon", out_dist="d", **kw).collect()}
             for kw in ({}, {"broadcast_stops": 0, "shard_stops": 60}, {"broadcast_stops": 0})]
    good = [s for s in stops if s[0] is not None and s[1] is not None and s[1] == s[1]]
    for i, a, b in pts:
        if a is None or a != a:
            assert all(p[i] == (None, None) for p in plans)
            continue
        d2, k = min(((s[1] - a) * (s[1] - a) + (s[2] - b) * (s[2] - b), s[0]) for s in good)
        assert all(p[i] == (k, math.sqrt(d2)) for p in plans), i
    assert all(len(p) == len(pts) for p in plans)
    none = nearest_join(pdf, sdf.limit(0), lat="lat", lon="lon").select("nearest_stop_id").distinct().collect()
    assert [x[0] for x in none] == [None]


def test_global_row_index_and_split(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=(i * 7919) % 1000)) for i in range(1000)]
    df = spark.createDataFrame(rows, "event_id long, event_timestamp timestamp")
    ix = global_row_index(df).toPandas()
    exp = sorted(rows, key=lambda r: (r[1], r[0]))
    assert [r[0] for r in exp] == list(ix.sort_values("row_idx")["event_id"])
    assert sorted(ix["row_idx"]) == list(range(1000))
    s = time_series_split(df, 3).toPandas()
    t = 1000 // 4
    assert (s["is_test"] == 1).sum() == t and (s["is_train"] == 1).sum() == 1000 - t
    assert list(s.groupby("fold").size().loc[[0, 1, 2]]) == [t, t, t]


def test_prefix_before(spark):
    vals = [(float(x), x % 3) for x in range(200)]
    df = spark.createDataFrame(vals, "s double, v long")
    got = {r["s"]: r["v_before"] for r in prefix_before(df, "s", ["v"]).collect()}
    acc = 0
    for s, v in vals:
        assert got[s] == acc
        acc += v
    down = {r["s"]: r["v_before"] for r in prefix_before(df, "s", ["v"], descending=True).collect()}
    assert down[199.0] == 0 and down[0.0] == sum(v for _, v in vals[1:])


def test_roc_auc_exact_with_ties(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.random() < 0.3, round(rnd.random(), 1)) for i in range(400)]
    df = spark.createDataFrame([(i, int(y), s) for i, y, s in rows], "id long, label int, score double")
    pos = [s for _, y, s in rows if y]
    neg = [s for _, y, s in rows if not y]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert math.isclose(M.roc_auc(df).first()["roc_auc"], pairs / (len(pos) * len(neg)), rel_tol=1e-12)
    c = M.confusion(df, 0.5).first()
    assert c["tp"] == sum(1 for _, y, s in rows if y and s >= 0.5)


def test_threshold_grid_first_best(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1), (3, 1, 0.8), (4, 0, 0.2)], "id long, label int, score double")
    r = M.threshold_grid(df, [30, 40, 50, 60, 70]).first()
    assert r["best_threshold"] == 0.3 and r["best_f1_macro"] == 1.0


def test_knn_exact_vs_bruteforce(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(150, 8))
    Q = rng.normal(size=(20, 8))
    tr = spark.createDataFrame([(i, [float(v) for v in X[i]]) for i in range(len(X))], "id long, vec array<double>")
    te = spark.createDataFrame([(1000 + i, [float(v) for v in Q[i]]) for i in range(len(Q))], "id long, vec array<double>")
    got = knn_join(te, tr, 5).toPandas()
    for qi in range(len(Q)):
        d = np.sqrt(((X - Q[qi]) ** 2).sum(axis=1))
        exp = list(np.lexsort((np.arange(len(X)), d))[:5])
        g = got[got.qid == 1000 + qi].sort_values("rank")
        assert list(g.tid) == exp


def test_knn_in_many_blocks_with_ties_and_self(spark, monkeypatch):
    import stopcast.operators.knn as K
    monkeypatch.setattr(K, "BLOCK_ROWS", 30)
    rng = np.random.default_rng(1)
    X = rng.integers(0, 3, size=(120, 3)).astype(float)
    df = spark.createDataFrame([(i, [float(v) for v in X[i]]) for i in range(120)] + [(500, None)], "id long, vec array<double>")
    got = knn_join(df, df, 4, exclude_self=True).toPandas()
    assert got.qid.nunique() == 120
    for i in range(120):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        assert list(got[got.qid == i].sort_values("rank").tid) == list(np.lexsort((np.arange(120), d))[:4])


@pytest.mark.parametrize("width, spread", [(2, 1.0), (10, 1.0), (3, 1e5)])
def test_knn_over_many_cells(spark, monkeypatch, width, spread):
    """Clusters, copies, far points and ties over many cells, against all pairs."""
    import stopcast.operators.knn as K
    monkeypatch.setattr(K, "CELL_ROWS", 20)
    monkeypatch.setattr(K, "BLOCK_ROWS", 25)
    rng = np.random.default_rng(width)
    X = spread * (rng.normal(size=(12, width))[rng.integers(0, 12, 900)] * 3 + rng.normal(size=(900, width)) * 0.2)
    X[:200] = X[0]                      # a hot vector
    X[200:230] = np.round(X[200:230])   # ties
    X[230] *= 1000
    Q = np.concatenate([X[::9], spread * rng.normal(size=(30, width)), 1e4 * spread * np.ones((1, width))])
    tr = spark.createDataFrame([(i, X[i].tolist(), i % 2) for i in range(900)], "id long, vec array<double>, y int")
    te = spark.createDataFrame([(i % 100, Q[i].tolist()) for i in range(len(Q))], "id long, vec array<double>")
    got = sorted(map(tuple, knn_join(te.repartition(3), tr.repartition(3), 7, carry=["y"]).collect()))
    want = []
    for i, q in enumerate(Q):
        d = np.zeros(900)
        for j in range(width):
            d += (q[j] - X[:, j]) * (q[j] - X[:, j])
        d = np.sqrt(d)
        want += [(i % 100, int(t), float(d[t]), r + 1, int(t) % 2) for r, t in enumerate(np.lexsort((np.arange(900), d))[:7])]
    assert got == sorted(want)
    own = knn_join(tr, tr, 3, exclude_self=True).toPandas()
    assert len(own) == 2700 and (own.qid != own.tid).all()
    hot = own[own.qid < 200]
    assert (hot.dist == 0).all() and (hot[hot.qid > 2].sort_values("rank").groupby("qid").tid.apply(list).map(tuple) == (0, 1, 2)).all()


def test_knn_holds_few_distances_and_sends_a_query_once(monkeypatch):
    """Tables of distances to all pivots are bounded however long a batch is, and a query
    that reaches many cells is one row with the groups and masks of exactly these cells."""
    from types import SimpleNamespace

    import pyarrow as pa

    import stopcast.operators.knn as K
    monkeypatch.setattr(K, "CELLS", 2000)
    monkeypatch.setattr(K, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(3)
    p = K.Pivots(rng.normal(size=(100, 4)))
    p.count[:] = rng.integers(0, 30, 100)
    p.low[:], p.high[:] = 0.0, 5.0
    p.form_groups()
    assert sorted(np.concatenate(p.members).tolist()) == np.flatnonzero(p.count).tolist()
    assert all(len(m) == 1 or p.count[m].sum() <= 60 for m in p.members)
    sizes, real = [], K._gaps
    monkeypatch.setattr(K, "_gaps", lambda q, t: sizes.append(len(q) * len(t)) or real(q, t))
    X = rng.normal(size=(500, 4))
    batch = pa.RecordBatch.from_pydict({"__tv": X.tolist(), "__qv": X.tolist(), "__bound": np.full(500, 3.0)})
    got = list(K._with_cell(SimpleNamespace(value=p))(iter([batch])))
    assert sum(b.num_rows for b in got) == 500 and max(sizes) <= 2000
    assert np.concatenate([b.column("__cell").to_numpy() for b in got]).tolist() == real(X, p.points).argmin(axis=1).tolist()
    for resolve in (False, True):
        sizes.clear()
        rows = pa.Table.from_batches(list(K._visits(SimpleNamespace(value=p), 5, resolve)(iter([batch])))).to_pylist()
        assert len(rows) == 500 and max(sizes) <= 2000
        d = real(X, p.points)
        seeds, reached = p.seeds(d, 5), p.reached(X, d, np.full(500, 3.0))
        for i, r in enumerate(rows):
            cells = [int(c) for g, m in zip(r["__groups"], r["__masks"]) for c in p.members[g] if m >> int(p.bit[c]) & 1]
            want = set(np.flatnonzero(reached[i]).tolist()) - set(seeds[i].tolist()) if resolve else set(seeds[i].tolist())
            assert len(set(r["__groups"])) == len(r["__groups"]) and sorted(cells) == sorted(want)


def test_knn_empty_and_odd_rows(spark):
    schema = "id string, vec array<double>"
    few = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("n", None), ("x", [float("nan"), 1.0]), ("i", [float("inf"), 0.0]),
                                 ("u", [None, 1.0])], schema)
    assert sorted(map(tuple, knn_join(few, few, 5).collect())) == [("a", "a", 0.0, 1), ("a", "b", 0.0, 2), ("b", "a", 0.0, 1), ("b", "b", 0.0, 2)]
    assert knn_join(few, few.limit(0), 5).collect() == [] and knn_join(few.limit(0), few, 5).collect() == []


def test_knn_looks_at_few_pairs(spark):
    """10 features: pairs computed grow clearly slower than queries x rows."""
    share = []
    for n in (2000, 16000):
        rng = np.random.default_rng(n)
        X = rng.normal(size=(n, 3)) @ np.random.default_rng(5).normal(size=(3, 10)) + rng.normal(size=(n, 10)) * 0.05
        df = spark.createDataFrame([(i, X[i].tolist()) for i in range(n)], "id long, vec array<double>")
        pairs = spark.sparkContext.accumulator(0)
        knn_join(df.where("id % 10 = 0"), df, 5, pairs=pairs).count()
        share.append(pairs.value / (n * n / 10))
    assert 0 < share[1] < 0.5 * share[0] < 0.5


def test_smote_counts(spark):
    rows = [(i, [float(i % 7), float(i % 5)], 1 if i % 10 == 0 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label int")
    s = smote(df, k=3, sampling_strategy=0.5, label="label", id_col="id", vec="vec")
    n1, n0 = 20, 180
    assert s.count() == int(0.5 * n0) - n1


def test_undersample_exact_count(spark):
    rows = [(i, 1 if i % 5 == 0 else 0) for i in range(500)]
    df = spark.createDataFrame(rows, "event_id long, target int")
    u = undersample_ratio(df, 2.0).toPandas()
    assert (u.target == 1).sum() == 100 and (u.target == 0).sum() == 200


def test_time_period_hour_zero_and_edges(spark):
    df = spark.createDataFrame([(h,) for h in range(24)], "h int")
    r = {x["h"]: x["p"] for x in df.select("h", cal.time_period("h").alias("p")).collect()}
    assert r[0] is None and r[6] == 0.0 and r[7] == 1.0 and r[9] == 1.0 and r[23] == 6.0


def test_holidays(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 29, 10),), (dt.datetime(2024, 3, 28, 10),),
                                (dt.datetime(2024, 11, 20, 10),), (dt.datetime(2023, 11, 20, 10),),
                                (dt.datetime(2025, 4, 18, 10),)], "event_timestamp timestamp")
    r = [x["is_holiday"] for x in is_holiday(df).orderBy("event_timestamp").collect()]
    assert r == [0, 0, 1, 1, 1]   # 2023-11-20 not national before 2024; Good Friday 2024-03-29, 2025-04-18


def test_label_encode_lexicographic(spark):
    df = spark.createDataFrame([(h,) for h in (0, 1, 2, 10, 11, 23, None)], "hour int")
    r = {x["k"]: x["hour"] for x in label_encode(df.withColumn("k", F.col("hour")), ["hour"]).collect()}
    # '0' < '1' < '10' < '11' < '2' < '23' < 'nan'
    assert [r[k] for k in (0, 1, 10, 11, 2, 23, None)] == [0, 1, 2, 3, 4, 5, 6]


def test_qcut_duplicate_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 0, 0, 0, 0, 0, 1, 2, 3, 4]], "stop_event_rate double")
    r = [x["stop_tier"] for x in stop_tier(df).collect()]
    assert r[:6] == [0.0] * 6 and max(r) <= 4.0 and None not in r


def test_edge_fixtures(spark):
    """SURVEY §5 edge cases: GTFS hour >= 24, malformed POINT, NaN / inf,
    one-class AUC, undefined precision."""
    from stopcast.functions.geo import parse_point
    from stopcast.operators.headway import split_hour
    from stopcast.semantics import normalize_nulls
    df = spark.createDataFrame([("25:10:00",), ("07:00:00",)], "t string")
    assert [r["h"] for r in df.select(split_hour("t").alias("h")).collect()] == [25, 7]
    pts = spark.createDataFrame([("POINT(-46.6 -23.5)",), ("POINT (x y)",), (None,), ("POINT(  -46.61   -23.52 )",)], "p string")
    lat, lon = parse_point("p")
    r = pts.select(lat.alias("lat"), lon.alias("lon")).collect()
    assert (r[0]["lat"], r[0]["lon"]) == (-23.5, -46.6) and r[1]["lat"] is None and r[2]["lat"] is None
    assert (r[3]["lat"], r[3]["lon"]) == (-23.52, -46.61)
    x = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,)], "x double")
    assert [v["x"] for v in normalize_nulls(x).collect()] == [None, None, None, 1.5]
    one = spark.createDataFrame([(1, 0, 0.2), (2, 0, 0.7)], "id long, label int, score double")
    assert M.roc_auc(one).first()["roc_auc"] is None
    pm = M.point_metrics(one, 0.9).first()
    assert pm["precision"] == 0.0 and pm["recall"] == 0.0 and pm["f1"] == 0.0 and pm["accuracy"] == 1.0


def test_ranked_quantiles_match_numpy(spark):
    from stopcast.operators.quantiles import quantiles
    rng = np.random.default_rng(5)
    vals = list(np.round(rng.normal(size=301), 1)) + [None, None]        # ties + NULLs
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.98, 0.99, 1.0]
    exp = np.quantile(np.array([v for v in vals if v is not None]), probs)
    got = df.select(quantiles(df, "x", probs).alias("q")).first()["q"]
    assert np.allclose(got, exp, rtol=0, atol=1e-12)
    one = spark.createDataFrame([(3.5,)], "x double")
    assert one.select(quantiles(one, "x", [0.5]).alias("q")).first()["q"] == [3.5]
    empty = one.where("x > 10")
    assert one.select(quantiles(empty, "x", [0.5]).alias("q")).first()["q"] is None
    assert one.select(quantiles(empty, "x", [0.5])[0].alias("q")).first()["q"] is None


def test_many_quantiles_in_one_pass(spark):
    from stopcast.operators.quantiles import many_quantiles
    rows = [(float(i % 17), -float(i) if i % 3 else None, 5.0) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    q = many_quantiles(df, {c: c for c in df.columns}, [0.1, 0.5, 0.9])
    got = df.limit(1).select(*[q[c].alias(c) for c in df.columns]).first()
    for k, c in enumerate(df.columns):
        exp = np.quantile([r[k] for r in rows if r[k] is not None], [0.1, 0.5, 0.9])
        assert np.allclose(got[c], exp, rtol=0, atol=1e-9)


def test_tied_rows_spread_over_ranges(spark):
    """A million rows that tie in every order column: no range holds more
    than twice the mean, and the positions are still 0 to n - 1."""
    from pyspark.sql import functions as F
    from stopcast.operators.rowindex import ranged_rows
    df = spark.range(1_000_000).repartition(8).select(F.lit(7.0).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranged_rows(df, [F.col("x")]).groupBy(F.shiftright("__pos", 33)).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    r = global_row_index(df, order=("x",)).agg(F.min("row_idx"), F.max("row_idx"), F.countDistinct("row_idx")).first()
    assert tuple(r) == (0, 999_999, 1_000_000)


def test_geodesic_converges_or_is_null(spark):
    from stopcast.functions.geo import geodesic_m
    rows = [(0.0, 0.0, 0.5, 179.5), (0.0, 0.0, 0.5, 179.9), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geodesic_m("a", "b", "c", "d")).collect()]
    assert abs(got[0] - 19_936_288.579) < 0.01          # published result of the exact solution
    assert got[1] is None and got[2] == 0.0 and abs(got[3] - 111_319.491) < 0.01


def test_shared_folder_is_required_off_local(monkeypatch):
    import pytest
    from stopcast import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_gtfs_reader_only_forgives_a_missing_file(spark, tmp_path):
    import pytest
    from stopcast.sources.files import read_gtfs
    (tmp_path / "stops.txt").write_text("stop_id\n1\n")
    got = read_gtfs(spark, f"file://{tmp_path}", {"stops": ["stop_id"], "trips": ["trip_id"]})
    assert got["stops"].count() == 1 and got["trips"].count() == 0
    with pytest.raises(Exception):
        read_gtfs(spark, "nosuchscheme://x", {"stops": ["stop_id"]})["stops"].count()


def test_headway_is_the_mean_of_deduplicated_rows(spark):
    from stopcast.operators import headway as H
    st_ = spark.createDataFrame([("t1", "a"), ("t1", "a"), ("t1", "b"), ("t2", "a"), (None, "a")], "trip_id string, stop_id string")
    fr = spark.createDataFrame([("t1", "08:30:00", 600.0), ("t1", "08:00:00", 300.0), ("t2", "08:10:00", 900.0),
                                ("t2", "25:10:00", 60.0)], "trip_id string, start_time string, headway_secs double")
    want = {(r[0], r[1]): r[2] for r in H.dedupe(H.headway_base(st_, fr)).groupBy("stop_id", "start_hour")
            .avg("headway_secs").collect()}
    got = {(r[0], r[1]): r[2] for r in H.headway_avg(st_, fr).collect()}
    assert got == want and got["a", 8] == 600.0


def test_group_quantiles_with_a_hot_group(spark):
    """Medians and quartiles of groups against numpy; a hot group's values lie in many ranges."""
    from stopcast.operators import quantiles as Q
    from stopcast.operators.rowindex import ranged_rows
    r = np.random.default_rng(2)
    rows = [("hot", float(x)) for x in r.normal(size=3000)] + [("same", 1.5)] * 500 + [(f"g{i % 40}", float(i % 7)) for i in range(300)]
    rows += [("one", 4.0), ("none", None), (None, 1.0), ("same", 2.5)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {x["k"]: x["q"] for x in Q.group_quantiles(df, "k", "x", [0.5, 0.25, 1.0]).collect()}
    want = {}
    for k, x in rows:
        if k is not None and x is not None:
            want.setdefault(k, []).append(x)
    assert set(got) == set(want)
    for k, v in want.items():
        assert np.allclose(got[k], np.quantile(v, [0.5, 0.25, 1.0]), rtol=1e-12), k
    counts = df.groupBy("k", "x").count()
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ranged_rows(counts, [F.col("k"), F.col("x")]).groupBy(F.shiftright("__pos", 33)).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(parts) == 4 and max(p[1] for p in parts) < 0.4 * counts.count()      # the hot group holds 0.97 of the pairs


def test_correlations_of_200_columns_in_one_pass(spark, monkeypatch):
    """Pairwise complete Pearson matrix against numpy: nulls, large values, constants, one pass."""
    from stopcast.operators import eda as E
    r = np.random.default_rng(0)
    k, n = 200, 400
    x = r.normal(size=(n, k)) + r.normal(size=(n, 1)) * r.normal(size=k) + 1e6 * (np.arange(k) % 3 == 0)
    x[r.random((n, k)) < 0.1] = np.nan
    x[:, 7], x[1:, 8] = 4.5, np.nan
    names = [f"c{i}" for i in range(k)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"{c} double" for c in names))
    scans, real = [], E.added
    monkeypatch.setattr(E, "added", lambda *a: (scans.append(1), real(*a))[1])
    got = E.correlations(df.repartition(3), names, names)
    assert len(scans) == 1 and np.isnan(got[7]).all() and np.isnan(got[8]).all()
    import pandas as pd
    want = pd.DataFrame(x).corr(min_periods=2).to_numpy()
    want[7], want[:, 7], want[8], want[:, 8] = (np.nan,) * 4
    assert np.allclose(got, want, atol=1e-9, equal_nan=True)
    one = {r["feature"]: r["corr"] for r in E.corr_target(df, names[:20], "c30").collect()}
    assert all(one[c] is None if np.isnan(want[i, 30]) else abs(one[c] - want[i, 30]) < 1e-9 for i, c in enumerate(names[:20]))
    assert all(v is None for v in (r["corr"] for r in E.corr_pairs(df.limit(0), names[:3]).collect()))


def test_scan_limit_reads_few_row_groups(spark, tmp_path):
    """The order columns bound the scan of the whole rows: later row groups are not decoded."""
    from stopcast.sources.sampling import scan_limit
    import pyarrow as pa
    import pyarrow.parquet as pq
    n = 50_000
    pq.write_table(pa.table({"event_timestamp": np.arange(n), "event_id": np.arange(n), "wide": [f"row {i}" for i in range(n)]}),
                   f"{tmp_path}/t.parquet", row_group_size=1000)
    df = spark.read.parquet(f"file://{tmp_path}/t.parquet")
    top = scan_limit(df, 2500)
    assert [r["event_id"] for r in top.collect()] == list(range(2500))
    plan = top._jdf.queryExecution().executedPlan()
    leaves = plan.executedPlan().collectLeaves() if "AdaptiveSparkPlan" in plan.nodeName() else plan.collectLeaves()
    read = max(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numOutputRows"))
    assert 2500 <= read <= 4000
    tied = spark.createDataFrame([(None, 1), (5, 2), (5, 3), (None, 0), (4, 9)], "event_timestamp int, event_id int")
    assert [r["event_id"] for r in scan_limit(tied, 4).collect()] == [0, 1, 9, 2]
    assert scan_limit(tied, 1).collect()[0]["event_id"] == 0 and scan_limit(tied.limit(0), 3).collect() == []


def test_boxes_hold_a_point_against_few_nodes(monkeypatch):
    """Every row lies in its leaf's box, every leaf with a row within the bound is reached, and a
    point is held against a small part of the leaves."""
    from stopcast.operators.boxes import Tree
    rng = np.random.default_rng(9)
    X = np.column_stack([rng.integers(0, 24, 20000), rng.integers(0, 7, 20000), rng.normal(size=(20000, 3))]).astype(float)
    X[:500] = X[0]
    t = Tree(X, 40, 10)
    own = t.place(X)
    assert sorted(np.concatenate(t.members).tolist()) == list(range(20000)) and all((own[m] == i).all() for i, m in enumerate(t.members))
    assert min(map(len, t.members)) >= 10 and len(t.members) > 500
    Q, bound, looked, real = X[::100] + 0.1, np.full(200, 1.5), [], t.away
    monkeypatch.setattr(t, "away", lambda p, nodes: looked.append(len(nodes)) or real(p, nodes))
    i, leaf, d = t.reached(Q, bound)
    assert sum(looked) < 0.4 * len(Q) * len(t.members) and (d <= 1.5).all()
    got = set(zip(i.tolist(), leaf.tolist(), strict=True))
    near = np.sqrt(((Q[:, None] - X[None]) ** 2).sum(axis=2)) <= 1.5
    assert {(a, int(own[b])) for a, b in zip(*np.nonzero(near), strict=True)} <= got and len(got) == len(i)


def test_knn_of_narrow_vectors_by_boxes(spark, monkeypatch):
    """Groups and leaves of few rows, rows of one id, hot values, a group with fewer rows than k; no
    row is held against all pivots."""
    import stopcast.operators.knn as K
    monkeypatch.setattr(K, "BLOCK_ROWS", 40)
    monkeypatch.setattr(K, "Pivots", None)
    rng = np.random.default_rng(8)
    X = np.column_stack([rng.integers(0, 5, 700), rng.integers(0, 3, 700), rng.normal(size=700).round(1), rng.normal(size=700)]).astype(float)
    X[:120, 3], X[120:130] = 0.0, X[120]
    ids = [i // 3 for i in range(700)]
    df = spark.createDataFrame([(ids[i], X[i].tolist(), i) for i in range(700)], "id long, vec array<double>, row int").repartition(3)
    got = knn_join(df.where("row % 4 = 0"), df.where("row % 7 <> 0"), 9, exclude_self=True).toPandas()
    want = []
    old = [j for j in range(700) if j % 7]
    for i in range(0, 700, 4):
        d = sorted((float(np.sqrt(((X[i] - X[j]) ** 2).sum())), ids[j]) for j in old if ids[j] != ids[i])[:9]
        want += [(ids[i], t, round(x, 9), r + 1) for r, (x, t) in enumerate(d)]
    assert sorted((r.qid, r.tid, round(r.dist, 9), r["rank"]) for _, r in got.iterrows()) == sorted(want)
