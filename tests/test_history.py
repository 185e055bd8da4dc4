"""History operators against a brute-force O(n^2) loop (the reference's
algorithm) on hand-written rows and on the sf0.001 events."""

import contextlib
import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stopcast.operators import history as H
from stopcast.operators.history import expanding_history, history_features, knn_history, rf_history
from stopcast.sources.adapters import model_events
from tests.conftest import SF001


def brute(pdf, key, warmup=0):
    pdf = pdf.sort_values(["event_timestamp", "event_id"]).reset_index(drop=True)
    out = {}
    for i, r in pdf.iterrows():
        rate, cnt, rec = 0.0, 0, 999
        if i >= warmup and not pd.isna(r[key]):
            h = pdf.iloc[:i]
            h = h[h[key] == r[key]]
            if len(h):
                m = h["target"].mean()
                rate = 0.0 if pd.isna(m) else m
                cnt = len(h)
                rec = (r["event_timestamp"] - h["event_timestamp"].max()).days
        out[r["event_id"]] = (rate, cnt, rec)
    return out


def _rows(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [
        (1, t0, "a", 1, 1), (2, t0, "a", 1, 0),            # equal timestamps: id breaks the tie
        (3, t0 + dt.timedelta(days=2, hours=23), "a", None, None),  # null key, null label
        (4, t0 + dt.timedelta(days=3), "b", 1, None),
        (5, t0 + dt.timedelta(days=3, seconds=1), "a", 2, 1),
        (6, t0 + dt.timedelta(days=9), None, 2, 0),
        (7, t0 + dt.timedelta(days=10), "a", 1, 1),
    ]
    return spark.createDataFrame(rows, "event_id long, event_timestamp timestamp, user_pseudo_id string, "
                                       "gtfs_stop_id int, target int")


@contextlib.contextmanager
def many_ranges(spark, n=16):
    """Keys are then cut into ranges even on a small table (n = 1: no key is)."""
    old = H.RANGE_ROWS, H.SAMPLE_ROWS
    H.RANGE_ROWS, H.SAMPLE_ROWS = (old[0], old[1]) if n == 1 else (max(1, 48 // n), 8 << 16)
    try:
        yield
    finally:
        H.RANGE_ROWS, H.SAMPLE_ROWS = old


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_history_matches_bruteforce_small(spark, ranges):
    df = _rows(spark)
    with many_ranges(spark, ranges):
        out = history_features(df, [("user", "user_pseudo_id", True), ("stop", "gtfs_stop_id", True)]).toPandas() \
            .set_index("event_id")
    pdf = df.toPandas()
    for key, p in (("user_pseudo_id", "user"), ("gtfs_stop_id", "stop")):
        exp = brute(pdf, key)
        for eid, (rate, cnt, rec) in exp.items():
            r = out.loc[eid]
            assert math.isclose(r[f"{p}_hist_conversion_rate"], rate), (p, eid)
            assert r[f"{p}_hist_count"] == cnt, (p, eid)
            assert r[f"{p}_recency_days"] == rec, (p, eid)


def test_rf_history_sf0001_bruteforce(spark):
    df = model_events(spark, SF001)
    out = rf_history(df).toPandas().set_index("event_id")
    pdf = df.toPandas()
    for key, p in (("user_pseudo_id", "user"), ("gtfs_stop_id", "stop")):
        exp = brute(pdf, key, warmup=100)
        for eid, (rate, cnt, rec) in exp.items():
            r = out.loc[eid]
            assert math.isclose(r[f"{p}_hist_conversion_rate"], rate, abs_tol=1e-12)
            assert r[f"{p}_hist_count"] == cnt
            assert r[f"{p}_recency_days"] == rec


def test_leakage_property(spark):
    """Appending future events must not change earlier rows' features."""
    df = model_events(spark, SF001)
    cut = df.agg(F.percentile_approx(F.unix_micros("event_timestamp"), 0.6)).first()[0]
    early = df.where(F.unix_micros("event_timestamp") <= cut)
    a = rf_history(early).drop("user_frequency").toPandas().set_index("event_id").sort_index()
    b = (rf_history(df).drop("user_frequency").toPandas().set_index("event_id").loc[a.index].sort_index())
    pd.testing.assert_frame_equal(a[sorted(a.columns)], b[sorted(a.columns)], check_dtype=False)


def test_knn_std_semantics(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, t0, "u", 1, 1, 10.0, 5, 2), (2, t0 + dt.timedelta(hours=1), "u", 1, 0, 20.0, 6, 2),
         (3, t0 + dt.timedelta(hours=2), "u", 1, 1, None, 7, 2), (4, t0 + dt.timedelta(hours=3), "u", 2, 1, 40.0, 8, 2)],
        "event_id long, event_timestamp timestamp, user_pseudo_id string, gtfs_stop_id int, target int, "
        "dist_device_stop double, hour int, user_frequency long")
    r = knn_history(df).toPandas().set_index("event_id")
    assert r.loc[1, "user_hist_events"] == 0 and r.loc[1, "user_std_dist_hist"] == 0.0   # first row: defaults
    assert pd.isna(r.loc[2, "user_std_dist_hist"])                                      # one prior value: NaN
    assert math.isclose(r.loc[3, "user_std_dist_hist"], pd.Series([10.0, 20.0]).std())
    assert math.isclose(r.loc[4, "user_avg_dist_hist"], 15.0)                           # NULL skipped
    assert math.isclose(r.loc[4, "user_hist_conversion_rate"], 2 / 3)
    assert r.loc[4, "stop_hist_events"] == 0.0


def test_hot_key_over_many_ranges_equals_one(spark):
    """A key holding 40 % of the rows, and rows without a key, over many
    ranges give what one range gives."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=7 * (i // 3)), None if i % 7 == 0 else "hot" if i % 5 < 2 else f"u{i % 13}", i % 3,
             None if i % 11 == 0 else i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, event_timestamp timestamp, user_pseudo_id string, "
                                     "gtfs_stop_id int, target int").repartition(5)
    with many_ranges(spark):
        a = expanding_history(df, "user_pseudo_id", "h").toPandas()
    with many_ranges(spark, 1):
        b = expanding_history(df, "user_pseudo_id", "h").toPandas()
    cols = ["event_id", "h_n", "h_pos", "h_lab", "h_recency"]
    pd.testing.assert_frame_equal(a[cols].sort_values("event_id").reset_index(drop=True),
                                  b[cols].sort_values("event_id").reset_index(drop=True))
    assert (a[a.user_pseudo_id.isna()].h_n == 0).all()


def test_std_of_large_values_keeps_its_digits(spark):
    """Values near 1e9 with a spread of 0.2, over several buckets and with nulls."""
    import datetime as dt
    import numpy as np
    from stopcast.operators.history import expanding_history
    rng = np.random.default_rng(0)
    rows, t0 = [], dt.datetime(2024, 1, 1)
    for i in range(400):
        key = None if i % 50 == 49 else f"k{i % 3}"
        x = None if i % 11 == 10 else 1e9 * (i % 3) + float(rng.normal(0, 0.2))
        rows.append((i, t0 + dt.timedelta(minutes=7 * i), key, x, i % 2))
    df = spark.createDataFrame(rows, "event_id long, event_timestamp timestamp, key string, x double, target int")
    with many_ranges(spark):
        got = {r["event_id"]: r for r in expanding_history(df, "key", "h", mean_cols=["x"], std_cols=["x"]).collect()}
    assert len(got) == len(rows)
    for i, _, key, _, _ in rows:
        before = [r[3] for r in rows[:i] if r[2] == key and r[3] is not None]
        if key is None or len(before) < 2:
            assert got[i]["h_std_x"] is None
        else:
            assert abs(got[i]["h_std_x"] - np.std(np.array(before) - before[0], ddof=1)) < 1e-6
        assert got[i]["h_n"] == (0 if key is None else sum(r[2] == key for r in rows[:i]))
