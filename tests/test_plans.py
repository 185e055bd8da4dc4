"""Plan-level invariants: ETL, training table, models, streaming (sf0.001)."""

import math

import pytest
from pyspark.sql import functions as F

from stopcast.plans import models as MD
from stopcast.plans.etl import build_features
from stopcast.plans.training import feature_columns, training_table
from stopcast.sources import adapters as A
from tests.conftest import SF001


@pytest.fixture(scope="module")
def table(spark):
    t = MD.prepare(training_table(A.model_events(spark, SF001))).cache()
    feats = [c for c in feature_columns(t) if c not in ("label", "weight")]
    return t, feats


def test_training_table_split(table):
    t, feats = table
    n = t.count()
    assert t.where("is_test = 1").count() == n // 4
    assert t.where("is_train = 1").count() == n - n // 4
    # positions are contiguous after cleaning and the last fold is the most recent
    mx_train = t.where("is_train = 1").agg(F.max("event_timestamp")).first()[0]
    mn_test = t.where("is_test = 1").agg(F.min("event_timestamp")).first()[0]
    assert mx_train <= mn_test
    assert "target" not in feats and "event_id" not in feats and "user_hist_conversion_rate" in feats


def test_balanced_weights(table):
    t, _ = table
    w = {r["label"]: r["weight"] for r in t.select("label", "weight").distinct().collect()}
    n = t.count()
    n1 = t.where("label = 1").count()
    assert math.isclose(w[1.0], n / (2 * n1))


def test_logreg_scores_and_metrics(spark, table):
    t, feats = table
    tr, te = t.where("is_train = 1"), t.where("is_test = 1")
    _, sc, _ = MD.fit_score(MD.logreg_sgd(alpha=1e-3), tr, te, feats, scale=True)
    assert sc.count() == te.count()
    assert sc.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    ev = MD.evaluate(sc)
    assert 0.0 <= ev["roc_auc"] <= 1.0 and 0.0 <= ev["f1_macro"] <= 1.0


def test_tree_models_and_importance(spark, table):
    t, feats = table
    tr, te = t.where("is_train = 1"), t.where("is_test = 1")
    m, sc, _ = MD.fit_score(MD.random_forest(numTrees=10, maxDepth=5), tr, te, feats)
    imp = MD.feature_importance(spark, m, feats).collect()
    assert len(imp) == len(feats) and math.isclose(sum(r["importance"] for r in imp), 1.0, rel_tol=1e-6)
    dt = MD.decision_tree(maxDepth=4, sqrt=True)
    m2, _, _ = MD.fit_score(dt, tr, te, feats)
    assert m2.stages[-1].trees[0].depth <= 4


def test_calibration_probabilities(spark, table):
    t, feats = table
    tr, te = t.where("is_train = 1"), t.where("is_test = 1")
    n = tr.count()
    sc = MD.calibrate_sigmoid(spark, tr, te, feats, lambda: MD.linear_svm(C=1.0, n=n), k=3)
    r = sc.agg(F.min("score"), F.max("score"), F.count(F.lit(1))).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] == te.count()


def test_build_features_etl(spark):
    st, sti, fr = A.gtfs_stops(spark, SF001), A.gtfs_stop_times(spark, SF001), A.gtfs_frequencies(spark, SF001)
    out = build_features(A.raw_events(spark, SF001), st, sti, fr, bin_width="6 hours")
    cols = set(out.columns)
    for c in ("gtfs_stop_id", "target", "headway_avg_stop_hour", "stop_event_rate", "hour_sin", "is_holiday",
              "dist_x_peak", "time_hour"):
        assert c in cols
    r = out.agg(F.count(F.lit(1)), F.sum(F.col("target").isNull().cast("int")), F.min("headway_avg_stop_hour"),
                F.max("headway_avg_stop_hour")).first()
    assert r[0] > 0 and r[1] == 0 and r[2] >= 300 and r[3] <= 3600
    # label-encoded hour codes are 0..23 ranks of the string form
    assert out.agg(F.max("time_hour")).first()[0] <= 23


def test_streaming_history_matches_batch(spark):
    from stopcast.operators.history import history_features
    from stopcast.streaming import live as L
    events, end = L.with_end(L.read_events_stream(spark, SF001))
    path = L.run_to_table(L.history_stream(events), spark, "test-st2", mode="append", end=end)
    got = {r["event_id"]: (r["hist_count"], r["recency_days"]) for r in spark.read.parquet(path).collect()}
    exp = history_features(A.model_events(spark, SF001), [("user", "user_pseudo_id", True)]).collect()
    for r in exp:
        assert got[r["event_id"]] == (r["user_hist_count"], r["user_recency_days"])


def test_streaming_users_per_bin_matches_batch(spark):
    from stopcast.operators.labels import users_per_bin
    from stopcast.streaming import live as L
    s = L.users_per_bin_stream(L.read_events_stream(spark, SF001))
    path = L.run_to_table(s, spark, "test-st1")
    got = {(r["gtfs_stop_id"], r["time_bin"]): r["user_count"]
           for r in L.latest(spark, path, ["gtfs_stop_id", "time_bin"]).collect()}
    exp = {(r["gtfs_stop_id"], r["time_bin"]): r["user_count"]
           for r in users_per_bin(A.model_events(spark, SF001), width="2 minutes").collect()}
    assert got == exp
