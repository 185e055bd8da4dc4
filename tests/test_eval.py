"""Evaluation / monitoring invariants on hand-written and sf0.001 scores."""

import math

from pyspark.sql import functions as F

from stopcast.operators import metrics as M
from stopcast.plans import scoring as S
from stopcast.sources.adapters import score_table
from tests.conftest import SF001


def test_drift_histogram_shares_and_psi(spark):
    s = score_table(spark, SF001)
    d = S.drift_histogram(s.where("id < 500"), s.where("id >= 500"), "score").collect()
    assert math.isclose(sum(r["pct_train"] for r in d), 1.0) and math.isclose(sum(r["pct_new"] for r in d), 1.0)
    assert all(r["psi"] >= 0 for r in d) and all(0 <= r["bin"] <= 49 for r in d)


def test_classification_report_consistency(spark):
    s = score_table(spark, SF001)
    rows = {r["class"]: r for r in M.classification_report(s, 0.5).collect()}
    for k in ("precision", "recall", "f1"):
        assert math.isclose(rows["macro avg"][k], (rows["0"][k] + rows["1"][k]) / 2)
    n = rows["0"]["support"] + rows["1"]["support"]
    assert rows["accuracy"]["support"] == n == s.count()
    pm = M.point_metrics(s, 0.5).first()
    assert math.isclose(pm["precision"], rows["1"]["precision"]) and math.isclose(pm["f1_macro"], rows["macro avg"]["f1"])


def test_retrain_rule_and_confidence(spark):
    good = spark.createDataFrame([(i, i % 2, 0.9 if i % 2 else 0.1) for i in range(20)], "id long, label int, score double")
    r = S.retrain_rule(M.roc_auc(good), M.point_metrics(good, 0.5)).first()
    assert r["roc_auc"] == 1.0 and r["accuracy"] == 1.0 and r["retrain"] == 0
    bad = good.withColumn("score", F.lit(0.5))
    r = S.retrain_rule(M.roc_auc(bad), M.point_metrics(bad, 0.5)).first()
    assert r["retrain"] == 1
    c = M.confidence(good, 0.6).collect()
    assert all(x["confianca"] == (x["score"] if x["predicao"] == 1 else 1 - x["score"]) for x in c)


def test_threshold_min_precision_default(spark):
    df = spark.createDataFrame([(1, 0, 0.9), (2, 0, 0.8), (3, 1, 0.1)], "id long, label int, score double")
    r = M.threshold_min_precision(df, 0.35).first()
    assert r["best_threshold"] == 0.5          # precision <= 1/3 everywhere: none qualifies -> 0.5
    df2 = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.3), (4, 0, 0.2)], "id long, label int, score double")
    r2 = M.threshold_min_precision(df2, 0.35).first()
    # recall 1.0 first reached at 0.3 (precision 2/3); 0.2 also has recall 1.0 with precision 0.5 -> smallest wins
    assert r2["best_threshold"] == 0.2 and r2["recall"] == 1.0
