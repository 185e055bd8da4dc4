"""Queries for models, validation loops, sinks and scoring (SURVEY §2.1
SRC3/SRC4/SNK1-3, §2.9 FT6/FT9, §2.11 VS3-VS10, §2.12 MD1-MD9, MD11, EV12,
SRT5, PR1, §2.4 AG24, §2.8 SC26).

Model results depend on solvers and seeds, so these are rows-only checks here;
metric bands and invariants are tested in tests/test_models.py and
tests/test_linear.py.  Linear configurations are fitted together from shared scans,
trees one by one.  Sweeps use the reference configurations; where a registered query
runs a smaller configuration than the reference script, its docstring says so.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.functions import features as FE
from stopcast.operators import metrics as M
from stopcast.operators import profiles as P
from stopcast.operators import transforms as T
from stopcast.operators.rowindex import holdout_split
from stopcast.plans import models as MD
from stopcast.plans.scoring import batch_score
from stopcast.plans.training import feature_columns, training_table
from stopcast.queries.q_etl import _me, out
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, SCORES, STOPS, snap, with_
from stopcast.session import materialize
from stopcast.sources import adapters as A
from stopcast.sources import files as FS


def training(spark, sf, balanced=True):
    """Leak-free training table (history, formulas, cleaning, TimeSeriesSplit(3)),
    written once for the query's fits; class weights come from its training
    rows alone.  Returns (all, train, test, features)."""
    t = materialize(MD.prepare(training_table(_me(spark, sf)), balanced=balanced, fit_on="is_train = 1"))
    feats = [c for c in feature_columns(t) if c not in ("label", "weight", "is_valid")]
    return t, t.where("is_train = 1"), t.where("is_test = 1"), feats


@query("random_forest")
def q_random_forest(spark, sf):
    """MD1 + VS4: the five random-forest configurations of the reference."""
    _, tr, te, feats = training(spark, sf)
    return MD.config_sweep(spark, tr, te, feats, "random_forest", MD.RF_CONFIGS, MD.random_forest)


@query("decision_tree")
def q_decision_tree(spark, sf):
    """MD2: five tree configurations with node and leaf count and depth."""
    _, tr, te, feats = training(spark, sf)
    rows = []
    for name, params in MD.DT_CONFIGS.items():
        sc, secs, nodes, depth = MD.tree_scored(MD.decision_tree(**params), tr, te, feats)
        ev = MD.evaluate(sc)
        rows.append((name, ev["roc_auc"], ev["f1_macro"], nodes, (nodes + 1) // 2, depth, secs))
    return spark.createDataFrame(rows, "config string, roc_auc double, f1_macro double, n_nodes long, n_leaves long, depth long, train_time double")


@query("gbt")
def q_gbt(spark, sf):
    """MD3: boosted trees with early stopping on the last 10 % of the train
    part; the nine configurations of the reference."""
    t, tr, te, feats = training(spark, sf)
    n_tr = tr.agg(F.max("row_idx")).first()[0]
    trv = tr.withColumn("is_valid", F.col("row_idx") >= F.lit(int(n_tr * 0.9)))
    cfg = {k: dict(c, validation=True) for k, c in MD.GBT_CONFIGS.items()}
    return MD.config_sweep(spark, trv, te, feats, "gbt", cfg, MD.gbt)


def _linear(*models, n=None):
    """(model, configuration) -> parameters of the linear families."""
    every = {("logreg_sgd", c): p for c, p in MD.SGD_CONFIGS.items()}
    every |= {("linear_svm", f"C={c}{'' if loss == 'squared_hinge' else ' ' + loss}"): dict(C=c, n=n, loss=loss)
              for c in MD.SVC_C for loss in ("squared_hinge", "hinge")}
    return {k: p for k, p in every.items() if k[0] in models}


@query("logreg_sgd")
def q_logreg_sgd(spark, sf):
    """MD4: log-loss linear models (alpha, L2 / elastic / L1), scaled, balanced; all
    configurations from shared scans."""
    t, _, _, feats = training(spark, sf)
    return MD.linear_sweep(spark, t, feats, _linear("logreg_sgd"))


@query("linear_svm")
def q_linear_svm(spark, sf):
    """MD5: linear SVM, C in {0.1, 1, 10}, squared hinge (LinearSVC's loss) and hinge,
    L2 penalty 1/(n C); uncalibrated, cut at the margin 0, and calibrated (MD9)."""
    t, tr, _, feats = training(spark, sf)
    cfg = _linear("linear_svm", n=tr.count())
    plain = MD.linear_sweep(spark, t, feats, cfg)
    return plain.unionByName(MD.calibrated_sweep(spark, t, feats, cfg).withColumn("model", F.lit("linear_svm_calibrated")))


@query("naive_bayes")
def q_naive_bayes(spark, sf):
    """MD7: Gaussian on raw features, multinomial on train min-max x100,
    Bernoulli on train-median binarised features."""
    _, tr, te, feats = training(spark, sf)
    rows = []
    for kind, prep in (("gaussian", None), ("multinomial", T.minmax_x100), ("bernoulli", T.binarize_median)):
        a, b = (tr, te) if prep is None else (prep(tr, feats, fit_on=tr), prep(te, feats, fit_on=tr))
        if kind == "bernoulli":
            a = a.withColumns({c: F.col(c).cast("double") for c in feats})
            b = b.withColumns({c: F.col(c).cast("double") for c in feats})
        _, sc, secs = MD.fit_score(MD.naive_bayes(kind), a, b, feats)
        ev = MD.evaluate(sc)
        rows.append((kind, "naive_bayes", *ev.values(), secs))
    return spark.createDataFrame(rows, MD.RESULT_SCHEMA)


def _small_bases():
    return {"random_forest": lambda: MD.random_forest(numTrees=50, maxDepth=10, minInstancesPerNode=20, balanced=True),
            "gbt": lambda: MD.gbt(maxIter=20, stepSize=0.1, maxDepth=4),
            "sgd": lambda: MD.logreg_sgd(alpha=1e-3)}


@query("stacking")
def q_stacking(spark, sf):
    """MD8: RF + boosted + SGD bases, 5-fold out-of-fold probabilities,
    logistic-regression meta model.  Bases run smaller than the reference
    (50 trees depth 10; 20 boosting rounds) to keep the check short."""
    _, tr, te, feats = training(spark, sf)
    pred, auc = MD.stacking(spark, tr, te, feats, _small_bases(), k=5, scale={"sgd"})
    return pred.select("id", "label", "score")


@query("calibrate_sigmoid")
def q_calibrate_sigmoid(spark, sf):
    """MD9: LinearSVC + Platt scaling (3 folds, mean of calibrated pairs)."""
    _, tr, te, feats = training(spark, sf)
    n = tr.count()
    return MD.calibrate_sigmoid(spark, tr, te, feats, lambda: MD.linear_svm(C=1.0, n=n), k=3)


@query("feature_importance")
def q_feature_importance(spark, sf):
    """MD11 (+SRT2): sorted impurity importances of every random-forest configuration,
    and absolute coefficients of every linear one."""
    t, tr, _, feats = training(spark, sf)
    rows, forests = [], {name: MD.random_forest(**params) for name, params in MD.RF_CONFIGS.items()}
    even = MD.forest_rows(tr, *forests.values())
    for name, forest in forests.items():
        rows += [("random_forest", name, c, x) for c, x in zip(feats, MD.forest_importances(forest, even, feats))]
    for (model, name), m in MD.linear_models(t, feats, _linear("logreg_sgd")).items():
        rows += [(model, name, c, abs(float(x))) for c, x in zip(feats, m.coef)]
    df = spark.createDataFrame(rows, "model string, config string, feature string, importance double")
    return df.orderBy("model", "config", F.desc("importance"), "feature")


@query("cross_val_auc")
def q_cross_val_auc(spark, sf):
    """VS3: 5 expanding folds (train on every earlier row), AUC mean / std of every
    configuration of the linear families; class weights and scaling are each fold's own."""
    from stopcast.operators.rowindex import time_series_split
    _, tr, _, feats = training(spark, sf)       # the holdout rows take no part
    t = materialize(time_series_split(tr.drop("row_idx", "fold", "is_train", "is_test"), 5))
    return MD.linear_cross_val(t, feats, _linear("logreg_sgd", "linear_svm", n=tr.count()))


def _sweep(spark, sf, forests):
    """All configurations of the linear families (shared scans) and of the trees, and of the
    forests if asked; the nine boosted ones are in the query ``gbt``."""
    t, tr, te, feats = training(spark, sf)
    cfg = _linear("logreg_sgd", "linear_svm", n=tr.count())
    out_ = MD.linear_sweep(spark, t, feats, {k: p for k, p in cfg.items() if k[0] == "logreg_sgd"})
    out_ = out_.unionByName(MD.calibrated_sweep(spark, t, feats, {k: p for k, p in cfg.items() if k[0] == "linear_svm"}))
    trees = [("decision_tree", MD.DT_CONFIGS, MD.decision_tree)] + ([("random_forest", MD.RF_CONFIGS, MD.random_forest)] if forests else [])
    for name, configs, builder in trees:
        out_ = out_.unionByName(MD.config_sweep(spark, tr, te, feats, name, configs, builder))
    return out_


@query("config_sweep")
def q_config_sweep(spark, sf):
    """VS4: every named configuration of the linear, tree and forest families, one metrics row each."""
    return _sweep(spark, sf, forests=True)


@query("leaderboard")
def q_leaderboard(spark, sf):
    """SRT5: the configurations of the linear and tree families ranked by ROC-AUC."""
    return MD.leaderboard(_sweep(spark, sf, forests=False))


@query("impact_vs_baseline")
def q_impact(spark, sf):
    """VS9: AUC difference and % change of every configuration against the
    BASELINE row (scalar subquery, no cross join)."""
    t, _, _, feats = training(spark, sf)
    return MD.impact_vs_baseline(materialize(MD.linear_sweep(spark, t, feats, _linear("logreg_sgd"))))


_RESULTS = with_(SCORES) + """,
named AS (SELECT CASE WHEN id % 5 = 0 THEN 'BASELINE' ELSE 'CONFIG_' || CAST(id % 5 AS VARCHAR) END AS config, label, score FROM scores),
results AS (SELECT config, sum(pos * (2 * nb + neg)) / (sum(pos) * sum(neg) * 2.0) AS roc_auc FROM (
    SELECT *, coalesce(sum(neg) OVER (PARTITION BY config ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM (
      SELECT config, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg
      FROM named GROUP BY config, score)) GROUP BY config)"""
_BASE = "(SELECT roc_auc FROM results WHERE config = 'BASELINE')"


@query("impact_table", _RESULTS + f"\nSELECT config, {snap('roc_auc')} AS roc_auc, {snap(f'roc_auc - {_BASE}')} AS delta_auc, "
       f"{snap(f'100.0 * (roc_auc - {_BASE}) / {_BASE}')} AS delta_pct FROM results")
def q_impact_table(spark, sf):
    """VS9 over a results table: the ROC-AUC of five groups of the score table, all in
    one plan, against the group named BASELINE."""
    group = F.col("id") % 5
    sc = A.score_table(spark, sf).withColumn("config", F.when(group == 0, "BASELINE").otherwise(F.concat(F.lit("CONFIG_"), group.cast("string"))))
    return out(MD.impact_vs_baseline(materialize(M.metrics_by(sc, "config").select("config", "roc_auc"))))


_NB = ["dist_device_stop", "user_frequency", "device_lat", "device_lon", "stop_lat_event", "gtfs_route_id"]
_NB_ROWS = with_(MODEL_EVENTS) + ",\nnb AS (SELECT event_id, target, " + ", ".join(
    f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in _NB) + """, row_number() OVER (ORDER BY event_timestamp, event_id) - 1 AS r,
  count(*) OVER () AS n FROM model_events),
tr AS (SELECT * FROM nb WHERE r < floor(0.8 * n))"""


def _nb_rows(spark, sf):
    return materialize(holdout_split(_me(spark, sf), 0.8).select("event_id", "target", "is_train", *[
        F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in _NB]))


@query("nb_statistics", _NB_ROWS + "\n" + "\nUNION ALL ".join(
    f"SELECT CAST(target AS BIGINT) AS label, '{c}' AS feature, count(*) AS n, {snap(f'avg({c})')} AS mean, {snap(f'var_pop({c})')} AS variance "
    "FROM tr GROUP BY target" for c in _NB))
def q_nb_statistics(spark, sf):
    """MD7: count, mean and variance of every feature in each class, over the older four fifths."""
    return out(MD.nb_statistics(_nb_rows(spark, sf).where("is_train = 1"), _NB))


def _nb_likely(k):
    return f"ln(n{k}) + " + " + ".join(
        f"(-0.5 * ln(2 * pi() * (v{k}_{c} + eps)) - ({c} - m{k}_{c}) * ({c} - m{k}_{c}) / (2.0 * (v{k}_{c} + eps)))" for c in _NB)


@query("nb_scores", _NB_ROWS + ",\nst AS (SELECT " + ", ".join(
    f"sum(CASE WHEN target = {k} THEN 1 ELSE 0 END) AS n{k}, " + ", ".join(
        f"avg({c}) FILTER (WHERE target = {k}) AS m{k}_{c}, var_pop({c}) FILTER (WHERE target = {k}) AS v{k}_{c}" for c in _NB) for k in (0, 1))
       + ", 1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in _NB) + f""") AS eps FROM tr)
SELECT event_id AS id, {snap(f'1.0 / (1.0 + exp(({_nb_likely(0)}) - ({_nb_likely(1)})))')} AS score FROM nb, st WHERE r >= floor(0.8 * n)""")
def q_nb_scores(spark, sf):
    """MD7: Gaussian naive Bayes of the newest fifth, from the statistics of the rest."""
    d = _nb_rows(spark, sf)
    return out(MD.gaussian_nb_scores(d.where("is_train = 1"), d.where("is_train = 0"), _NB))


def _families(feats):
    """The six families of the comparison: name -> fit on a training frame, scores of a
    test frame.  MLlib has no smallest split of 30 rows; its half, 15 rows a leaf,
    stands for it."""
    def fitted(estimator, scale=False, prep=None):
        def run(tr, te):
            a, b = (tr, te) if prep is None else (prep(tr, feats, fit_on=tr), prep(te, feats, fit_on=tr))
            if prep is not None:
                a, b = (d.withColumns({c: F.col(c).cast("double") for c in feats}) for d in (a, b))
            model = estimator()
            if isinstance(model, RandomForestClassifier):
                a = MD.forest_rows(a, model)
            return MD.scored(model, a, b, feats, scale=scale)[0]
        return run

    def nearest(tr, te):
        from stopcast.operators import knn as K
        a, b = (T.standard_scale(d, feats, fit_on=tr).select(F.col("event_id").alias("id"), F.array(*feats).alias("vec"), "label")
                for d in (tr, te))
        got = K.knn_scores(K.knn_join(b, a, 31, carry=["label"]), 31)
        return got.join(b.select(F.col("id").alias("qid"), F.col("label").cast("int").alias("label")), "qid").withColumnRenamed("qid", "id")

    return {"random_forest": fitted(lambda: MD.random_forest(numTrees=300, maxDepth=25, minInstancesPerNode=15)),
            "decision_tree": fitted(lambda: MD.decision_tree(maxDepth=20, minInstancesPerNode=50)),
            "knn": nearest,
            "logreg_sgd": fitted(lambda: MD.logreg_sgd(alpha=1e-3, balanced=False), scale=True),
            "gaussian_nb": fitted(lambda: MD.naive_bayes("gaussian")),
            "bernoulli_nb": fitted(lambda: MD.naive_bayes("bernoulli"), prep=T.binarize_median)}


@query("model_comparison")
def q_model_comparison(spark, sf):
    """EV12: one row per model family, trained on the train part undersampled 2:1:
    expanding 5-fold CV AUC mean / std there, holdout AUC, precision, recall, F1,
    F1-macro, time of all its fits."""
    import time

    from stopcast.operators.resample import undersample_ratio
    from stopcast.operators.rowindex import time_series_split
    _, tr, te, feats = training(spark, sf, balanced=False)
    cut = materialize(undersample_ratio(tr, 2.0, shuffle=False))
    folds = materialize(time_series_split(cut.drop("row_idx", "fold", "is_train", "is_test"), 5))
    rows = []
    for name, fit in _families(feats).items():
        t0 = time.time()
        parts = [materialize(fit(folds.where(F.col("fold") < i), folds.where(F.col("fold") == i))) for i in range(5)]
        held = materialize(fit(cut, te))
        secs = time.time() - t0
        every = held.select(F.lit("test").alias("part"), "label", "score")
        for i, p in enumerate(parts):
            every = every.unionByName(p.select(F.lit(f"fold {i}").alias("part"), "label", "score"))
        got = {r["part"]: r for r in M.metrics_by(every, "part").collect()}
        aucs = [got[f"fold {i}"]["roc_auc"] for i in range(5) if f"fold {i}" in got and got[f"fold {i}"]["roc_auc"] is not None]
        mean = sum(aucs) / max(1, len(aucs))
        rows.append((name, mean, (sum((a - mean) ** 2 for a in aucs) / max(1, len(aucs))) ** 0.5,
                     *[got["test"][c] for c in ("roc_auc", "accuracy", "precision", "recall", "f1", "f1_macro")], secs))
    return spark.createDataFrame(rows, "model string, cv_mean double, cv_std double, roc_auc double, accuracy double, "
                                       "precision double, recall double, f1 double, f1_macro double, train_time double")


#: The grids of the reference with fewer trees and rounds, and MLlib's depth limit for
#: deeper trees; README has the time of full-size fits.
SEARCH = {
    "random_forest": (MD.random_forest, {"numTrees": [10, 20, 30], "maxDepth": [None, 5, 10, 20], "minInstancesPerNode": [1, 2, 4],
                                         "features": ["sqrt", "log2"], "balanced": [True, False]}),
    "gbt": (MD.gbt, {"maxDepth": [3, 5, 7], "stepSize": [0.01, 0.03, 0.05, 0.1], "maxIter": [5, 10, 15],
                     "subsamplingRate": [0.7, 0.8, 0.9, 1.0], "features": [0.6, 0.7, 0.8, 0.9, 1.0], "balanced": [False]}),
}


@query("random_search")
def q_random_search(spark, sf):
    """VS5: 10 seeded points of a forest and of a boosted-tree grid, expanding 3-fold CV on
    positive-class F1, SMOTE and Tomek cleaning inside every fold's training rows."""
    from stopcast.operators.resample import smote_tomek
    t, _, _, feats = training(spark, sf)
    return MD.random_search(spark, t, SEARCH, feats, n_iter=10, k=3,
                            resample=lambda d: smote_tomek(d, k=5, sampling_strategy=0.5, label="label", id_col="id", vec="vec"))


@query("coef_select")
def q_coef_select(spark, sf):
    """VS7: drop |coef| < t for t in {.01,...,.10}, retrain, compare."""
    _, tr, te, feats = training(spark, sf)
    res, _ = MD.coef_select(spark, tr, te, feats)
    return res


@query("removed_features")
def q_removed_features(spark, sf):
    """SNK3 (+SET3): kept and removed feature names of the best threshold."""
    from stopcast.operators.eda import names_table, set_difference
    _, tr, te, feats = training(spark, sf)
    _, keep = MD.coef_select(spark, tr, te, feats)
    allf, kept = names_table(spark, feats), names_table(spark, keep)
    removed = set_difference(allf, kept)
    return kept.withColumn("status", F.lit("kept")).unionByName(removed.withColumn("status", F.lit("removed")))


@query("gain_select")
def q_gain_select(spark, sf):
    """VS8: 50-round boosted model, top 50 features by importance."""
    _, tr, _, feats = training(spark, sf)
    return MD.gain_select(spark, tr, feats, top=50, iters=50)


@query("rfe")
def q_rfe(spark, sf):
    """VS10: recursive elimination down to 15 features."""
    _, tr, _, feats = training(spark, sf)
    keep = MD.rfe(tr, feats, 15)
    return spark.createDataFrame([(f,) for f in keep], "feature string")


@query("save_model")
def q_save_model(spark, sf):
    """SNK2: fit, save to the shared folder, load back, score."""
    from pyspark.ml import PipelineModel
    _, tr, te, feats = training(spark, sf)
    m, sc, _ = MD.fit_score(MD.logreg_sgd(alpha=1e-3), tr, te, feats, scale=True)
    path = FS.shared_path(spark, "model")
    m.write().overwrite().save(path)
    m2 = PipelineModel.load(path)
    return m2.transform(te).select(F.col("event_id").alias("id"), MD.score_col(m2).alias("score"))


@query("batch_score")
def q_batch_score(spark, sf):
    """PR1 + PR2: a saved pipeline with the encoder inside takes raw stops and users ->
    probabilities -> class at 0.6 and confidence."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    from stopcast.plans.encoder import LexicalEncoder
    _, tr, te, feats = training(spark, sf)
    raw = ["gtfs_stop_id", "user_pseudo_id"]
    coded = [c for c in feats if c not in raw] + [f"{c}_code" for c in raw]
    model = Pipeline(stages=[
        LexicalEncoder(inputCols=raw, unseen="minus_one"),
        VectorAssembler(inputCols=coded, outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        MD.logreg_sgd(alpha=1e-3).setFeaturesCol("features").setLabelCol("label")]).fit(tr)
    path = FS.shared_path(spark, "model")
    model.write().overwrite().save(path)
    return batch_score(path, te).select("event_id", "probabilidade", "predicao", "confianca")


@query("geo_cluster")
def q_geo_cluster(spark, sf):
    """FT6: K-means k=8 on valid coordinates; -1 without coordinates."""
    return MD.geo_cluster(_me(spark, sf)).select("event_id", "geo_cluster")


@query("cluster_target_rate")
def q_cluster_target_rate(spark, sf):
    """AG24: target rate per geo cluster as 8 sparse columns."""
    d = MD.geo_cluster(_me(spark, sf))
    return P.cluster_target_rate(d).select("event_id", *[f"cluster_{i}_conversion" for i in range(8)])


@query("tier_cluster_cross")
def q_tier_cluster_cross(spark, sf):
    """SC26: tier x period, cluster x hour, tier x weekend, cluster x period."""
    from stopcast.queries.q_features import frame
    d = MD.geo_cluster(frame(spark, sf))
    d = T.stop_tier(d).withColumn("is_weekend", cal.is_weekend("day_of_week"))
    return FE.with_tier_cluster_cross(d).select("event_id", "stop_tier_x_time_period", "geo_cluster_x_hour",
                                                "stop_tier_x_weekend", "geo_cluster_x_time_period")


@query("pca_geo")
def q_pca_geo(spark, sf):
    """FT9: 2 principal components of the 4 coordinate columns."""
    return MD.pca_geo(_me(spark, sf)).select("event_id", "geo_pc1", "geo_pc2")


_CSV_COLS = "event_id, target, dist_device_stop, user_frequency"


@query("write_csv", with_(MODEL_EVENTS) + f"\nSELECT {_CSV_COLS} FROM model_events")
def q_write_csv(spark, sf):
    """SNK1 + SRC3: write a feature table as CSV in the shared folder, read
    it back with a declared schema."""
    d = _me(spark, sf).select("event_id", F.col("target").cast("long").alias("target"), "dist_device_stop", "user_frequency")
    path = FS.write_table(d, FS.shared_path(spark, "features_csv"), fmt="csv")
    return FS.read_csv(spark, path, "event_id long, target long, dist_device_stop double, user_frequency long")


@query("scan_csv", with_(MODEL_EVENTS) + f"\nSELECT {_CSV_COLS} FROM model_events")
def q_scan_csv(spark, sf):
    """SRC3: CSV with header and inferred types (written from the events)."""
    d = _me(spark, sf).select("event_id", F.col("target").cast("long").alias("target"), "dist_device_stop", "user_frequency")
    path = FS.write_table(d, FS.shared_path(spark, "scan_csv"), fmt="csv")
    r = FS.read_csv(spark, path)
    return r.select(*[F.col(c).cast(t).alias(c) for c, t in
                      (("event_id", "long"), ("target", "long"), ("dist_device_stop", "double"), ("user_frequency", "long"))])


@query("scan_gtfs", with_(STOPS) + "\nSELECT stop_id, stop_lat, stop_lon FROM stops")
def q_scan_gtfs(spark, sf):
    """SRC4: GTFS text files as all-string tables; routes / trips are absent
    and come back as typed empty tables."""
    root = FS.shared_path(spark, "gtfs")
    FS.write_gtfs({"stops": A.gtfs_stops(spark, sf), "stop_times": A.gtfs_stop_times(spark, sf),
                   "frequencies": A.gtfs_frequencies(spark, sf)}, root)
    g = FS.read_gtfs(spark, root, {"stops": ["stop_id", "stop_lat", "stop_lon"], "stop_times": ["trip_id", "stop_id"],
                                   "frequencies": ["trip_id", "start_time", "headway_secs"], "routes": ["route_id"],
                                   "trips": ["trip_id", "route_id"]})
    assert g["routes"].columns == ["route_id"]
    return g["stops"]
