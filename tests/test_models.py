"""Checks of the model queries that need no other solver: bands on separable
data, invariants of weights and cuts."""

from pyspark.sql import functions as F

from stopcast.operators import metrics as M
from stopcast.plans import models as MD


def separable(spark, n=400):
    df = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 4 == 0).cast("int").alias("target"))
    return df.withColumns({"a": F.col("target") * 2.0 + F.rand(1), "b": F.rand(2), "is_train": (F.col("event_id") < 300).cast("int")})


def test_class_weights_come_from_the_training_rows(spark):
    rows = [(i, int(i % 4 == 0), 1) for i in range(100)] + [(100 + i, 1, 0) for i in range(100)]
    df = spark.createDataFrame(rows, "event_id long, target int, is_train int")
    got = {r["label"]: r["weight"] for r in MD.prepare(df, fit_on="is_train = 1").select("label", "weight").distinct().collect()}
    assert got == {1.0: 100 / (2 * 25), 0.0: 100 / (2 * 75)}


def test_linear_svm_is_cut_at_its_own_margin(spark):
    d = MD.prepare(separable(spark), fit_on="is_train = 1").cache()
    train, test = d.where("is_train = 1"), d.where("is_train = 0")
    model, scores, _ = MD.fit_score(MD.linear_svm(C=0.1, n=300), train, test, ["a", "b"], scale=True)
    raw = {r["event_id"]: r["prediction"] for r in model.transform(test).select("event_id", "prediction").collect()}
    assert all((r["score"] >= 0.5) == (raw[r["id"]] == 1.0) for r in scores.collect())
    assert M.point_metrics(scores, 0.5).first()["recall"] > 0.9


def test_models_separate_what_is_separable(spark):
    d = MD.prepare(separable(spark), fit_on="is_train = 1").cache()
    train, test = d.where("is_train = 1"), d.where("is_train = 0")
    for estimator, scale in ((MD.logreg_sgd(alpha=1e-4), True), (MD.decision_tree(maxDepth=4, minInstancesPerNode=1), False),
                             (MD.naive_bayes(), False)):
        _, scores, _ = MD.fit_score(estimator, train, test, ["a", "b"], scale=scale)
        assert MD.evaluate(scores)["roc_auc"] > 0.98


def test_leaderboard_ranks_a_fixed_table(spark):
    df = spark.createDataFrame([("x", "m", 0.7), ("y", "m", 0.9), ("a", "m", 0.7)], "config string, model string, roc_auc double")
    assert [(r["config"], r["rank"]) for r in MD.leaderboard(df).orderBy("rank").collect()] == [("y", 1), ("a", 2), ("x", 3)]


def test_sweeps_run_every_configuration(spark, monkeypatch):
    from unittest.mock import MagicMock

    from stopcast.queries import q_models as Q
    tr, ran = MagicMock(), {}
    tr.agg.return_value.first.return_value = (100,)
    monkeypatch.setattr(Q, "training", lambda *_, **__: (tr, tr, tr, []))
    monkeypatch.setattr(MD, "config_sweep", lambda s, a, b, f, name, cfg, *_, **__: ran.update({name: cfg}))
    Q.q_random_forest(spark, "")
    Q.q_gbt(spark, "")
    assert list(ran["random_forest"]) == list(MD.RF_CONFIGS) and list(ran["gbt"]) == list(MD.GBT_CONFIGS)


def test_random_search_resamples_training_rows_alone(spark):
    """Points of two families over folds; only the rows before a fold are resampled, once a fold."""
    from stopcast.operators.resample import smote_tomek
    df = separable(spark, 300).withColumns({"label": F.col("target").cast("double"), "fold": (F.floor(F.col("event_id") / 75) - 1).cast("int")})
    seen = []

    def resample(d):
        seen.append({r["id"] for r in d.select("id").collect()})
        return smote_tomek(d, k=3, sampling_strategy=0.5, label="label", id_col="id", vec="vec")

    grid = {"random_forest": (MD.random_forest, {"numTrees": [3, 5], "maxDepth": [3, 4], "features": ["sqrt", "log2"], "balanced": [True, False]}),
            "gbt": (MD.gbt, {"maxIter": [2], "maxDepth": [2], "stepSize": [0.1], "balanced": [False]})}
    got = MD.random_search(spark, df, grid, ["a", "b"], n_iter=2, k=3, resample=resample).collect()
    assert sorted(r["model"] for r in got) == ["gbt", "random_forest", "random_forest"]
    assert all(r["cv_mean"] > 0.9 and r["cv_std"] >= 0 for r in got)
    assert seen == [set(range(75 * (i + 1))) for i in range(3)]


def test_random_search_fits_large_forests_in_groups(spark, monkeypatch):
    """Where rows and nodes are many, no fit grows more than a fourth of a forest's trees; all trees are grown."""
    from pyspark.ml import Pipeline
    df = separable(spark, 300).withColumns({"label": F.col("target").cast("double"), "fold": (F.floor(F.col("event_id") / 75) - 1).cast("int")})
    grid = {"random_forest": (MD.random_forest, {"numTrees": [6], "maxDepth": [4], "balanced": [True]}),
            "gbt": (MD.gbt, {"maxIter": [2], "maxDepth": [2], "balanced": [False]})}
    whole = MD.random_search(spark, df, grid, ["a", "b"], n_iter=1, k=3).collect()
    monkeypatch.setattr(MD, "MANY_ROWS", 100)      # folds train on 75, 150 and 225 rows
    monkeypatch.setattr(MD, "DEEP_NODES", 10)
    fits, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, d: fits.append(self.getStages()[-1]) or fit(self, d))
    got = MD.random_search(spark, df, grid, ["a", "b"], n_iter=1, k=3).collect()
    assert sorted(f.getNumTrees() for f in fits if hasattr(f, "getNumTrees")) == [2] * 6 + [6]
    assert sorted((r["model"], r["params"]) for r in got) == sorted((r["model"], r["params"]) for r in whole)
    assert all(r["cv_mean"] > 0.9 for r in whole + got)


def test_stacking_joins_bases_and_meta(spark):
    from pyspark.ml.classification import GBTClassifier
    d = MD.prepare(separable(spark), fit_on="is_train = 1").cache()
    train, test = d.where("is_train = 1"), d.where("is_train = 0")
    bases = {"tree": lambda: MD.decision_tree(maxDepth=3), "sgd": lambda: MD.logreg_sgd(alpha=1e-3)}
    oof = MD.oof_scores(train, bases, ["a", "b"], k=3, scale={"sgd"})
    assert sorted(r["id"] for r in oof.collect()) == list(range(300)) and oof.where("tree IS NULL OR sgd IS NULL").count() == 0
    for meta in (None, lambda: GBTClassifier(maxIter=2, maxDepth=2)):
        pred, auc = MD.stacking(spark, train, test, ["a", "b"], bases, k=3, scale={"sgd"}, meta=meta)
        assert pred.count() == 100 and auc > 0.98


def test_gaussian_naive_bayes_against_the_formula(spark):
    import numpy as np
    r = np.random.default_rng(0)
    x, y = r.normal(size=(200, 2)) * [1, 50], r.integers(0, 2, 200)
    x += y[:, None]
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "event_id long, a double, b double, target int")
    got = {s["id"]: s["score"] for s in MD.gaussian_nb_scores(df.where("event_id < 150"), df.where("event_id >= 150"), ["a", "b"]).collect()}
    tr, z, eps = x[:150], y[:150], 1e-9 * x[:150].var(axis=0).max()
    like = []
    for k in (0, 1):
        m, v = tr[z == k].mean(axis=0), tr[z == k].var(axis=0) + eps
        like.append(np.log((z == k).sum()) - 0.5 * (np.log(2 * np.pi * v) + (x - m) ** 2 / v).sum(axis=1))
    want = 1 / (1 + np.exp(like[0] - like[1]))
    assert len(got) == 50 and all(abs(got[i] - want[i]) < 1e-9 for i in got)
    stats = {(s["label"], s["feature"]): s for s in MD.nb_statistics(df, ["a", "b"]).collect()}
    assert abs(stats[1, "b"]["mean"] - x[y == 1, 1].mean()) < 1e-9 and stats[0, "a"]["n"] == (y == 0).sum()


def test_a_large_forest_is_fitted_in_groups_of_trees(spark, monkeypatch):
    """No fit has more nodes than the bound; the groups' scores and importances are those of one
    forest; rows with a repeated or no id stay rows."""
    d = MD.prepare(separable(spark), fit_on="is_train = 1").cache()
    train, test = d.where("is_train = 1"), d.where("is_train = 0")
    test = test.withColumn("event_id", F.when(F.col("event_id") < 390, F.lit(7)))
    fitted, plain = [], MD.build_pipeline
    monkeypatch.setattr(MD, "build_pipeline", lambda e, *a, **k: fitted.append((e.getNumTrees(), e.getSeed())) or plain(e, *a, **k))
    monkeypatch.setattr(MD, "FOREST_NODES", 3 * 600)
    got = MD.config_sweep(spark, train, test, ["a", "b"], "random_forest", {"X": dict(numTrees=8)}, MD.random_forest).first()
    assert sorted(n for n, _ in fitted) == [2, 3, 3] and len({s for _, s in fitted}) == 3 and got["roc_auc"] > 0.98
    scores, _ = MD.scored(MD.random_forest(numTrees=8), train, test, ["a", "b"])
    assert scores.count() == 100 and scores.where("id = 7").count() == 90
    assert scores.where("score < 0 OR score > 1").count() == 0
    many = MD.forest_importances(MD.random_forest(numTrees=8), train, ["a", "b"])
    monkeypatch.setattr(MD, "FOREST_NODES", 10 ** 9)
    one = MD.forest_importances(MD.random_forest(numTrees=8), train, ["a", "b"])
    assert abs(sum(many) - 1) < 1e-9 and many[0] > 0.8 and abs(many[0] - one[0]) < 0.15


def test_boosted_trees_do_without_cached_nodes(spark):
    """The same trees, without a table of nodes a level."""
    d = MD.prepare(separable(spark), fit_on="is_train = 1").cache()
    g = MD.gbt(maxIter=3, maxDepth=3)
    assert not g.getCacheNodeIds() and not MD.gbt(maxDepth=16).getCacheNodeIds()
    a, b = (MD.build_pipeline(e, ["a", "b"]).fit(d.where("is_train = 1")).stages[-1] for e in (g, MD.gbt(maxIter=3, maxDepth=3).setCacheNodeIds(True)))
    assert a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]


def noisy(spark, n=3000):
    """Integer features of few values, so that bins are the values."""
    df = spark.range(n).select(F.col("id").alias("event_id"), *[(F.pmod(F.xxhash64(F.col("id"), F.lit(i)), F.lit(m))).cast("double").alias(c)
                                                                for i, (c, m) in enumerate((("a", 40), ("b", 7), ("c", 60), ("d", 2), ("e", 13)))])
    noise = F.pmod(F.xxhash64(F.col("event_id"), F.lit(99)), F.lit(10)) < 2
    return df.withColumns({"target": ((F.col("a") + 3 * F.col("b") > 30) != noise).cast("int"), "is_train": (F.col("event_id") < n * 3 // 4).cast("int")})


def test_a_tree_by_task_is_mllibs_tree(spark, monkeypatch):
    """Nodes, depth, scores and importances are those of MLlib where nothing is drawn, weighted or not."""
    d = MD.prepare(noisy(spark), fit_on="is_train = 1").cache()
    train, test, names = d.where("is_train = 1").repartition(3), d.where("is_train = 0"), ["a", "b", "c", "d", "e"]
    for params in (dict(maxDepth=4), dict(), dict(minInstancesPerNode=20, balanced=True)):
        monkeypatch.setattr(MD, "OWN_ROWS", 10 ** 9)
        scores, _, nodes, depth = MD.tree_scored(MD.decision_tree(**params), train, test, names)
        want = {r["id"]: (r["label"], r["score"]) for r in scores.collect()}
        model = MD.build_pipeline(MD.decision_tree(**params), names).fit(train).stages[-1]
        monkeypatch.setattr(MD, "OWN_ROWS", 100)
        monkeypatch.setattr(MD.FT, "BLOCK", 170)
        monkeypatch.setattr(MD, "build_pipeline", None)
        scores, _, own_nodes, own_depth = MD.tree_scored(MD.decision_tree(**params), train, test, names)
        got = {r["id"]: (r["label"], r["score"]) for r in scores.collect()}
        importances = MD.FT.fit(MD.decision_tree(**params), train, names)[0]["importances"]
        monkeypatch.undo()
        if params.get("maxDepth"):
            assert (own_nodes, own_depth) == (nodes, depth)
        assert abs(own_nodes - nodes) <= 0.03 * nodes and abs(own_depth - depth) <= 2 and got.keys() == want.keys()
        same = [got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-9 for i in got]
        assert sum(same) >= (1.0 if params.get("maxDepth") else 0.9) * len(same)       # equal gains may be cut in another order
        assert all(abs(a - b) < 0.02 for a, b in zip(importances, model.featureImportances.toArray(), strict=True))


def test_forests_by_task_grow_every_tree(spark, monkeypatch):
    """All trees, over rows with repeated and null ids; one fit serves sweeps, importances and vectors."""
    from pyspark.ml.functions import array_to_vector
    d = MD.prepare(noisy(spark), fit_on="is_train = 1").cache()
    train, test, names = d.where("is_train = 1"), d.where("is_train = 0"), ["a", "b", "c", "d", "e"]
    forest = lambda **k: MD.random_forest(numTrees=14, minInstancesPerNode=5, **k)     # noqa: E731
    want = MD.evaluate(MD.fit_score(forest(), train, test, names)[1])["roc_auc"]
    plain = MD.forest_importances(forest(), train, names)
    monkeypatch.setattr(MD, "OWN_ROWS", 100)
    monkeypatch.setattr(MD, "build_pipeline", None)
    row = MD.config_sweep(spark, train, test, names, "random_forest", {"X": dict(numTrees=14, minInstancesPerNode=5)}, MD.random_forest).first()
    assert abs(row["roc_auc"] - want) < 0.03
    assert max(abs(a - b) for a, b in zip(MD.forest_importances(forest(), train, names), plain, strict=True)) < 0.05
    odd = test.withColumn("event_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).when(F.col("event_id") % 3 == 1, F.col("event_id")))
    vec = [x.withColumn("features", array_to_vector(F.array(*names))).drop(*names) for x in (train, odd)]
    grown, real = [], MD.FT.grow
    x = MD.FT.np.random.default_rng(0).integers(0, 9, (500, 4)).astype("uint8")
    rule, trees = MD.FT.rule_of(forest(), 4)
    assert (trees, rule.some, rule.bootstrap) == (14, 2, True)
    for i in range(2):
        grown.append(real(x, x[:, 0] > 4, None, rule, i))
    assert grown[0].nodes > 1 and list(grown[0].cut) != list(grown[1].cut)
    scores, _ = MD.scored(forest(balanced=True), vec[0], vec[1], None)
    got = scores.collect()
    assert len(got) == 750 and sum(r["id"] == 7 for r in got) >= 250 and sum(r["id"] is None for r in got) == 250
    assert all(0 <= r["score"] <= 1 for r in got)
