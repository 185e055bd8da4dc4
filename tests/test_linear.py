"""Linear models from shared scans: against MLlib's single fits and dense solvers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopcast.operators import metrics as M
from stopcast.plans import linear as L
from stopcast.plans import models as MD

NAMES = ["a", "b", "c", "flat"]


def frame(spark, n=600, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 3)) * [1.0, 30.0, 0.01] + [0.0, 1000.0, 5.0]
    y = (x[:, 0] + (x[:, 1] - 1000) / 30 + r.normal(size=n) > 0.8).astype(int)
    rows = [(i, *map(float, x[i]), 7.0, int(y[i]), i < 450, i >= 450, i % 3 != 0, i < 0) for i in range(n)]
    df = spark.createDataFrame(rows, "event_id long, a double, b double, c double, flat double, label int, train boolean, "
                                     "test boolean, fold boolean, none boolean")
    return df.repartition(5).cache(), x, y


def objective(p, w, b, x, y, weight):
    z = x @ w + b
    t = 2 * y - 1
    loss = np.logaddexp(0, -t * z) if p.loss == "log" else np.maximum(0, 1 - t * z) ** (2 if p.loss == "squared_hinge" else 1)
    return weight @ loss / weight.sum() + p.l2 / 2 * w @ w + p.l1 * np.abs(w).sum()


def standard(x, y, rows):
    z = (x - x[rows].mean(axis=0)) / x[rows].std(axis=0, ddof=1)
    n1 = y[rows].sum()
    weight = np.where(y == 1, rows.sum() / (2 * n1), rows.sum() / (2 * (rows.sum() - n1)))
    return z[rows], y[rows], weight[rows]


def test_log_loss_equals_single_fits(spark):
    """Every configuration of the sweep, on two subsets at once, against one MLlib fit each."""
    df, _, _ = frame(spark)
    problems = [MD.linear_problem(f"{name}:{s}", s, "logreg_sgd", params) for s in ("train", "fold") for name, params in MD.SGD_CONFIGS.items()]
    problems.append(L.Problem("strong", "train", l2=0.0, l1=0.05))
    got = L.fit_all(df, NAMES, problems)
    for s in ("train", "fold"):
        rows = MD.prepare(df.withColumn("target", F.col("label")), fit_on=s).where(s)
        for name, params in MD.SGD_CONFIGS.items():
            lr = MD.logreg_sgd(**params).setTol(1e-12).setMaxIter(500)
            model = MD.build_pipeline(lr, NAMES, scale=True).fit(rows)
            m = got[f"{name}:{s}"]
            assert np.allclose(m.coef, model.stages[-1].coefficients.toArray(), atol=2e-4), name
            assert abs(m.intercept - model.stages[-1].intercept) < 2e-4 and m.scans < 30
    assert got["strong"].coef[3] == 0 and (got["strong"].coef == 0).sum() >= 2


@pytest.mark.parametrize("loss", ["hinge", "squared_hinge"])
def test_hinges_against_a_dense_solver(spark, loss):
    """Objective within 1 % of long subgradient descent from many points."""
    df, x, y = frame(spark, 300)
    p = L.Problem("svm", "fold", loss=loss, l2=0.02)
    m = L.fit_all(df, NAMES, [p])["svm"]
    rows = np.arange(300) % 3 != 0
    z, t, weight = standard(x, y, rows)
    mine = objective(p, m.coef[:3], m.intercept, z, t, weight)
    w, b, best = np.zeros(3), 0.0, np.inf
    for i in range(20000):
        s = 2 * t - 1
        u = 1 - s * (z @ w + b)
        g = -weight * s * ((u > 0) if loss == "hinge" else 2 * np.maximum(u, 0)) / weight.sum()
        step = 2.0 / (1 + 0.02 * i) if loss == "hinge" else 0.3
        w, b = w - step * (z.T @ g + p.l2 * w), b - step * g.sum()
        best = min(best, objective(p, w, b, z, t, weight))
    assert mine <= 1.01 * best and mine >= best * 0.999 - 1e-9


def test_scores_and_metrics_of_all_problems(spark):
    df, x, _ = frame(spark)
    problems = [L.Problem("one", "train", l2=1e-3), L.Problem("two", "fold", l2=1e-1, features=("a",)), L.Problem("empty", "none")]
    models = L.fit_all(df, NAMES, problems)
    assert models["two"].coef[1] == 0 and models["two"].coef[0] != 0 and not models["empty"].coef.any()
    scores = L.score_all(df, [models[p.name] for p in problems], ["test", "test", "train"]).cache()
    got = {r["problem"]: r for r in M.metrics_by(scores, "problem").collect()}
    assert {k: scores.where(F.col("problem") == k).count() for k in models} == {"one": 150, "two": 150, "empty": 450}
    for name in models:
        alone = scores.where(F.col("problem") == name)
        want = M.point_metrics(alone).first()
        for c in ("accuracy", "precision", "recall", "f1", "f1_macro"):
            assert abs(got[name][c] - want[c]) < 1e-12, (name, c)
        assert abs(got[name]["roc_auc"] - M.roc_auc(alone).first()[0]) < 1e-12
    w, b = models["one"].raw()
    raw = {r["id"]: r["score"] for r in scores.where("problem = 'one'").collect()}
    assert all(abs(raw[i] - 1 / (1 + np.exp(-(x[i] @ w[:3] + 7 * w[3] + b)))) < 1e-9 for i in raw)


def test_scans_do_not_grow_with_the_problems(spark, monkeypatch):
    df, _, _ = frame(spark)
    scans, real = [], L._scan
    monkeypatch.setattr(L, "_scan", lambda *a: (scans.append(len(a[4])), real(*a))[1])
    L.fit_all(df, NAMES, [L.Problem("x", "train", l2=1e-2)])
    one = len(scans)
    scans.clear()
    L.fit_all(df, NAMES, [L.Problem(f"x{i}{s}", s, l2=10.0 ** -i) for i in range(1, 6) for s in ("train", "fold", "test")])
    assert len(scans) <= 2 * one and scans[0] == 15


def test_unknown_losses_and_shared_names_are_errors(spark):
    df, _, _ = frame(spark)
    with pytest.raises(ValueError):
        L.fit_all(df, NAMES, [L.Problem("x", "train", loss="cubic")])
    with pytest.raises(ValueError):
        L.fit_all(df, NAMES, [L.Problem("x", "train"), L.Problem("x", "fold")])


def test_platt_curves_of_all_problems(spark):
    """Each problem's sigmoid against MLlib's one-feature logistic regression."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    r = np.random.default_rng(1)
    rows = [(f"p{i % 3}", float(x), int(x * (i % 3 + 1) + r.logistic() > 0.3)) for i, x in enumerate(r.normal(size=900))]
    df = spark.createDataFrame(rows, "problem string, margin double, label int").cache()
    got = MD.platt_all(df)
    for k in ("p0", "p1", "p2"):
        d = VectorAssembler(inputCols=["margin"], outputCol="features").transform(df.where(F.col("problem") == k))
        m = LogisticRegression(maxIter=200, tol=1e-12, standardization=False).fit(d)
        assert abs(got[k][0] - m.coefficients[0]) < 1e-3 and abs(got[k][1] - m.intercept) < 1e-3


def test_folds_have_weights_and_scaling_of_their_own(spark):
    """A fold's model does not change with later rows."""
    df, _, _ = frame(spark)
    d = df.withColumn("fold", F.floor(F.col("event_id") / 100).cast("int") - 1)
    configs = {("logreg_sgd", "x"): dict(alpha=1e-3), ("linear_svm", "y"): dict(C=1.0, n=600, loss="squared_hinge")}
    a = {(r["model"], r["config"]): r["cv_mean"] for r in MD.linear_cross_val(d, NAMES, configs, k=3).collect()}
    later = d.withColumn("a", F.when(F.col("fold") >= 3, F.col("a") * 100).otherwise(F.col("a")))
    later = later.withColumn("label", F.when(F.col("fold") >= 3, 1).otherwise(F.col("label")))
    b = {(r["model"], r["config"]): r["cv_mean"] for r in MD.linear_cross_val(later, NAMES, configs, k=3).collect()}
    assert a == b and all(0.7 < v <= 1 for v in a.values())


def test_calibrated_probabilities(spark):
    df, _, _ = frame(spark)
    configs = {("linear_svm", f"C={c}"): dict(C=c, n=450, loss="squared_hinge") for c in (0.1, 1.0)}
    d = df.withColumns({"is_train": F.col("train").cast("int"), "is_test": F.col("test").cast("int")})
    got = {r["config"]: r for r in MD.calibrated_sweep(spark, d, NAMES, configs).collect()}
    plain = {r["config"]: r for r in MD.linear_sweep(spark, d, NAMES, configs).collect()}
    assert set(got) == {"C=0.1", "C=1.0"} == set(plain)
    assert all(abs(got[c]["roc_auc"] - plain[c]["roc_auc"]) < 0.03 and got[c]["accuracy"] > 0.7 for c in got)


def test_platt_scans_equal_curves_of_a_score_table(spark):
    """Sigmoids and calibrated scores from scans against those of the written scores."""
    df, _, _ = frame(spark)
    problems = [L.Problem(f"{c}|{i}", "train", "squared_hinge", l2=c) for c in (0.01, 1.0) for i in range(2)]
    models = list(L.fit_all(df, NAMES, problems).values())
    held = ["fold", "train", "fold", "none"]
    got = L.platt_models(df, models, held)
    assert got[3] is None
    scores = L.score_all(df, models, held).withColumn("margin", F.log(F.col("score") / (1 - F.col("score"))))
    want = MD.platt_all(scores)
    assert all(np.allclose(got[i], want[problems[i].name], atol=1e-6) for i in range(3))
    mine = {(r["problem"], r["id"]): r["score"] for r in L.score_calibrated(df, models, got, ["a", "a", "b", "b"], "test").collect()}
    table = L.score_all(df, models[:3], ["test"] * 3).collect()
    means = {}
    for r in table:
        a, b = want[r["problem"]]
        x = np.log(r["score"] / (1 - r["score"]))
        means.setdefault(("a" if r["problem"].startswith("0.01") else "b", r["id"]), []).append(1 / (1 + np.exp(-(a * x + b))))
    assert set(mine) == set(means) and all(abs(mine[k] - np.mean(v)) < 1e-6 for k, v in means.items())


def test_hinge_of_labels_that_nothing_explains_converges(spark):
    """No row lies within a narrow rounding at the start: the fit ends by itself, well before the cap."""
    r = np.random.default_rng(5)
    x, y = r.normal(size=(2000, 3)) * [1.0, 30.0, 0.01] + [0.0, 1000.0, 5.0], (r.random(2000) < 0.1).astype(int)
    x[:, 0] = np.exp(2 * x[:, 0])
    df = spark.createDataFrame([(i, *map(float, x[i]), 7.0, int(y[i]), True) for i in range(2000)],
                               "event_id long, a double, b double, c double, flat double, label int, train boolean").repartition(3).cache()
    m = L.fit_all(df, NAMES, [L.Problem("svm", "train", "hinge", l2=1.0 / 2000)])["svm"]
    assert m.scans < 55 < L.MAX_SCANS
    assert np.isfinite(m.objective) and m.objective <= 1.0


def test_the_table_is_read_once_however_many_scans(spark):
    """Rounds scan the blocks: the rows themselves are read for the blocks, and a few for the point amid them."""
    df, _, _ = frame(spark)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    seen = df.select("a", "b", "c", "label", "train", "fold").mapInArrow(count, "a double, b double, c double, label int, train boolean, fold boolean")
    got = L.fit_all(seen, NAMES[:3], [L.Problem("h", "train", "hinge", l2=1e-3), L.Problem("l", "fold", l2=1e-3)])
    assert got["h"].scans > 5 and read.value <= 2 * 600
