"""Distributed model training and comparison (SURVEY §2.11-2.12: MD1-MD9,
MD11, VS3-VS5, VS7-VS10, EV12, SRT5, SNK2, FT6, FT9).

Models are MLlib estimators inside a ``Pipeline`` (assembler [+ scaler] +
classifier), trained on the leak-free training table.  Scores become a score
table ``(id, label, score)`` that the relational metrics in
``stopcast.operators.metrics`` evaluate.  The driver only loops over
configurations / folds and collects one metrics row per fit.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopcast.operators import metrics as M
from stopcast.operators.transforms import class_weight_balanced
from stopcast.plans import forest as FT
from stopcast.plans import linear as LN

MAX_DEPTH = 30   # MLlib's limit; it stands for the reference's "None" (unbounded)
FOREST_NODES = 8_000_000    # nodes that the trees of one fit may have; a larger forest is fitted in groups of trees
FOREST_PARTS = 4            # partitions of a group's rows, at least: each holds statistics of its own of every node
MANY_ROWS, DEEP_NODES = 100_000, 10_000     # beyond these rows and nodes a tree, at least four groups
OWN_ROWS = 20_000           # beyond these rows trees and forests are grown by ``forest``, a tree a task
PART_ROWS = 1_000_000       # rows of such a partition, at most (about)

# Fixed values of the reference (configurations of the training scripts).
RF_CONFIGS = {
    "BASELINE": dict(numTrees=100, maxDepth=None, minInstancesPerNode=1, balanced=False),
    "BALANCED": dict(numTrees=100, maxDepth=None, minInstancesPerNode=1, balanced=True),
    "DEPTH_CONTROL": dict(numTrees=100, maxDepth=20, minInstancesPerNode=20, balanced=False),
    "LARGE_ENSEMBLE": dict(numTrees=300, maxDepth=None, minInstancesPerNode=1, balanced=False),
    "OPTIMIZED": dict(numTrees=300, maxDepth=25, minInstancesPerNode=10, balanced=True),
}
DT_CONFIGS = {
    "BASELINE": dict(maxDepth=None, minInstancesPerNode=1, balanced=False, sqrt=False),
    "DEPTH_10": dict(maxDepth=10, minInstancesPerNode=1, balanced=False, sqrt=False),
    "MIN_SAMPLES": dict(maxDepth=None, minInstancesPerNode=50, balanced=False, sqrt=False),
    "BALANCED": dict(maxDepth=None, minInstancesPerNode=1, balanced=True, sqrt=False),
    "OPTIMIZED": dict(maxDepth=15, minInstancesPerNode=20, balanced=True, sqrt=True),
}
GBT_CONFIGS = {   # boosted-tree sweep re-aimed on GBTClassifier (iterations, learning rate, depth, subsample, rsm)
    "BASELINE": dict(maxIter=50, stepSize=0.05, maxDepth=12, subsamplingRate=0.85, features=0.85),
    "HIGH_ITERATIONS": dict(maxIter=150, stepSize=0.03, maxDepth=12, subsamplingRate=0.85, features=0.85),
    "DEEP_TREES": dict(maxIter=50, stepSize=0.05, maxDepth=16, subsamplingRate=0.85, features=0.85),
    "HIGH_LEARNING_RATE": dict(maxIter=50, stepSize=0.1, maxDepth=10, subsamplingRate=0.85, features=0.85),
    "MORE_BORDERS": dict(maxIter=50, stepSize=0.05, maxDepth=12, subsamplingRate=0.85, features=0.85, maxBins=254),
    "LESS_REGULARIZATION": dict(maxIter=50, stepSize=0.05, maxDepth=12, subsamplingRate=0.9, features=0.9),
    "MORE_REGULARIZATION": dict(maxIter=50, stepSize=0.05, maxDepth=12, subsamplingRate=0.7, features=0.7),
    # MLlib has no Bayesian bootstrap: every tree sees all rows and features
    "BOOTSTRAP_BAYESIAN": dict(maxIter=50, stepSize=0.05, maxDepth=12, subsamplingRate=1.0, features=1.0),
    "OPTIMAL_COMBO": dict(maxIter=100, stepSize=0.04, maxDepth=14, subsamplingRate=0.8, features=0.8, maxBins=200),
}
SGD_CONFIGS = {
    "BASELINE": dict(alpha=1e-4, l1_ratio=0.0),
    "HIGH_REGULARIZATION": dict(alpha=1e-3, l1_ratio=0.0),
    "LOW_REGULARIZATION": dict(alpha=1e-5, l1_ratio=0.0),
    "ELASTIC_NET": dict(alpha=1e-4, l1_ratio=0.5),
    "L1_PENALTY": dict(alpha=1e-4, l1_ratio=1.0),
}
SVC_C = [0.1, 1.0, 10.0]
COEF_THRESHOLDS = [0.01, 0.02, 0.03, 0.05, 0.07, 0.10]


def _depth(d):
    """MLlib's limit stands for an unbounded depth; a depth beyond it is an error."""
    if d is not None and int(d) > MAX_DEPTH:
        raise ValueError(f"maxDepth {d}: MLlib's trees go to {MAX_DEPTH}")
    return MAX_DEPTH if d is None else int(d)


def random_forest(numTrees=100, maxDepth=None, minInstancesPerNode=1, balanced=False, seed=42, features="sqrt", **_):
    """MD1."""
    rf = RandomForestClassifier(numTrees=numTrees, maxDepth=_depth(maxDepth), minInstancesPerNode=minInstancesPerNode,
                                featureSubsetStrategy=features, impurity="gini", seed=seed, maxBins=64,
                                maxMemoryInMB=1024, cacheNodeIds=True)
    return rf.setWeightCol("weight") if balanced else rf


def decision_tree(maxDepth=None, minInstancesPerNode=1, balanced=False, sqrt=False, seed=42, **_):
    """MD2 (``max_features='sqrt'`` = a one-tree forest without bootstrap)."""
    if sqrt:
        m = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", maxDepth=_depth(maxDepth),
                                   minInstancesPerNode=minInstancesPerNode, seed=seed, maxBins=64, maxMemoryInMB=1024)
    else:
        m = DecisionTreeClassifier(maxDepth=_depth(maxDepth), minInstancesPerNode=minInstancesPerNode, seed=seed, maxBins=64,
                                   maxMemoryInMB=1024)
    return m.setWeightCol("weight") if balanced else m


def gbt(maxIter=50, stepSize=0.05, maxDepth=6, subsamplingRate=1.0, features=1.0, balanced=True, seed=42,
        validation: bool = False, maxBins: int = 128, **_):
    """MD3: boosted trees (early stopping via ``validationIndicatorCol``)."""
    g = GBTClassifier(maxIter=maxIter, stepSize=stepSize, maxDepth=_depth(maxDepth), subsamplingRate=subsamplingRate,
                      featureSubsetStrategy=str(features), seed=seed, maxBins=maxBins, maxMemoryInMB=1024,
                      # down one tree a row finds its node sooner than a table of nodes is written a level
                      cacheNodeIds=False)
    if validation:
        g = g.setValidationIndicatorCol("is_valid")
    return g.setWeightCol("weight") if balanced else g


def logreg_sgd(alpha=1e-4, l1_ratio=0.0, balanced=True, **_):
    """MD4: log-loss linear model, regParam = alpha, elasticNet = l1_ratio."""
    lr = LogisticRegression(regParam=alpha, elasticNetParam=l1_ratio, maxIter=100, standardization=False)
    return lr.setWeightCol("weight") if balanced else lr


def linear_svm(C=1.0, n=10000, balanced=True, **_):
    """MD5: hinge-loss linear SVM, regParam = 1 / (n C)."""
    s = LinearSVC(regParam=1.0 / (n * C), maxIter=100, standardization=False)
    return s.setWeightCol("weight") if balanced else s


def naive_bayes(model_type="gaussian", **_):
    """MD7: Gaussian / multinomial / Bernoulli NB with smoothing 1."""
    return NaiveBayes(modelType=model_type, smoothing=1.0)


def build_pipeline(estimator, features: Sequence[str] | None, scale: bool = False) -> Pipeline:
    """Assembler (+ scaler) + ``estimator``; without ``features`` the rows have the vector already."""
    if features is None:
        return Pipeline(stages=[estimator.setFeaturesCol("features").setLabelCol("label")])
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw_features" if scale else "features",
                              handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    estimator.setFeaturesCol("features").setLabelCol("label")
    return Pipeline(stages=stages + [estimator])


def prepare(df: DataFrame, label: str = "target", balanced: bool = True, fit_on: str | None = None) -> DataFrame:
    """label as double (+ balanced weights, FT10, fitted on the rows where the
    condition ``fit_on`` holds: the training part, so that nothing leaks)."""
    d = df.withColumn("label", F.col(label).cast("double"))
    return class_weight_balanced(d, label="label", out="weight", fit_on=fit_on) if balanced else d


def score_col(model: PipelineModel) -> F.Column:
    last = model.stages[-1]
    if "probability" in [p.name for p in last.params] or hasattr(last, "getProbabilityCol"):
        return vector_to_array(F.col("probability"))[1]
    # a margin (linear SVC) on the scale of a probability: its own cut, 0, becomes 0.5
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array(F.col("rawPrediction"))[1]))


def fit_score(estimator, train: DataFrame, test: DataFrame, features: Sequence[str] | None, *, scale: bool = False,
              id_col: str = "event_id") -> tuple[PipelineModel, DataFrame, float]:
    """Fit on ``train``; score table of ``test`` + training seconds."""
    pipe = build_pipeline(estimator, features, scale)
    t0 = time.time()
    model = pipe.fit(train)
    secs = time.time() - t0
    pred = model.transform(test)
    sc = pred.select(F.col(id_col).alias("id"), F.col("label").cast("int").alias("label"), score_col(model).alias("score"))
    return model, sc, secs


def by_task(estimator, rows: int, features: Sequence[str] | None, train: DataFrame, test: DataFrame | None = None) -> bool:
    """Whether a tree or forest is grown a tree a task: large tables, as long as their bins fit."""
    if not isinstance(estimator, (RandomForestClassifier, DecisionTreeClassifier)) or rows <= OWN_ROWS:
        return False
    width = len(features) if features is not None else len(train.select("features").first()[0])
    return FT.fits(rows + (test.count() if test is not None else 0), width)


def _group_sizes(forest: RandomForestClassifier, rows: int) -> list[int]:
    """Trees of every group, so that a group has at most ``FOREST_NODES`` nodes (or one tree);
    deep forests of large tables have four groups at least, to be fitted side by side."""
    trees, least = forest.getNumTrees(), max(1, forest.getMinInstancesPerNode())
    nodes = max(1, min(2 ** (forest.getMaxDepth() + 1), 2 * rows // least))
    per = max(1, min(trees, FOREST_NODES // nodes))
    if rows > MANY_ROWS and nodes > DEEP_NODES:
        per = min(per, math.ceil(trees / 4))
    return [min(per, trees - a) for a in range(0, trees, per)]


def forest_rows(train: DataFrame, *forests: RandomForestClassifier) -> DataFrame:
    """``train`` in few even partitions, written once, if one of the forests is fitted in
    groups of trees; itself otherwise.  MLlib keeps statistics of every node in every
    partition, so deep trees cost nodes times partitions; groups side by side fill the cores."""
    from stopcast.session import materialize
    n = train.count()
    features = None if "features" in train.columns else train.columns      # at least the features
    if all(len(_group_sizes(f, n)) == 1 or by_task(f, n, features, train) for f in forests):
        return train
    return materialize(train.repartition(max(FOREST_PARTS, math.ceil(n / PART_ROWS))))


def forest_groups(forest: RandomForestClassifier, train: DataFrame, features: Sequence[str] | None, use: Callable[[PipelineModel, int], object],
                  parallel: int = 4) -> list:
    """What ``use`` gives for (model, trees) of every group of a forest's trees.  Trees are
    independent, so the groups together are the forest; the driver and a task hold the
    nodes of a few groups, never all of them.  One group is the forest as it is."""
    sizes = _group_sizes(forest, train.count())

    def run(i: int) -> object:
        part = forest if len(sizes) == 1 else forest.copy({forest.numTrees: sizes[i], forest.seed: forest.getSeed() + 1_000_003 * i,
                                                            forest.maxMemoryInMB: 256})
        return use(build_pipeline(part, features).fit(train), sizes[i])

    with ThreadPoolExecutor(max_workers=parallel) as ex:
        return list(ex.map(run, range(len(sizes))))


def scored(estimator, train: DataFrame, test: DataFrame, features: Sequence[str] | None, *, scale: bool = False,
           id_col: str = "event_id", parallel: int = 4) -> tuple[DataFrame, float]:
    """(scores of ``test``, seconds) as ``fit_score`` gives them, for forests of any size: the
    score is the mean over the trees, so the groups' scores are added up row by row."""
    from stopcast.session import materialize
    n = train.count()
    if by_task(estimator, n, features, train, test):
        t0 = time.time()
        return FT.fit(estimator, train, features, test, id_col)[1], time.time() - t0
    if not isinstance(estimator, RandomForestClassifier) or len(_group_sizes(estimator, n)) == 1:
        return fit_score(estimator, train, test, features, scale=scale, id_col=id_col)[1:]
    t0 = time.time()
    rows = materialize(test.withColumn("__row", F.monotonically_increasing_id()))

    def use(model: PipelineModel, trees: int) -> DataFrame:
        return materialize(model.transform(rows).select("__row", F.col(id_col).alias("id"), F.col("label").cast("int").alias("label"),
                                                        (score_col(model) * F.lit(float(trees))).alias("score")))

    parts = forest_groups(estimator, train, features, use, parallel)
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    total = every.groupBy("__row").agg(F.first("id").alias("id"), F.first("label").alias("label"),
                                       (F.sum("score") / F.lit(float(estimator.getNumTrees()))).alias("score"))
    return materialize(total.drop("__row")), time.time() - t0


def tree_scored(estimator, train: DataFrame, test: DataFrame, features: Sequence[str]) -> tuple[DataFrame, float, int, int]:
    """(scores of ``test``, seconds, nodes, depth) of one tree."""
    if by_task(estimator, train.count(), features, train, test):
        t0 = time.time()
        about, scores = FT.fit(estimator, train, features, test)
        return scores, time.time() - t0, about["nodes"], about["depth"]
    model, scores, secs = fit_score(estimator, train, test, features)
    last = model.stages[-1]
    tree = last.trees[0] if hasattr(last, "trees") else last
    return scores, secs, int(tree.numNodes), int(tree.depth)


def forest_importances(forest: RandomForestClassifier, train: DataFrame, features: Sequence[str]) -> list[float]:
    """MD11 for forests of any size: the mean of the trees' impurity importances (trees
    without a split have none)."""
    def use(model: PipelineModel, trees: int) -> tuple[int, list[float]]:
        last = model.stages[-1]
        return sum(t.numNodes > 1 for t in last.trees), [float(x) for x in last.featureImportances.toArray()]

    if by_task(forest, train.count(), features, train):
        return FT.fit(forest, train, features)[0]["importances"]
    parts = forest_groups(forest, train, features, use)
    if len(parts) == 1:
        return parts[0][1]
    total = [sum(n * v[i] for n, v in parts) for i in range(len(features))]
    return [x / (sum(total) or 1.0) for x in total]


def evaluate(scores: DataFrame, threshold: float = 0.5) -> dict:
    """One metrics row (AUC, accuracy, precision, recall, F1, F1-macro).  The model
    scores the rows once; the metrics read what it gave."""
    from stopcast.session import materialize
    scores = materialize(scores)
    pm = M.point_metrics(scores, threshold).first()
    auc = M.roc_auc(scores).first()["roc_auc"]
    return {"roc_auc": float(auc) if auc is not None else None, **{k: float(pm[k]) for k in
            ("accuracy", "precision", "recall", "f1", "f1_macro")}}


RESULT_SCHEMA = ("config string, model string, roc_auc double, accuracy double, precision double, recall double, "
                 "f1 double, f1_macro double, train_time double")


def config_sweep(spark: SparkSession, train: DataFrame, test: DataFrame, features: Sequence[str], model: str,
                 configs: dict[str, dict], builder: Callable, *, scale: bool = False, parallel: int = 2) -> DataFrame:
    """VS4: fit every named configuration, one metrics row each (fits run
    concurrently from a small driver thread pool; each fit is distributed).  Where forests
    need groups of trees, one forest is fitted at a time, its groups concurrently."""
    forests = [f for f in (builder(**p) for p in configs.values()) if isinstance(f, RandomForestClassifier)]
    if forests and (even := forest_rows(train, *forests)) is not train:
        train, parallel = even, 1

    def run(item):
        name, params = item
        sc, secs = scored(builder(**params), train, test, features, scale=scale)
        return (name, model, *evaluate(sc).values(), secs)
    with ThreadPoolExecutor(max_workers=parallel) as ex:
        rows = list(ex.map(run, configs.items()))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def linear_problem(name: str, subset: str, model: str, params: dict) -> LN.Problem:
    """A configuration of MD4 / MD5 as a problem of the shared-scan trainer."""
    if model == "logreg_sgd":
        alpha, ratio = params["alpha"], params.get("l1_ratio", 0.0)
        return LN.Problem(name, subset, "log", l2=alpha * (1 - ratio), l1=alpha * ratio)
    return LN.Problem(name, subset, params.get("loss", "hinge"), l2=1.0 / (params["n"] * params["C"]))


def linear_models(df: DataFrame, features: Sequence[str], configs: dict[tuple[str, str], dict],
                  train: str = "is_train = 1") -> dict[tuple[str, str], LN.Model]:
    """The models of all ``configs`` ((model, config) -> parameters), from shared scans of ``df``."""
    got = LN.fit_all(df.withColumn("__train", F.expr(train)), features,
                     [linear_problem(f"{m}|{c}", "__train", m, p) for (m, c), p in configs.items()])
    return {(m, c): got[f"{m}|{c}"] for m, c in configs}


def linear_sweep(spark: SparkSession, df: DataFrame, features: Sequence[str], configs: dict[tuple[str, str], dict],
                 train: str = "is_train = 1", test: str = "is_test = 1") -> DataFrame:
    """VS4 for linear families: all ``configs`` ((model, config) -> parameters) from
    shared scans of ``df``, one metrics row each.  ``train_time`` is the time of all
    fits together, which run at once."""
    t0 = time.time()
    models = list(linear_models(df, features, configs, train).values())
    secs = time.time() - t0
    scores = LN.score_all(df.withColumn("__test", F.expr(test)), models, ["__test"] * len(models))
    part = F.split("problem", r"\|", 2)
    return M.metrics_by(scores, "problem").select(part[1].alias("config"), part[0].alias("model"), "roc_auc", "accuracy", "precision", "recall",
                                          "f1", "f1_macro", F.lit(secs).alias("train_time"))


def linear_cross_val(df: DataFrame, features: Sequence[str], configs: dict[tuple[str, str], dict], k: int = 5) -> DataFrame:
    """VS3 for linear families: every fold of every configuration from shared scans:
    (model, config, cv_mean, cv_std) of the ROC-AUC.  Fold i tests block i and trains
    on every earlier row, with class weights and scaling of those rows alone."""
    d = df.withColumns({f"__before{i}": F.col("fold") < i for i in range(k)} | {f"__block{i}": F.col("fold") == i for i in range(k)})
    problems = [linear_problem(f"{m}|{c}|{i}", f"__before{i}", m, p) for (m, c), p in configs.items() for i in range(k)]
    models = LN.fit_all(d, features, problems)
    scores = LN.score_all(d, [models[p.name] for p in problems], [f"__block{p.name.rsplit('|', 1)[1]}" for p in problems])
    part = F.split("problem", r"\|")
    return (M.metrics_by(scores, "problem").groupBy(part[0].alias("model"), part[1].alias("config"))
            .agg(F.avg("roc_auc").alias("cv_mean"), F.stddev_pop("roc_auc").alias("cv_std")))


def platt_all(scores: DataFrame, by: str = "problem", rounds: int = 50) -> dict[str, tuple[float, float]]:
    """Platt's sigmoid 1 / (1 + exp(-(a x + b))) of ``margin`` for every ``by``, all at
    once: a Newton round is one aggregate with one row a ``by``."""
    spark = scores.sparkSession
    at = {r[by]: (0.0, 0.0) for r in scores.select(by).distinct().collect()}
    live = set(at)
    y, x = (F.col("label") == 1).cast("double"), F.col("margin")
    for _ in range(rounds):
        if not live:
            break
        now = F.broadcast(spark.createDataFrame([(k, *at[k]) for k in sorted(live)], f"{by} string, __a double, __b double"))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("__a") * x + F.col("__b"))))
        got = (scores.join(now, by).withColumn("__p", p).withColumn("__h", F.col("__p") * (F.lit(1.0) - F.col("__p")))
               .groupBy(by).agg(F.sum((F.col("__p") - y) * x).alias("ga"), F.sum(F.col("__p") - y).alias("gb"),
                                F.sum(F.col("__h") * x * x).alias("haa"), F.sum(F.col("__h") * x).alias("hab"),
                                F.sum("__h").alias("hbb"), F.count("*").alias("n")).collect())
        for r in got:
            # a small ridge keeps separable margins finite
            haa, hab, hbb = r["haa"] + 1e-6 * r["n"], r["hab"], r["hbb"] + 1e-6 * r["n"]
            ga, gb = r["ga"] + 1e-6 * r["n"] * at[r[by]][0], r["gb"] + 1e-6 * r["n"] * at[r[by]][1]
            det = haa * hbb - hab * hab
            da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
            size = max(abs(da), abs(db))
            shrink = min(1.0, 4.0 / size) if size else 1.0
            at[r[by]] = (at[r[by]][0] - shrink * da, at[r[by]][1] - shrink * db)
            if size < 1e-9:
                live.discard(r[by])
    return at


def calibrated_sweep(spark: SparkSession, df: DataFrame, features: Sequence[str], configs: dict[tuple[str, str], dict], k: int = 3,
                     train: str = "is_train = 1", test: str = "is_test = 1", id_col: str = "event_id", seed: int = 42) -> DataFrame:
    """MD9 in the sweep: every linear configuration with Platt scaling over ``k`` hash
    folds, the mean of the calibrated pairs.  All fits of all folds share the scans."""
    from stopcast.operators.resample import hash_key
    fold = F.pmod(hash_key(seed, id_col), F.lit(k))
    d = df.withColumns({"__train": F.expr(train), "__test": F.expr(test)})
    d = d.withColumns({f"__fit{i}": F.col("__train") & (fold != i) for i in range(k)}
                      | {f"__held{i}": F.col("__train") & (fold == i) for i in range(k)})
    t0 = time.time()
    problems = [linear_problem(f"{m}|{c}|{i}", f"__fit{i}", m, p) for (m, c), p in configs.items() for i in range(k)]
    models = LN.fit_all(d, features, problems)
    order = [models[p.name] for p in problems]
    sigmoids = LN.platt_models(d, order, [f"__held{p.name.rsplit('|', 1)[1]}" for p in problems])
    secs = time.time() - t0
    tested = LN.score_calibrated(d, order, sigmoids, [p.name.rsplit("|", 1)[0] for p in problems], "__test", id_col=id_col)
    mean = tested.groupBy("problem", "id").agg(F.max("label").alias("label"), F.avg("score").alias("score"))    # rows of one id are one
    part = F.split("problem", r"\|", 2)
    return M.metrics_by(mean, "problem").select(part[1].alias("config"), part[0].alias("model"), "roc_auc", "accuracy", "precision",
                                                "recall", "f1", "f1_macro", F.lit(secs).alias("train_time"))


def leaderboard(results: DataFrame, by: str = "roc_auc") -> DataFrame:
    """SRT5: rank result rows (1 = best)."""
    from pyspark.sql import Window
    return results.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(by), "config")))


def impact_vs_baseline(results: DataFrame, baseline: str = "BASELINE", by: str = "roc_auc") -> DataFrame:
    """VS9: difference and % change of ``by`` of every configuration against the
    baseline's row of a results table (scalar subquery, no cross join)."""
    base = results.where(F.col("config") == baseline).agg(F.max(by)).scalar()
    short = by.split("_")[-1]
    return results.select("config", by, (F.col(by) - base).alias(f"delta_{short}"),
                          F.try_divide(F.lit(100.0) * (F.col(by) - base), base).alias("delta_pct"))


def nb_statistics(df: DataFrame, features: Sequence[str], label: str = "target") -> DataFrame:
    """MD7: sufficient statistics of Gaussian naive Bayes, (label, feature, n, mean,
    variance), one row a class and feature from one aggregate."""
    row = (df.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("long").alias("label"))
           .agg(F.count(F.lit(1)).alias("n"), *[x for i, c in enumerate(features) for x in (
               F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.var_pop(F.col(c).cast("double")).alias(f"v{i}"))]))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"v{i}").alias("variance"))
                      for i, c in enumerate(features)])
    return row.select("label", "n", F.explode(cells).alias("c")).select("label", "c.feature", "n", "c.mean", "c.variance")


def gaussian_nb_scores(train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "target", id_col: str = "event_id",
                       smoothing: float = 1e-9) -> DataFrame:
    """MD7: probability of class 1 by Gaussian naive Bayes, (id, score), from the
    statistics of ``train`` as one scalar row: no model object, no UDF.  Variances get
    ``smoothing`` times the largest variance of a feature over all rows."""
    x = {c: F.col(c).cast("double") for c in features}
    one, zero = F.col(label) == 1, F.col(label) != 1
    st = train.agg(F.struct(
        F.sum(one.cast("long")).alias("n1"), F.sum(zero.cast("long")).alias("n0"),
        (F.lit(smoothing) * F.greatest(*[F.var_pop(v) for v in x.values()], F.lit(0.0))).alias("eps"),
        *[e for i, v in enumerate(x.values()) for k, c in ((1, one), (0, zero)) for e in (
            F.avg(F.when(c, v)).alias(f"m{k}_{i}"), F.var_pop(F.when(c, v)).alias(f"v{k}_{i}"))]).alias("s")).scalar()

    def likely(k: int) -> F.Column:
        total = F.log(st[f"n{k}"])
        for i, v in enumerate(x.values()):
            var = st[f"v{k}_{i}"] + st["eps"]
            total = total - F.lit(0.5) * F.log(F.lit(2 * math.pi) * var) - (v - st[f"m{k}_{i}"]) * (v - st[f"m{k}_{i}"]) / (F.lit(2.0) * var)
        return total

    return test.select(F.col(id_col).alias("id"), (F.lit(1.0) / (F.lit(1.0) + F.exp(likely(0) - likely(1)))).alias("score"))


def cross_val_auc(spark: SparkSession, df: DataFrame, builder: Callable, params: dict, features: Sequence[str], k: int = 5,
                  *, scale: bool = False, metric: str = "roc_auc") -> dict:
    """VS3: expanding-window CV: fold i tests block i and trains on every
    earlier row (``fold`` from ``time_series_split``)."""
    vals = []
    for i in range(k):
        tr = df.where(F.col("fold") < i)
        te = df.where(F.col("fold") == i)
        _, sc, _ = fit_score(builder(**params), tr, te, features, scale=scale)
        vals.append(evaluate(sc)[metric])
    m = sum(vals) / len(vals)
    sd = math.sqrt(sum((v - m) ** 2 for v in vals) / len(vals))
    return {"cv_mean": m, "cv_std": sd, "folds": vals}


def random_search(spark: SparkSession, df: DataFrame, families: dict[str, tuple[Callable, dict[str, list]]], features: Sequence[str],
                  n_iter: int = 10, k: int = 3, seed: int = 42, metric: str = "f1",
                  resample: Callable[[DataFrame], DataFrame] | None = None, parallel: int = 4) -> DataFrame:
    """VS5: for every family (name -> builder, grid) ``n_iter`` points of its grid chosen
    by a seeded hash, each scored by expanding k-fold CV (positive-class F1).

    ``resample`` balances a fold's training rows, given as (id, vec, label), and only
    those; it runs once a fold, its result serves every point.  Fits run from a small
    pool of driver threads, forests that need groups of trees before them one at a time,
    their groups side by side; all folds and points are evaluated in one plan."""
    import hashlib
    import itertools

    from pyspark.ml.functions import array_to_vector

    from stopcast.session import materialize
    vec = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    flat = materialize(df.select(F.col("event_id").alias("id"), "fold", vec.alias("vec"), F.col("label").cast("int").alias("label")))

    def ready(d: DataFrame) -> DataFrame:
        return class_weight_balanced(d.withColumns({"features": array_to_vector("vec"), "label": F.col("label").cast("double")}),
                                     label="label", out="weight")

    folds = []
    for i in range(k):
        before = flat.where(F.col("fold") < i).drop("fold")
        folds.append((materialize(ready(resample(before) if resample else before)),
                      materialize(flat.where(F.col("fold") == i).withColumn("features", array_to_vector("vec")))))
    jobs = []
    for name, (builder, grid) in families.items():
        keys = sorted(grid)
        points = [dict(zip(keys, vals)) for vals in itertools.product(*[grid[x] for x in keys])]
        points.sort(key=lambda p: hashlib.md5(f"{seed}:{sorted(p.items(), key=str)}".encode()).hexdigest())
        jobs += [(name, builder, p, i) for p in points[:n_iter] for i in range(k)]

    grown = [f for f in (b(**p) for _, b, p, _ in jobs) if isinstance(f, RandomForestClassifier)]
    even = [forest_rows(train, *grown) if grown else train for train, _ in folds]
    rows = [train.count() for train, _ in folds]

    def run(job) -> DataFrame:
        name, builder, p, i = job
        train = even[i] if large(job) else folds[i][0]
        sc, _ = scored(builder(**p), train, folds[i][1], None, id_col="id", parallel=parallel)
        return materialize(sc.select(F.lit(f"{name}|{sorted(p.items(), key=str)}|{i}").alias("problem"), "label", "score"))

    def large(job) -> bool:
        model = job[1](**job[2])
        return isinstance(model, RandomForestClassifier) and (len(_group_sizes(model, rows[job[3]])) > 1 or rows[job[3]] > OWN_ROWS)

    parts = [run(j) for j in jobs if large(j)]
    with ThreadPoolExecutor(max_workers=parallel) as ex:
        parts += ex.map(run, [j for j in jobs if not large(j)])
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    part = F.split("problem", r"\|")
    return (M.metrics_by(every, "problem").groupBy(part[0].alias("model"), part[1].alias("params"))
            .agg(F.avg(metric).alias("cv_mean"), F.stddev_pop(metric).alias("cv_std")))


def coefficients(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    last = model.stages[-1]
    return list(zip(features, [float(c) for c in last.coefficients.toArray()]))


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """MD11: impurity importances (trees) or |coefficients| (linear), sorted."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = [float(x) for x in last.featureImportances.toArray()]
    else:
        vals = [abs(float(x)) for x in last.coefficients.toArray()]
    df = spark.createDataFrame(list(zip(features, vals)), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def coef_select(spark: SparkSession, train: DataFrame, test: DataFrame, features: Sequence[str],
                thresholds: Sequence[float] = COEF_THRESHOLDS, alpha: float = 1e-3) -> tuple[DataFrame, list[str]]:
    """VS7: drop features with |coef| < t, retrain; returns the per-threshold
    results and the best (highest AUC) feature list.  All thresholds' fits share the
    scans; ``train_time`` is the time of all of them."""
    d = (train.withColumns({"__train": F.lit(True), "__test": F.lit(False)})
         .unionByName(test.withColumns({"__train": F.lit(False), "__test": F.lit(True)})))
    base = LN.fit_all(d, features, [linear_problem("base", "__train", "logreg_sgd", dict(alpha=alpha))])["base"]
    coefs = list(zip(features, [float(c) for c in base.coef]))
    keeps = {str(t): [f for f, c in coefs if abs(c) >= t] or [max(coefs, key=lambda fc: abs(fc[1]))[0]] for t in thresholds}
    t0 = time.time()
    models = list(LN.fit_all(d, features, [replace(linear_problem(t, "__train", "logreg_sgd", dict(alpha=alpha)), features=tuple(keep))
                                           for t, keep in keeps.items()]).values())
    secs = time.time() - t0
    got = {r["problem"]: r for r in M.metrics_by(LN.score_all(d, models, ["__test"] * len(models)), "problem").collect()}
    rows, best = [], (-1.0, list(features))
    for t in thresholds:
        keep, ev = keeps[str(t)], got[str(t)]
        rows.append((t, len(keep), ev["roc_auc"], ev["f1_macro"], secs))
        if ev["roc_auc"] is not None and ev["roc_auc"] > best[0]:
            best = (ev["roc_auc"], keep)
    res = spark.createDataFrame(rows, "threshold double, n_features long, roc_auc double, f1_macro double, train_time double")
    return res, best[1]


def rfe(train: DataFrame, features: Sequence[str], target_n: int = 15, alpha: float = 1e-3) -> list[str]:
    """VS10: recursive elimination (drop the smallest |coef| until n left)."""
    cur, d = list(features), train.withColumn("__train", F.lit(True))
    while len(cur) > target_n:
        m = LN.fit_all(d, cur, [linear_problem("rfe", "__train", "logreg_sgd", dict(alpha=alpha))])["rfe"]
        c = list(zip(cur, [float(x) for x in m.coef]))
        drop = min(c, key=lambda fc: (abs(fc[1]), fc[0]))[0]
        cur.remove(drop)
    return cur


def gain_select(spark: SparkSession, train: DataFrame, features: Sequence[str], top: int = 50, iters: int = 50) -> DataFrame:
    """VS8: importances of a 50-round boosted model, top n features."""
    m, _, _ = fit_score(gbt(maxIter=iters, stepSize=0.1, maxDepth=6), train, train.limit(1), features)
    return feature_importance(spark, m, features).limit(top)


def _joined(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """(id, label, one column a name) of several score tables over the same rows: one
    aggregate, however many there are."""
    every = None
    for name, sc in parts:
        one = sc.select("id", "label", F.lit(name).alias("__m"), "score")
        every = one if every is None else every.unionByName(one)
    names = list(dict.fromkeys(n for n, _ in parts))
    return every.groupBy("id").agg(F.max("label").alias("label"), *[F.max(F.when(F.col("__m") == n, F.col("score"))).alias(n) for n in names])


def _base_scores(spark: SparkSession, jobs: list[tuple[str, Callable, DataFrame, DataFrame]], features: Sequence[str],
                 scale: set[str], id_col: str, parallel: int) -> list[tuple[str, DataFrame]]:
    """Scores of (name, builder, train, test) fits, from a small pool of driver threads."""
    def run(job) -> tuple[str, DataFrame]:
        name, build, tr, te = job
        return name, scored(build(), tr, te, features, scale=name in scale, id_col=id_col, parallel=1)[0]
    with ThreadPoolExecutor(max_workers=parallel) as ex:
        return list(ex.map(run, jobs))


def oof_scores(df: DataFrame, builders: dict[str, Callable[[], object]], features: Sequence[str], k: int = 5,
               seed: int = 42, id_col: str = "event_id", scale: set[str] = frozenset(), parallel: int = 4) -> DataFrame:
    """Out-of-fold probabilities of each base model (hash folds): one column
    per base, one row per training row."""
    from stopcast.operators.resample import hash_key
    d = df.withColumn("__fold", F.pmod(hash_key(seed, id_col), F.lit(k)))
    jobs = [(name, b, d.where(F.col("__fold") != f), d.where(F.col("__fold") == f)) for f in range(k) for name, b in builders.items()]
    return _joined(_base_scores(df.sparkSession, jobs, features, scale, id_col, parallel))


def stacking(spark: SparkSession, train: DataFrame, test: DataFrame, features: Sequence[str],
             builders: dict[str, Callable[[], object]], k: int = 5, scale: set[str] = frozenset(),
             id_col: str = "event_id", meta: Callable[[], object] | None = None, parallel: int = 4) -> tuple[DataFrame, float]:
    """MD8: bases -> k-fold out-of-fold probabilities -> meta model (logistic
    regression, or what ``meta`` builds); bases refit on all training rows score the
    test rows."""
    meta_in = list(builders)
    oof = oof_scores(train, builders, features, k, id_col=id_col, scale=scale, parallel=parallel)
    last = (meta() if meta else LogisticRegression(maxIter=100)).setFeaturesCol("features").setLabelCol("label")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=meta_in, outputCol="features"), last]).fit(
        oof.withColumn("label", F.col("label").cast("double")))
    cols = _joined(_base_scores(spark, [(n, b, train, test) for n, b in builders.items()], features, scale, id_col, parallel))
    pred = fitted.transform(cols).select("id", "label", vector_to_array("probability")[1].alias("score"))
    return pred, evaluate(pred)["roc_auc"]


def calibrate_sigmoid(spark: SparkSession, train: DataFrame, test: DataFrame, features: Sequence[str],
                      builder: Callable[[], object], k: int = 5, scale: bool = True, id_col: str = "event_id",
                      seed: int = 42) -> DataFrame:
    """MD9: Platt scaling with k folds: per fold, fit the base on the other
    folds and a one-feature logistic regression on the held-out scores;
    the calibrated probability is the mean over the k (base, sigmoid) pairs."""
    from stopcast.operators.resample import hash_key
    d = train.withColumn("__fold", F.pmod(hash_key(seed, id_col), F.lit(k)))
    outs = None
    for f in range(k):
        tr, ho = d.where(F.col("__fold") != f), d.where(F.col("__fold") == f)
        m, sc_ho, _ = fit_score(builder(), tr, ho, features, scale=scale, id_col=id_col)
        platt = Pipeline(stages=[VectorAssembler(inputCols=["score"], outputCol="features"),
                                 LogisticRegression(maxIter=100, regParam=0.0)]).fit(sc_ho)
        sc_te = m.transform(test).select(F.col(id_col).alias("id"), F.col("label").cast("int").alias("label"),
                                         score_col(m).alias("score"))
        p = platt.transform(sc_te).select("id", "label", vector_to_array("probability")[1].alias(f"p{f}"))
        outs = p if outs is None else outs.join(p.drop("label"), "id")
    return outs.select("id", "label", (sum(F.col(f"p{f}") for f in range(k)) / F.lit(float(k))).alias("score"))


def geo_cluster(df: DataFrame, k: int = 8, lat: str = "device_lat", lon: str = "device_lon", seed: int = 42,
                fit_fraction: float | None = None, out: str = "geo_cluster") -> DataFrame:
    """FT6: K-means (k=8) on valid coordinates, -1 for rows without them.
    ``fit_fraction`` fits on a hash sample (the reference fits on <= 10k)."""
    from stopcast.operators.cleaning import coords_valid_pred
    from stopcast.sources.sampling import hash_sample
    va = VectorAssembler(inputCols=[lat, lon], outputCol="__xy")
    valid = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    fit_on = valid.where(coords_valid_pred(lat, lon))
    if fit_fraction:
        fit_on = hash_sample(fit_on, fit_fraction, seed)
    km = KMeans(k=k, seed=seed, featuresCol="__xy", predictionCol=out).fit(va.transform(fit_on))
    scored = km.transform(va.transform(valid)).drop("__xy").withColumn(out, F.col(out).cast("int"))
    rest = df.where(~(F.col(lat).isNotNull() & F.col(lon).isNotNull())).withColumn(out, F.lit(-1))
    return scored.unionByName(rest)


def pca_geo(df: DataFrame, cols: Sequence[str] = ("device_lat", "device_lon", "stop_lat_event", "stop_lon_event"),
            k: int = 2) -> DataFrame:
    """FT9: first k principal components of the coordinate columns."""
    d = df.na.fill(0.0, subset=list(cols))
    va = VectorAssembler(inputCols=list(cols), outputCol="__c")
    p = PCA(k=k, inputCol="__c", outputCol="__pc").fit(va.transform(d))
    r = p.transform(va.transform(d)).withColumn("__a", vector_to_array("__pc"))
    return r.withColumns({f"geo_pc{i + 1}": F.col("__a")[i] for i in range(k)}).drop("__c", "__pc", "__a")
