"""Model evaluation as relational queries over a score table
``(id, label, score)`` (SURVEY §2.12 EV1-EV11).

Everything is an aggregate: confusion counts are conditional sums, a grid
of thresholds is one pass with one conditional sum per threshold (no cross
join), and curve / AUC computations first collapse the table to one row
per distinct score, then take bucketed prefix sums (``prefix_before``).
Undefined precision/recall/F1 are 0 (scikit-learn's zero_division).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.operators.rowindex import prefix_before

# Fixed values of the reference: threshold grids (as integer hundredths),
# the F1 epsilon and the minimum precision rule.
GRID_KNN = [30, 40, 50, 60, 70]
GRID_GBT = [20, 30, 40, 50, 60, 70, 80]
GRID_SGD = list(range(10, 90, 5))
F1_EPS = 1e-10
MIN_PRECISION = 0.35
DEFAULT_THRESHOLD = 0.5


def _div0(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))


def confusion(scores: DataFrame, threshold: float | Column = DEFAULT_THRESHOLD, label: str = "label",
              score: str = "score") -> DataFrame:
    """EV1: TN, FP, FN, TP of ``score >= threshold``."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score) >= t
    y = F.col(label) == 1
    return scores.agg(
        F.sum((~y & ~pred).cast("long")).alias("tn"), F.sum((~y & pred).cast("long")).alias("fp"),
        F.sum((y & ~pred).cast("long")).alias("fn"), F.sum((y & pred).cast("long")).alias("tp"))


def metrics_from_confusion(c: DataFrame) -> DataFrame:
    """EV2 + EV3 from TN/FP/FN/TP columns."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    return c.withColumns({
        "accuracy": _div0(tp + tn, tp + tn + fp + fn), "precision": p1, "recall": r1, "f1": _f1(p1, r1),
        "f1_macro": (_f1(p1, r1) + _f1(p0, r0)) / F.lit(2.0)})


def point_metrics(scores: DataFrame, threshold: float = DEFAULT_THRESHOLD, **kw) -> DataFrame:
    """EV2/EV3: accuracy, precision, recall, F1, F1-macro at a threshold."""
    return metrics_from_confusion(confusion(scores, threshold, **kw))


def grid_table(scores: DataFrame, grid: Sequence[int] = GRID_SGD, label: str = "label", score: str = "score") -> DataFrame:
    """EV11: metrics at every grid threshold (hundredths) in ONE pass."""
    y = F.col(label) == 1
    aggs = []
    for i, g in enumerate(grid):
        pred = F.col(score) >= F.lit(g / 100.0)
        aggs.append(F.struct(F.lit(g / 100.0).alias("threshold"),
                             F.sum((~y & ~pred).cast("long")).alias("tn"), F.sum((~y & pred).cast("long")).alias("fp"),
                             F.sum((y & ~pred).cast("long")).alias("fn"), F.sum((y & pred).cast("long")).alias("tp")).alias(f"g{i}"))
    row = scores.agg(*aggs)
    long = row.select(F.explode(F.array(*[F.col(f"g{i}") for i in range(len(grid))])).alias("g")).select("g.*")
    return metrics_from_confusion(long)


def grid_by(scores: DataFrame, by: str, grid: Sequence[int] = GRID_SGD, label: str = "label", score: str = "score") -> DataFrame:
    """EV11 for every value of ``by``: metrics at each grid threshold, in one pass."""
    y = F.col(label) == 1

    def at(g: int) -> Column:
        pred = F.col(score) >= F.lit(g / 100.0)
        return F.struct(F.lit(g / 100.0).alias("threshold"),
                        F.sum((~y & ~pred).cast("long")).alias("tn"), F.sum((~y & pred).cast("long")).alias("fp"),
                        F.sum((y & ~pred).cast("long")).alias("fn"), F.sum((y & pred).cast("long")).alias("tp"))

    rows = scores.groupBy(by).agg(F.array(*[at(g) for g in grid]).alias("g"))
    return metrics_from_confusion(rows.select(by, F.explode("g").alias("g")).select(by, "g.*"))


def metrics_by(scores: DataFrame, by: str, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """ROC-AUC, accuracy, precision, recall, F1 and F1-macro for every value of ``by``
    in one plan: equal scores are one row, and their positions are running sums over
    all values of ``by`` in range order, less those of the values before."""
    counts = scores.where(F.col("score").isNotNull()).groupBy(by, "score").agg(
        F.sum((F.col("label") == 1).cast("long")).alias("pos"), F.sum((F.col("label") != 1).cast("long")).alias("neg"))
    ranks = prefix_before(counts, [by, "score"], ["neg"])
    hit = F.col("score") >= F.lit(float(threshold))
    per = ranks.groupBy(by).agg(
        F.sum(F.col("pos").cast("double") * (F.col("neg_before") * 2 + F.col("neg"))).alias("__num"),
        F.min("neg_before").alias("__first"), F.sum("pos").alias("__p"), F.sum("neg").alias("__n"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"), F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"))
    auc = F.try_divide(F.col("__num") - F.lit(2.0) * F.col("__first") * F.col("__p"), F.lit(2.0) * F.col("__p") * F.col("__n"))
    return (metrics_from_confusion(per.withColumn("roc_auc", auc))
            .select(by, "roc_auc", "accuracy", "precision", "recall", "f1", "f1_macro"))


def threshold_grid(scores: DataFrame, grid: Sequence[int] = GRID_SGD, **kw) -> DataFrame:
    """EV7: best F1-macro over the grid; the first (smallest) best wins, and
    the answer stays 0.5 when no threshold has F1-macro > 0."""
    t = grid_table(scores, grid, **kw)
    best = t.agg(F.max_by(F.struct("threshold", "f1_macro"),
                          F.struct(F.col("f1_macro"), (-F.col("threshold")).alias("t"))).alias("b"))
    return best.select(F.when(F.col("b.f1_macro") > 0, F.col("b.threshold")).otherwise(F.lit(DEFAULT_THRESHOLD)).alias("best_threshold"),
                       F.greatest(F.col("b.f1_macro"), F.lit(0.0)).alias("best_f1_macro"))


def score_counts(scores: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score: positives and negatives (map-side combined)."""
    return scores.where(F.col(score).isNotNull()).groupBy(score).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg"))


def _totals(sc: DataFrame) -> Column:
    return sc.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N")).alias("t")).scalar()


def roc_auc(scores: DataFrame, **kw) -> DataFrame:
    """EV4: exact ROC-AUC with ties (each positive counts the negatives below
    it plus half of the tied ones)."""
    sc = score_counts(scores, **kw)
    s = kw.get("score", "score")
    pre = prefix_before(sc, s, ["neg"])
    t = _totals(sc)
    num = pre.agg(F.sum(F.col("pos") * (F.col("neg_before") * 2 + F.col("neg"))).alias("num"))
    # one-class input: AUC undefined -> NULL (no division error)
    return num.select(F.try_divide(F.col("num"), t["P"] * t["N"] * F.lit(2.0)).alias("roc_auc"))


def curve_points(scores: DataFrame, **kw) -> DataFrame:
    """Cumulative counts per distinct threshold: tp / fp = positives /
    negatives with ``score >= threshold``."""
    sc = score_counts(scores, **kw)
    s = kw.get("score", "score")
    pre = prefix_before(sc, s, ["pos", "neg"], descending=True)
    t = _totals(sc)
    return pre.select(F.col(s).alias("threshold"), (F.col("pos_before") + F.col("pos")).alias("tp"),
                      (F.col("neg_before") + F.col("neg")).alias("fp"), t["P"].alias("P"), t["N"].alias("N"))


def roc_points(scores: DataFrame, drop_intermediate: bool = False, **kw) -> DataFrame:
    """EV5: (threshold, fpr, tpr) at every distinct score, highest first.

    ``drop_intermediate=True`` follows scikit-learn's ``roc_curve``: a point
    is kept when the counts at the next lower score differ from its own (the
    curve bends there) and at both ends; the (0, 0) start point is added with
    a NULL threshold (scikit-learn uses +inf).  The neighbour counts come from
    the global position of each distinct score (``global_row_index``) and an
    equi-join on ``position + 1`` -- no one-partition window."""
    c = curve_points(scores, **kw)
    pts = c.select("threshold", _div0(F.col("fp"), F.col("N")).alias("fpr"), _div0(F.col("tp"), F.col("P")).alias("tpr"))
    if not drop_intermediate:
        return pts
    from stopcast.operators.rowindex import global_row_index
    s = kw.get("score", "score")
    sc = score_counts(scores, **kw).withColumn("__neg_s", -F.col(s))
    ix = global_row_index(sc, order=("__neg_s",), idx_col="__i")
    nxt = ix.select((F.col("__i") - 1).alias("__i"), F.col("pos").alias("__npos"), F.col("neg").alias("__nneg"))
    n = ix.agg(F.count(F.lit(1))).scalar()
    j = ix.join(nxt, "__i", "left")
    keep = ((F.col("__i") == 0) | (F.col("__i") == n - 1) | (F.col("__npos") != F.col("pos")) | (F.col("__nneg") != F.col("neg")))
    kept = j.where(keep).select(F.col(s).alias("__t"))
    out = pts.join(kept, pts["threshold"] == kept["__t"], "left_semi")
    start = scores.agg(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(out)


def pr_points(scores: DataFrame, **kw) -> DataFrame:
    """EV6: (threshold, precision, recall) at every distinct score
    (scikit-learn 1.4; its extra (1, 0) end point has no threshold)."""
    c = curve_points(scores, **kw)
    return c.select("threshold", _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("P")).alias("recall"))


def threshold_f1(scores: DataFrame, **kw) -> DataFrame:
    """EV8: threshold maximising 2pr/(p+r+1e-10); ties -> smallest threshold."""
    p = pr_points(scores, **kw).withColumn(
        "f1", F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(F1_EPS)))
    b = p.agg(F.max_by(F.struct("threshold", "f1"), F.struct(F.col("f1"), (-F.col("threshold")).alias("t"))).alias("b"))
    return b.select(F.col("b.threshold").alias("best_threshold"), F.col("b.f1").alias("best_f1"))


def threshold_min_precision(scores: DataFrame, min_precision: float = MIN_PRECISION, **kw) -> DataFrame:
    """EV9: highest recall with precision >= min_precision (ties -> smallest
    threshold); 0.5 when no threshold qualifies."""
    p = pr_points(scores, **kw).where(F.col("precision") >= min_precision)
    b = p.agg(F.max_by(F.struct("threshold", "recall", "precision"),
                       F.struct(F.col("recall"), (-F.col("threshold")).alias("t"))).alias("b"))
    return b.select(F.coalesce(F.col("b.threshold"), F.lit(DEFAULT_THRESHOLD)).alias("best_threshold"),
                    F.col("b.recall").alias("recall"), F.col("b.precision").alias("precision"))


def classification_report(scores: DataFrame, threshold: float = DEFAULT_THRESHOLD, **kw) -> DataFrame:
    """EV10: per class precision / recall / F1 / support, accuracy, macro and
    weighted averages (one aggregate, then a 5-row union)."""
    c = confusion(scores, threshold, **kw)
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    p1, r1, p0, r0 = _div0(tp, tp + fp), _div0(tp, tp + fn), _div0(tn, tn + fn), _div0(tn, tn + fp)
    s1, s0 = tp + fn, tn + fp
    n = s1 + s0
    f1, f0 = _f1(p1, r1), _f1(p0, r0)
    acc = _div0(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.alias("support"))
    rows = [row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
            row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
            row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
            row("weighted avg", _div0(p0 * s0 + p1 * s1, n), _div0(r0 * s0 + r1 * s1, n), _div0(f0 * s0 + f1 * s1, n), n)]
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def confidence(scores: DataFrame, threshold: float = 0.6, score: str = "score") -> DataFrame:
    """PR2: predicted class at ``threshold`` and its confidence p or 1-p."""
    pred = (F.col(score) >= threshold).cast("int")
    return scores.withColumns({"predicao": pred,
                               "confianca": F.when(pred == 1, F.col(score)).otherwise(F.lit(1.0) - F.col(score))})
