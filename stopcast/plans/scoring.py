"""Scoring and monitoring (PR1-PR4, MD10).

Batch scoring loads a fitted ``PipelineModel`` (its encoder, ``plans.encoder``, is
a stage of it and saved with it) and applies it to raw rows; monitoring compares score or
feature distributions on shared histogram edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference: alert thresholds and scoring threshold.
AUC_MIN = 0.80
ACCURACY_MIN = 0.85
MAX_AGE_DAYS = 60
PSI_MAX = 0.2
SCORE_THRESHOLD = 0.6
PSI_EPS = 1e-4


def soft_vote(df: DataFrame, cols: Sequence[str], weights: Sequence[float] | None = None,
              blend: tuple[float, float] | None = None) -> DataFrame:
    """MD10: mean of the probability columns, weighted vote, 2-model blend."""
    out = {"mean_vote": sum((F.col(c) for c in cols), F.lit(0.0)) / F.lit(float(len(cols)))}
    if weights:
        out["weighted_vote"] = sum((F.lit(float(w)) * F.col(c) for w, c in zip(weights, cols)), F.lit(0.0)) / F.lit(float(sum(weights)))
    if blend:
        out["blend"] = F.lit(blend[0]) * F.col(cols[0]) + F.lit(blend[1]) * F.col(cols[1])
    return df.withColumns(out)


def _bins(c: str, lo: Column, hi: Column, bins: int) -> Column:
    w = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
    return F.least(F.greatest(F.floor(F.lit(float(bins)) * (F.col(c) - lo) / w), F.lit(0)), F.lit(bins - 1)).cast("long")


def drift_histogram(train: DataFrame, new: DataFrame, c: str, bins: int = 50) -> DataFrame:
    """PR3: histograms of ``c`` on the train edges (new values clipped to
    the edge bins), shares and population-stability terms per bin."""
    mm = train.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias("s")).scalar()
    ct = train.where(F.col(c).isNotNull()).groupBy(_bins(c, mm["lo"], mm["hi"], bins).alias("bin")).agg(F.count(F.lit(1)).alias("n_train"))
    cn = new.where(F.col(c).isNotNull()).groupBy(_bins(c, mm["lo"], mm["hi"], bins).alias("bin")).agg(F.count(F.lit(1)).alias("n_new"))
    j = ct.join(cn, on="bin", how="full").na.fill({"n_train": 0, "n_new": 0})   # <= bins rows each
    tot = j.agg(F.struct(F.sum("n_train").alias("t"), F.sum("n_new").alias("n")).alias("s")).scalar()
    p = j.withColumns({"pct_train": F.col("n_train") / tot["t"], "pct_new": F.col("n_new") / tot["n"]})
    a, b = F.greatest(F.col("pct_new"), F.lit(PSI_EPS)), F.greatest(F.col("pct_train"), F.lit(PSI_EPS))
    return p.withColumn("psi", (a - b) * F.log(a / b))


def retrain_rule(auc: DataFrame, metrics: DataFrame, psi: Column | None = None, age_days: Column | None = None) -> DataFrame:
    """PR4: retrain when AUC < .80, accuracy < .85, PSI > .2 or model older
    than 2 months.  ``auc`` has ``roc_auc``; ``metrics`` has ``accuracy``
    (both one-row tables, read as scalar subqueries)."""
    a = auc.select("roc_auc").scalar()
    acc = metrics.select("accuracy").scalar()
    cond = (a < AUC_MIN) | (acc < ACCURACY_MIN)
    if psi is not None:
        cond = cond | (psi > PSI_MAX)
    if age_days is not None:
        cond = cond | (age_days > MAX_AGE_DAYS)
    return auc.select(a.alias("roc_auc"), acc.alias("accuracy"), cond.cast("long").alias("retrain"))


def batch_score(model_path: str, df: DataFrame, threshold: float = SCORE_THRESHOLD,
                prob_col: str = "probability") -> DataFrame:
    """PR1: load a saved PipelineModel, score, class at ``threshold`` and
    confidence (PR2).  Output columns follow the reference: probabilidade,
    predicao, confianca."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    m = PipelineModel.load(model_path)
    s = m.transform(df).withColumn("probabilidade", vector_to_array(prob_col)[1])
    pred = (F.col("probabilidade") >= threshold).cast("int")
    return s.withColumns({"predicao": pred, "confianca": F.when(pred == 1, F.col("probabilidade"))
                          .otherwise(F.lit(1.0) - F.col("probabilidade"))})
