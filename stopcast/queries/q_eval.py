"""Queries for evaluation, scoring and monitoring on a score table
(SURVEY §2.12 EV1-EV11, MD10, PR2-PR4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.operators import metrics as M
from stopcast.plans import scoring as S
from stopcast.queries.q_etl import out
from stopcast.queries.registry import query
from stopcast.queries.sql import SCORES, snap, with_
from stopcast.sources.adapters import score_table

W = with_(SCORES)


def _sc(spark, sf):
    return score_table(spark, sf)


def _conf_sql(t: str) -> str:
    return (f"SELECT sum(CASE WHEN label <> 1 AND score < {t} THEN 1 ELSE 0 END) AS tn, "
            f"sum(CASE WHEN label <> 1 AND score >= {t} THEN 1 ELSE 0 END) AS fp, "
            f"sum(CASE WHEN label = 1 AND score < {t} THEN 1 ELSE 0 END) AS fn, "
            f"sum(CASE WHEN label = 1 AND score >= {t} THEN 1 ELSE 0 END) AS tp FROM scores")


def _div0(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


def _f1(p, r):
    return f"(CASE WHEN ({p}) + ({r}) = 0 THEN 0.0 ELSE 2.0 * ({p}) * ({r}) / (({p}) + ({r})) END)"


P1, R1 = _div0("tp", "tp + fp"), _div0("tp", "tp + fn")
P0, R0 = _div0("tn", "tn + fn"), _div0("tn", "tn + fp")


def _metrics_cols() -> str:
    return (f"{snap(_div0('tp + tn', 'tp + tn + fp + fn'))} AS accuracy, {snap(P1)} AS precision, {snap(R1)} AS recall, "
            f"{snap(_f1(P1, R1))} AS f1, {snap('(' + _f1(P1, R1) + ' + ' + _f1(P0, R0) + ') / 2.0')} AS f1_macro")


@query("confusion", W + "\n" + "SELECT CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
       "CAST(tp AS BIGINT) AS tp FROM (" + _conf_sql("0.5") + ")")
def q_confusion(spark, sf):
    """EV1 at 0.5."""
    return M.confusion(_sc(spark, sf), 0.5)


@query("point_metrics", W + f"\nSELECT CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
       f"CAST(tp AS BIGINT) AS tp, {_metrics_cols()} FROM (" + _conf_sql("0.5") + ")")
def q_point_metrics(spark, sf):
    """EV2: accuracy, precision (0 if undefined), recall, F1 (+F1-macro)."""
    return out(M.point_metrics(_sc(spark, sf), 0.5))


@query("f1_macro", W + f"\nSELECT {snap('(' + _f1(P1, R1) + ' + ' + _f1(P0, R0) + ') / 2.0')} AS f1_macro FROM ("
       + _conf_sql("0.3") + ")")
def q_f1_macro(spark, sf):
    """EV3: (F1_0 + F1_1) / 2 at 0.3."""
    return out(M.point_metrics(_sc(spark, sf), 0.3).select("f1_macro"))


_SC = ("sc AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg "
       "FROM scores WHERE score IS NOT NULL GROUP BY score)")


@query("roc_auc", with_(SCORES, _SC, "pre AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING "
                                     "AND 1 PRECEDING), 0) AS nb FROM sc)")
       + f"\nSELECT {snap('sum(pos * (2 * nb + neg)) / (sum(pos) * sum(neg) * 2.0)')} AS roc_auc FROM pre")
def q_roc_auc(spark, sf):
    """EV4: exact AUC with ties (bucketed prefix sums over distinct scores)."""
    return out(M.roc_auc(_sc(spark, sf)))


_CURVE = with_(SCORES, _SC, """cp AS (SELECT score AS threshold,
    sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
    sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc)""")


@query("roc_points", _CURVE + f"\nSELECT {snap('threshold')} AS threshold, {snap(_div0('fp', 'N'))} AS fpr, "
       f"{snap(_div0('tp', 'P'))} AS tpr FROM cp")
def q_roc_points(spark, sf):
    """EV5: (threshold, fpr, tpr) per distinct score."""
    return out(M.roc_points(_sc(spark, sf)))


@query("roc_curve", _CURVE + f""",
k AS (SELECT *, row_number() OVER (ORDER BY threshold DESC) AS i, count(*) OVER () AS cnt,
             lead(tp) OVER (ORDER BY threshold DESC) - tp AS dtp_next, lead(fp) OVER (ORDER BY threshold DESC) - fp AS dfp_next,
             tp - coalesce(lag(tp) OVER (ORDER BY threshold DESC), 0) AS dtp, fp - coalesce(lag(fp) OVER (ORDER BY threshold DESC), 0) AS dfp
      FROM cp)
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT {snap('threshold')}, {snap(_div0('fp', 'N'))}, {snap(_div0('tp', 'P'))} FROM k
WHERE i = 1 OR i = cnt OR dtp_next <> dtp OR dfp_next <> dfp""")
def q_roc_curve(spark, sf):
    """EV5 with scikit-learn's drop_intermediate (collinear points removed,
    (0, 0) start point with a NULL threshold)."""
    return out(M.roc_points(_sc(spark, sf), drop_intermediate=True))


_PR = _CURVE + f""",
pr AS (SELECT threshold, {_div0('tp', 'tp + fp')} AS precision, CASE WHEN P = 0 THEN 1.0 ELSE tp / P END AS recall FROM cp)"""


@query("pr_points", _PR + f"\nSELECT {snap('threshold')} AS threshold, {snap('precision')} AS precision, {snap('recall')} AS recall FROM pr")
def q_pr_points(spark, sf):
    """EV6: (threshold, precision, recall) per distinct score."""
    return out(M.pr_points(_sc(spark, sf)))


@query("threshold_f1", _PR + f"""
, f AS (SELECT threshold, 2.0 * precision * recall / (precision + recall + 1e-10) AS f1 FROM pr)
SELECT {snap('arg_max(threshold, (f1, -threshold))')} AS best_threshold, {snap('max(f1)')} AS best_f1 FROM f""")
def q_threshold_f1(spark, sf):
    """EV8: threshold with the best F1 = 2pr/(p+r+1e-10) over all scores."""
    return out(M.threshold_f1(_sc(spark, sf)))


@query("threshold_min_precision", _PR + f"""
, v AS (SELECT * FROM pr WHERE precision >= 0.35)
SELECT {snap('coalesce((SELECT arg_max(threshold, (recall, -threshold)) FROM v), 0.5)')} AS best_threshold,
       {snap('(SELECT arg_max(recall, (recall, -threshold)) FROM v)')} AS recall,
       {snap('(SELECT arg_max(precision, (recall, -threshold)) FROM v)')} AS precision""")
def q_threshold_min_precision(spark, sf):
    """EV9: best recall with precision >= 0.35, else 0.5."""
    return out(M.threshold_min_precision(_sc(spark, sf)))


def _grid_sql(grid) -> str:
    return _union([f"SELECT {g}/100.0::DOUBLE AS threshold, * FROM (" + _conf_sql(f"{g}/100.0::DOUBLE") + ")" for g in grid])


def _union(parts):
    return "\nUNION ALL ".join(parts)


@query("threshold_table", W + f", g AS ({_grid_sql(M.GRID_SGD)})\nSELECT {snap('threshold')} AS threshold, CAST(tn AS BIGINT) AS tn, "
       f"CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, {_metrics_cols()} FROM g")
def q_threshold_table(spark, sf):
    """EV11: metrics at each threshold of the 0.10-0.85 grid (one pass)."""
    return out(M.grid_table(_sc(spark, sf), M.GRID_SGD))


@query("threshold_grid", W + f", g AS ({_grid_sql(M.GRID_KNN)}), m AS (SELECT threshold, "
       f"({_f1(P1, R1)} + {_f1(P0, R0)}) / 2.0 AS f1m FROM g)\n"
       f"SELECT {snap('CASE WHEN max(f1m) > 0 THEN arg_max(threshold, (f1m, -threshold)) ELSE 0.5 END')} AS best_threshold, "
       f"{snap('greatest(max(f1m), 0.0)')} AS best_f1_macro FROM m")
def q_threshold_grid(spark, sf):
    """EV7: best F1-macro over {.3,.4,.5,.6,.7}; first best wins."""
    return out(M.threshold_grid(_sc(spark, sf), M.GRID_KNN))


def _cr_row(name, p, r, f, s):
    return f"SELECT '{name}' AS class, {snap(p)} AS precision, {snap(r)} AS recall, {snap(f)} AS f1, {snap(s)} AS support FROM c"


@query("classification_report", W + ", c AS (" + _conf_sql("0.5") + ")\n" + _union([
    _cr_row("0", P0, R0, _f1(P0, R0), "CAST(tn + fp AS DOUBLE)"),
    _cr_row("1", P1, R1, _f1(P1, R1), "CAST(tp + fn AS DOUBLE)"),
    _cr_row("accuracy", "NULL", "NULL", _div0("tp + tn", "tp + tn + fp + fn"), "CAST(tp + tn + fp + fn AS DOUBLE)"),
    _cr_row("macro avg", f"({P0} + {P1}) / 2", f"({R0} + {R1}) / 2", f"({_f1(P0, R0)} + {_f1(P1, R1)}) / 2",
            "CAST(tp + tn + fp + fn AS DOUBLE)"),
    _cr_row("weighted avg", _div0(f"{P0} * (tn + fp) + {P1} * (tp + fn)", "tp + tn + fp + fn"),
            _div0(f"{R0} * (tn + fp) + {R1} * (tp + fn)", "tp + tn + fp + fn"),
            _div0(f"{_f1(P0, R0)} * (tn + fp) + {_f1(P1, R1)} * (tp + fn)", "tp + tn + fp + fn"),
            "CAST(tp + tn + fp + fn AS DOUBLE)")]))
def q_classification_report(spark, sf):
    """EV10."""
    return out(M.classification_report(_sc(spark, sf), 0.5))


@query("confidence", W + f"\nSELECT id, CAST(score >= 0.6 AS BIGINT) AS predicao, "
       f"{snap('CASE WHEN score >= 0.6 THEN score ELSE 1.0 - score END')} AS confianca FROM scores")
def q_confidence(spark, sf):
    """PR2: class at 0.6 and confidence."""
    return out(M.confidence(_sc(spark, sf), 0.6).select("id", "predicao", "confianca"))


_VOTE = with_(SCORES) + """, v AS (SELECT id, label, score AS s1, ((id * 104729) % 1000) / 1000.0::DOUBLE AS s2,
    0.5::DOUBLE * score + 0.5::DOUBLE * (((id * 31) % 100) / 100.0::DOUBLE) AS s3 FROM scores)"""


@query("soft_vote", _VOTE + f"\nSELECT id, {snap('(s1 + s2 + s3) / 3.0')} AS mean_vote, "
       f"{snap('(2.0 * s1 + s2 + s3) / 4.0')} AS weighted_vote, {snap('0.6 * s1 + 0.4 * s2')} AS blend FROM v")
def q_soft_vote(spark, sf):
    """MD10: mean of three scores, 2:1:1 weighted vote, 0.6/0.4 blend."""
    s = _sc(spark, sf)
    v = s.select("id", "label", F.col("score").alias("s1"), (((F.col("id") * 104729) % 1000) / F.lit(1000.0)).alias("s2"),
                 (F.lit(0.5) * F.col("score") + F.lit(0.5) * (((F.col("id") * 31) % 100) / F.lit(100.0))).alias("s3"))
    return out(S.soft_vote(v, ["s1", "s2", "s3"], weights=[2, 1, 1], blend=(0.6, 0.4)).select(
        "id", "mean_vote", "weighted_vote", "blend"))


_DRIFT = with_(SCORES) + """, ix AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS r, count(*) OVER () AS n FROM scores),
tr AS (SELECT * FROM ix WHERE r < floor(0.5 * n)), nw AS (SELECT * FROM ix WHERE r >= floor(0.5 * n)),
e AS (SELECT min(score) AS lo, max(score) AS hi FROM tr),
bt AS (SELECT CAST(least(greatest(floor(50.0 * (score - lo) / (CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END)), 0), 49) AS BIGINT) AS bin
       FROM tr, e WHERE score IS NOT NULL),
bn AS (SELECT CAST(least(greatest(floor(50.0 * (score - lo) / (CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END)), 0), 49) AS BIGINT) AS bin
       FROM nw, e WHERE score IS NOT NULL),
ct AS (SELECT bin, count(*) AS n FROM bt GROUP BY bin), cn AS (SELECT bin, count(*) AS n FROM bn GROUP BY bin),
j AS (SELECT coalesce(ct.bin, cn.bin) AS bin, coalesce(ct.n, 0) AS n_train, coalesce(cn.n, 0) AS n_new
      FROM ct FULL OUTER JOIN cn ON ct.bin = cn.bin),
p AS (SELECT *, n_train / sum(n_train) OVER () AS pct_train, n_new / sum(n_new) OVER () AS pct_new FROM j)"""


@query("drift_histogram", _DRIFT + f"""
SELECT bin, n_train, n_new, {snap('pct_train')} AS pct_train, {snap('pct_new')} AS pct_new,
       {snap('(greatest(pct_new, 1e-4) - greatest(pct_train, 1e-4)) * ln(greatest(pct_new, 1e-4) / greatest(pct_train, 1e-4))')} AS psi
FROM p""")
def q_drift_histogram(spark, sf):
    """PR3: train vs new score histogram on shared train edges + PSI terms
    (train = first half of the events in id/time order, new = second half)."""
    from stopcast.operators.rowindex import holdout_split
    s = holdout_split(_sc(spark, sf), 0.5, order=("id",))
    return out(S.drift_histogram(s.where("is_train = 1"), s.where("is_train = 0"), "score"))


@query("retrain_rule", with_(SCORES, _SC, "pre AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED "
                                          "PRECEDING AND 1 PRECEDING), 0) AS nb FROM sc)",
                             "a AS (SELECT sum(pos * (2 * nb + neg)) / (sum(pos) * sum(neg) * 2.0) AS auc FROM pre)",
                             "c AS (" + _conf_sql("0.5") + ")") + f"""
SELECT {snap('a.auc')} AS roc_auc, {snap(_div0('tp + tn', 'tp + tn + fp + fn'))} AS accuracy,
       CAST(a.auc < 0.80 OR {_div0('tp + tn', 'tp + tn + fp + fn')} < 0.85 AS BIGINT) AS retrain
FROM a, c""")
def q_retrain_rule(spark, sf):
    """PR4: retrain when AUC < .80 or accuracy < .85 (drift / age inputs
    optional)."""
    s = _sc(spark, sf)
    return out(S.retrain_rule(M.roc_auc(s), M.point_metrics(s, 0.5)))
