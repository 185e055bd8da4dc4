"""Queries for k-NN joins, resampling and fit/transform features
(SURVEY §2.3 JN10/JN11, §2.7 SET1/SET2, §2.9, §2.10, §2.11 VS6, §2.12 MD6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stopcast.operators import knn as K
from stopcast.operators import metrics as M
from stopcast.operators import resample as R
from stopcast.operators import transforms as T
from stopcast.operators.rowindex import holdout_split, time_series_split
from stopcast.queries.q_etl import _me, out
from stopcast.queries.registry import query
from stopcast.queries.sql import MODEL_EVENTS, snap, with_
from stopcast.session import materialize

# ----------------------------------------------------------- embeddings base
EMB = """emb AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, CAST(label = 0 AS INTEGER) AS label FROM embeddings)"""
SPLIT = """ix AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS r, count(*) OVER () AS n FROM emb),
tr AS (SELECT id, vec, label FROM ix WHERE r < floor(0.8 * n)),
te AS (SELECT id, vec, label FROM ix WHERE r >= floor(0.8 * n))"""


def _d(a: str, b: str) -> str:
    return (f"sqrt(list_reduce(list_transform(list_zip({a}, {b}), lambda x: (x[1] - x[2]) * (x[1] - x[2])), "
            f"lambda p, q: p + q))")


def _hk(seed: int, *cols: str) -> str:
    parts = " || ':' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"('0x' || substr(md5('{seed}:' || {parts}), 1, 15))::BIGINT"


def _hu(seed: int, *cols: str) -> str:
    parts = " || ':' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"(('0x' || substr(md5('{seed}:' || {parts}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def emb(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("id"), K.as_vector("embedding").alias("vec"),
                    (F.col("label") == 0).cast("int").alias("label"))


def emb_split(spark, sf):
    s = holdout_split(emb(spark, sf), 0.8, order=("id",))
    return s.where("is_train = 1").drop("is_train", "row_idx"), s.where("is_train = 0").drop("is_train", "row_idx")


KNN_K = 5
_PAIRS = with_(EMB, SPLIT, f"""pairs AS (SELECT te.id AS qid, tr.id AS tid, {_d('te.vec', 'tr.vec')} AS dist, tr.label
    FROM te, tr)""", "rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rank FROM pairs)")


@query("knn_join", _PAIRS + f"\nSELECT qid, tid, {snap('dist')} AS dist, rank FROM rk WHERE rank <= {KNN_K}")
def q_knn_join(spark, sf):
    """JN10: 5 nearest training rows of every test row (exact, by a metric partition)."""
    tr, te = emb_split(spark, sf)
    r = K.knn_join(te, tr, KNN_K)
    return out(r.select("qid", "tid", "dist", F.col("rank").cast("long").alias("rank")))


_KNN_SCORE = """ sc AS (SELECT qid, CASE WHEN sum(CASE WHEN dist = 0 THEN 1 ELSE 0 END) > 0
      THEN sum(CASE WHEN dist = 0 THEN label ELSE 0 END) / sum(CASE WHEN dist = 0 THEN 1 ELSE 0 END)
      ELSE sum(CASE WHEN dist <> 0 THEN label / dist END) / sum(CASE WHEN dist <> 0 THEN 1.0 / dist END) END AS score
  FROM rk WHERE rank <= {k} GROUP BY qid)"""


@query("knn_classify", _PAIRS + "," + _KNN_SCORE.format(k=31) + f"\nSELECT qid, {snap('score')} AS score FROM sc")
def q_knn_classify(spark, sf):
    """MD6: distance-weighted k=31 vote (exact matches only count when present)."""
    tr, te = emb_split(spark, sf)
    n = K.knn_join(te, tr, 31, carry=["label"])
    return out(K.knn_scores(n, 31))


KS = [3, 5, 7, 11, 15, 21, 31]


def _auc_sql(src: str) -> str:
    return (f"(SELECT sum(pos * (2 * nb + neg)) / (sum(pos) * sum(neg) * 2.0) FROM (SELECT *, coalesce(sum(neg) OVER "
            f"(ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM (SELECT score, "
            f"sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg "
            f"FROM {src} GROUP BY score)))")


@query("k_sweep", _PAIRS + ",\n" + ",\n".join(
    _KNN_SCORE.format(k=k).replace(" sc AS", f" sc{k} AS") + f", l{k} AS (SELECT sc{k}.score, te.label FROM sc{k} JOIN te ON sc{k}.qid = te.id)"
    for k in KS) + "\n" + "\nUNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS k, {snap(_auc_sql(f'l{k}'))} AS roc_auc" for k in KS))
def q_k_sweep(spark, sf):
    """VS6: AUC for k in {3,5,7,11,15,21,31} from ONE k=31 neighbour table."""
    tr, te = emb_split(spark, sf)
    n = K.knn_join(te, tr, max(KS), carry=["label"])
    sc = materialize(K.k_sweep_scores(n, KS).join(te.select(F.col("id").alias("qid"), "label"), "qid"))
    parts = [M.roc_auc(sc.where(F.col("k") == k)).select(F.lit(k).cast("long").alias("k"), "roc_auc") for k in KS]
    r = parts[0]
    for p in parts[1:]:
        r = r.unionByName(p)
    return out(r)


_MNN = with_(EMB, f"""p AS (SELECT a.id AS a, b.id AS b, {_d('a.vec', 'b.vec')} AS d FROM emb a, emb b WHERE a.id <> b.id)""",
             "nn AS (SELECT a, b FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS r FROM p) WHERE r = 1)",
             """links AS (SELECT x.a, x.b, ea.label AS label_a, eb.label AS label_b FROM nn x JOIN nn y ON x.a = y.b AND x.b = y.a
               JOIN emb ea ON ea.id = x.a JOIN emb eb ON eb.id = x.b WHERE x.a < x.b AND ea.label <> eb.label)""")


@query("mutual_nn", _MNN + "\nSELECT a, b, label_a, label_b FROM links")
def q_mutual_nn(spark, sf):
    """JN11: Tomek links (mutual nearest neighbours of opposite classes)."""
    return K.mutual_nn(emb(spark, sf), id_col="id", vec="vec", label="label")


@query("tomek_links", _MNN + """
SELECT id, label FROM emb WHERE id NOT IN (SELECT CASE WHEN label_a = 0 THEN a ELSE b END FROM links)""")
def q_tomek_links(spark, sf):
    """RS4: drop the majority member of every Tomek link."""
    return R.tomek_links(emb(spark, sf), label="label", id_col="id", vec="vec").select("id", "label")


_SMOTE = with_(EMB, "mino AS (SELECT id, vec FROM emb WHERE label = 1)",
               "cnt AS (SELECT (SELECT count(*) FROM mino) AS n1, (SELECT count(*) FROM emb WHERE label <> 1) AS n0)",
               "ns AS (SELECT CAST(greatest(CAST(floor(0.5 * n0) AS BIGINT) - n1, 0) AS BIGINT) AS ns, n1 FROM cnt)",
               f"ix AS (SELECT m.*, row_number() OVER (ORDER BY {_hk(42, 'id')}, id) - 1 AS r FROM mino m)",
               """rws AS (SELECT id, vec, unnest(range(1, CAST(ns // n1 + CASE WHEN r < ns % n1 THEN 1 ELSE 0 END AS BIGINT) + 1)) AS copy
                      FROM ix, ns)""",
               f"""nb AS (SELECT * FROM (SELECT a.id, b.vec AS nvec, row_number() OVER (PARTITION BY a.id ORDER BY {_d('a.vec', 'b.vec')}, b.id) AS rank
                      FROM mino a, mino b WHERE a.id <> b.id) WHERE rank <= 5)""",
               "ka AS (SELECT id, max(rank) AS ka FROM nb GROUP BY id)",
               f"pk AS (SELECT rws.*, 1 + {_hk(43, 'rws.id', 'copy')} % ka AS rank FROM rws JOIN ka ON rws.id = ka.id)",
               f"""syn AS (SELECT pk.id, pk.copy, list_transform(list_zip(pk.vec, nb.nvec), lambda x: x[1] + {_hu(44, 'pk.id', 'pk.copy')} * (x[2] - x[1])) AS v
                      FROM pk JOIN nb ON pk.id = nb.id AND pk.rank = nb.rank)""")


@query("smote", _SMOTE + f"""
SELECT 's:' || CAST(id AS VARCHAR) || ':' || CAST(copy AS VARCHAR) AS id, id AS origin, copy,
       {snap('list_reduce(v, lambda p, q: p + q)')} AS v_sum, {snap('v[1]')} AS v_first FROM syn""")
def q_smote(spark, sf):
    """RS3: SMOTE k=5 up to minority/majority = 0.5 (synthetic rows)."""
    s = R.smote(emb(spark, sf), k=5, sampling_strategy=0.5, label="label", id_col="id", vec="vec")
    return out(s.select("id", "origin", "copy", F.aggregate("vec", F.lit(0.0), lambda a, b: a + b).alias("v_sum"),
                        F.col("vec")[0].alias("v_first")))


@query("smote_tomek")
def q_smote_tomek(spark, sf):
    """RS5: SMOTE (0.5) then Tomek cleaning of both link members; class counts."""
    r = R.smote_tomek(emb(spark, sf), k=5, sampling_strategy=0.5, label="label", id_col="id", vec="vec")
    return r.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


_US = with_(MODEL_EVENTS, "pos AS (SELECT * FROM model_events WHERE target = 1)",
            f"neg AS (SELECT *, row_number() OVER (ORDER BY {_hk(42, 'event_id')}, event_id) - 1 AS r FROM model_events WHERE target <> 1)")


@query("undersample_ratio", _US + "\nSELECT event_id, target FROM pos UNION ALL SELECT event_id, target FROM neg "
       "WHERE r < floor(2.0 * (SELECT count(*) FROM pos))")
def q_undersample_ratio(spark, sf):
    """RS1 + SET1: all positives + 2x negatives in hash order, shuffled."""
    return out(R.undersample_ratio(_me(spark, sf), 2.0).select("event_id", "target"))


@query("random_undersampler", _US + "\nSELECT event_id, target FROM pos UNION ALL SELECT event_id, target FROM neg "
       "WHERE r < floor(2.0 * (SELECT count(*) FROM pos))")
def q_random_undersampler(spark, sf):
    """RS2: sampling_strategy 0.5 (minority / majority)."""
    return out(R.random_undersampler(_me(spark, sf), 0.5).select("event_id", "target"))


@query("concat_rows", _US + "\nSELECT target, count(*) AS n FROM (SELECT event_id, target FROM pos UNION ALL "
       "SELECT event_id, target FROM neg WHERE r < floor(2.0 * (SELECT count(*) FROM pos))) GROUP BY target")
def q_concat_rows(spark, sf):
    """SET1: minority stacked with the down-sampled majority (class counts)."""
    r = R.undersample_ratio(_me(spark, sf), 2.0)
    return r.groupBy("target").agg(F.count(F.lit(1)).alias("n")).select(F.col("target").cast("long").alias("target"), "n")


@query("freq_undersample", with_(MODEL_EVENTS, "f AS (SELECT * FROM model_events WHERE user_frequency >= "
                                 "(SELECT quantile_cont(user_frequency, 0.40) FROM model_events))",
                                 "pos AS (SELECT * FROM f WHERE target = 1)",
                                 "neg AS (SELECT *, row_number() OVER (ORDER BY -user_frequency, event_id) - 1 AS r FROM f WHERE target <> 1)")
       + "\nSELECT event_id, target FROM pos UNION ALL SELECT event_id, target FROM neg WHERE r < floor(5.0 * (SELECT count(*) FROM pos))")
def q_freq_undersample(spark, sf):
    """RS6: frequent users (>= Q40), all positives + top-frequency negatives 5:1."""
    return out(R.freq_undersample(_me(spark, sf)).select("event_id", "target"))


@query("concat_columns", with_(MODEL_EVENTS) + f"\nSELECT event_id, {snap('dist_device_stop')} AS dist_device_stop, "
       "CAST(user_frequency AS DOUBLE) AS user_frequency, target FROM model_events")
def q_concat_columns(spark, sf):
    """SET2: X and y stay in one row (no positional re-alignment)."""
    d = _me(spark, sf)
    return out(d.select("event_id", "dist_device_stop", F.col("user_frequency").cast("double").alias("user_frequency"), "target"))


# ------------------------------------------------------------- transforms
_TS = f"""ix AS (SELECT *, row_number() OVER (ORDER BY event_timestamp, event_id) - 1 AS r, count(*) OVER () AS n FROM model_events),
tr AS (SELECT * FROM ix WHERE r < n - n // 4)"""
SCALE = ["dist_device_stop", "user_frequency"]


def _train(spark, sf):
    s = time_series_split(_me(spark, sf), 3)
    return s, s.where("is_train = 1")


@query("label_encode", with_(MODEL_EVENTS, "b AS (SELECT *, hour(event_timestamp) AS hour FROM model_events)") + """
SELECT event_id, CAST(dense_rank() OVER (ORDER BY coalesce(CAST(gtfs_stop_id AS VARCHAR), 'nan')) - 1 AS BIGINT) AS gtfs_stop_id,
       CAST(dense_rank() OVER (ORDER BY coalesce(CAST(hour AS VARCHAR), 'nan')) - 1 AS BIGINT) AS hour FROM b""")
def q_label_encode(spark, sf):
    """FT1: lexicographic codes of the string form ('0','1','10',...)."""
    from stopcast.functions.calendar import date_parts
    d = date_parts(_me(spark, sf), names={"hour": "hour"})
    return out(T.label_encode(d, ["gtfs_stop_id", "hour"]).select("event_id", "gtfs_stop_id", "hour"))


@query("standard_scale", with_(MODEL_EVENTS, _TS) + "\nSELECT event_id, " + ", ".join(
    f"{snap(f'({c} - (SELECT avg({c}) FROM tr)) / coalesce(nullif((SELECT stddev_pop({c}) FROM tr), 0), 1.0)')} AS {c}" for c in SCALE)
       + " FROM model_events")
def q_standard_scale(spark, sf):
    """FT2: z-score with population std fitted on the train part."""
    s, tr = _train(spark, sf)
    return out(T.standard_scale(s, SCALE, fit_on=tr).select("event_id", *SCALE))


@query("minmax_x100", with_(MODEL_EVENTS, _TS) + "\nSELECT event_id, " + ", ".join(
    f"{snap(f'greatest(({c} - (SELECT min({c}) FROM tr)) / (CASE WHEN (SELECT max({c}) - min({c}) FROM tr) = 0 THEN 1.0 ELSE (SELECT max({c}) - min({c}) FROM tr) END), 0.0) * 100.0')} AS {c}"
    for c in SCALE) + " FROM model_events")
def q_minmax_x100(spark, sf):
    """FT3: train range -> [0, 1] x 100, negatives clipped."""
    s, tr = _train(spark, sf)
    return out(T.minmax_x100(s, SCALE, fit_on=tr).select("event_id", *SCALE))


@query("binarize_median", with_(MODEL_EVENTS, _TS) + "\nSELECT event_id, " + ", ".join(
    f"CAST({c} > (SELECT quantile_cont({c}, 0.5) FROM tr) AS BIGINT) AS {c}" for c in SCALE) + " FROM model_events")
def q_binarize_median(spark, sf):
    """FT4: x > train median."""
    s, tr = _train(spark, sf)
    return out(T.binarize_median(s, SCALE, fit_on=tr).select("event_id", *SCALE))


@query("robust_scale", with_(MODEL_EVENTS, _TS) + "\nSELECT event_id, " + ", ".join(
    f"{snap(f'({c} - (SELECT quantile_cont({c}, 0.5) FROM tr)) / (CASE WHEN (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM tr) = 0 THEN 1.0 ELSE (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM tr) END)')} AS {c}"
    for c in SCALE) + " FROM model_events")
def q_robust_scale(spark, sf):
    """FT8: (x - median) / IQR on the train part."""
    s, tr = _train(spark, sf)
    return out(T.robust_scale(s, SCALE, fit_on=tr).select("event_id", *SCALE))


_RATE = with_(MODEL_EVENTS, "r AS (SELECT gtfs_stop_id, avg(target) AS stop_event_rate FROM model_events GROUP BY ALL)",
              "m AS (SELECT e.event_id, r.stop_event_rate AS x FROM model_events e JOIN r ON e.gtfs_stop_id = r.gtfs_stop_id)",
              "ed AS (SELECT list_sort(list_distinct(quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM m)")
_TIER = ("CASE WHEN x IS NULL OR x < e[1] OR x > list_max(e) THEN NULL WHEN x = e[1] THEN 0.0 "
         "ELSE CAST(len(list_filter(e, lambda v: v < x)) - 1 AS DOUBLE) END")


def _rate_frame(spark, sf):
    d = _me(spark, sf)
    r = d.groupBy("gtfs_stop_id").agg(F.avg("target").alias("stop_event_rate"))
    return d.join(r, "gtfs_stop_id")


@query("stop_tier", _RATE + f"\nSELECT event_id, {_TIER} AS stop_tier FROM m, ed")
def q_stop_tier(spark, sf):
    """FT5: qcut(stop_event_rate, 5) tiers (duplicate edges dropped)."""
    return out(T.stop_tier(_rate_frame(spark, sf)).select("event_id", "stop_tier"))


@query("onehot_tier", _RATE + "\nSELECT event_id, " + ", ".join(
    f"CAST(({_TIER}) = {i} AS BIGINT) AS stop_tier_{i}" for i in range(5)) + " FROM m, ed")
def q_onehot_tier(spark, sf):
    """FT7: one 0/1 column per tier."""
    return out(T.onehot_tier(T.stop_tier(_rate_frame(spark, sf))).select("event_id", *[f"stop_tier_{i}" for i in range(5)]))


@query("class_weight_balanced", with_(MODEL_EVENTS, "c AS (SELECT target, count(*) AS n FROM model_events GROUP BY target)") + f"""
SELECT m.event_id, {snap('(SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * c.n)')} AS weight FROM model_events m JOIN c ON m.target = c.target""")
def q_class_weight_balanced(spark, sf):
    """FT10: n / (2 n_c)."""
    return out(T.class_weight_balanced(_me(spark, sf)).select("event_id", "weight"))


@query("scale_pos_weight", with_(MODEL_EVENTS) + f"""
SELECT event_id, {snap("CASE WHEN target = 1 THEN 1.5 * (SELECT count(*) FROM model_events WHERE target = 0) / (SELECT count(*) FROM model_events WHERE target = 1) ELSE 1.0 END")} AS weight FROM model_events""")
def q_scale_pos_weight(spark, sf):
    """FT11: positives weigh 1.5 n0/n1 (cost-sensitive variant)."""
    return out(T.scale_pos_weight(_me(spark, sf), factor=1.5).select("event_id", "weight"))


@query("auto_class_weights", with_(MODEL_EVENTS, "c AS (SELECT target, count(*) AS n FROM model_events GROUP BY target)") + f"""
SELECT m.event_id, {snap('(SELECT max(n) FROM c) / c.n')} AS weight FROM model_events m JOIN c ON m.target = c.target""")
def q_auto_class_weights(spark, sf):
    """FT12: Balanced = max class total / class total."""
    return out(T.auto_class_weights(_me(spark, sf)).select("event_id", "weight"))


@query("custom_class_weight", with_(MODEL_EVENTS) + "\nSELECT event_id, CASE WHEN target = 0 THEN 1.0 WHEN target = 1 THEN 12.0 "
       "ELSE 1.0 END::DOUBLE AS weight FROM model_events")
def q_custom_class_weight(spark, sf):
    """FT13: {0: 1, 1: 12}."""
    return out(T.custom_class_weight(_me(spark, sf)).select("event_id", "weight"))
