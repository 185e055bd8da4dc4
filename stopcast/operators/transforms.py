"""Fit/transform feature operators.

Fitted statistics are small aggregates computed on the *train* rows and
applied to any rows; they are joined or passed as scalar subqueries, never
collected to the driver in the hot path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.semantics import col

NULL_TOKEN = "nan"


def fit_stats(src: DataFrame, aggs: dict[str, Column]) -> Column:
    """All fitted statistics in ONE aggregate pass, returned as a single
    struct-valued scalar subquery (fields are read with ``s[name]``)."""
    return src.agg(F.struct(*[e.alias(n) for n, e in aggs.items()]).alias("s")).scalar()


def label_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FT1 fit: (name, __v, __code) with code = rank of the *string* form in
    lexicographic order (hours become '0','1','10',...); NULL -> 'nan'.

    The distinct (column, value) pairs of all columns are ranked together in
    range order (``rowindex``), so a column of many values (users) is no
    single task's sort; a column's first rank is subtracted."""
    from stopcast.operators.rowindex import global_row_index
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)).alias("__v"))
                      for c in cols])
    ranked = global_row_index(df.select(F.explode(pairs).alias("p")).select("p.*").distinct(), order=("name", "__v"), idx_col="__i")
    first = F.broadcast(ranked.groupBy("name").agg(F.min("__i").alias("__first")))      # a row a column
    return ranked.join(first, "name").select("name", "__v", (F.col("__i") - F.col("__first")).cast("int").alias("__code"))


def label_encode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """FT1: replace each column by its lexicographic code (unseen -> NULL)."""
    out = df
    codes = label_codes(fit_on if fit_on is not None else df, cols)
    for c in cols:
        v = F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN))
        out = (out.withColumn("__v", v).join(codes.where(F.col("name") == c).drop("name"), on="__v", how="left")
                  .withColumn(c, F.col("__code")).drop("__v", "__code"))
    return out


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """FT2: (x - mean) / std_pop fitted on ``fit_on`` (std 0 -> 1), like
    scikit-learn's StandardScaler (MLlib's uses the sample std)."""
    src = fit_on if fit_on is not None else df
    st = fit_stats(src, {**{f"m{i}": F.avg(c) for i, c in enumerate(cols)},
                         **{f"s{i}": F.stddev_pop(c) for i, c in enumerate(cols)}})
    out = {}
    for i, c in enumerate(cols):
        m, s = st[f"m{i}"], st[f"s{i}"]
        sd = F.when((s.isNull()) | (s == 0), F.lit(1.0)).otherwise(s)
        out[c + suffix] = (F.col(c) - m) / sd
    return df.withColumns(out)


def minmax_x100(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """FT3: scale to [0, 1] on the train range, x100, clip negatives to 0
    (multinomial NB needs non-negative counts)."""
    src = fit_on if fit_on is not None else df
    st = fit_stats(src, {**{f"lo{i}": F.min(c) for i, c in enumerate(cols)},
                         **{f"hi{i}": F.max(c) for i, c in enumerate(cols)}})
    out = {}
    for i, c in enumerate(cols):
        lo, hi = st[f"lo{i}"], st[f"hi{i}"]
        rng = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)
        out[c] = F.greatest((F.col(c) - lo) / rng, F.lit(0.0)) * F.lit(100.0)
    return df.withColumns(out)


def binarize_median(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """FT4: x > train median -> 1 else 0."""
    from stopcast.operators.quantiles import many_quantiles
    medians = many_quantiles(fit_on if fit_on is not None else df, {c: c for c in cols}, [0.5])
    return df.withColumns({c: (F.col(c) > medians[c][0]).cast("int") for c in cols})


def robust_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """FT8: (x - median) / IQR (IQR 0 -> 1)."""
    from stopcast.operators.quantiles import many_quantiles
    quartiles = many_quantiles(fit_on if fit_on is not None else df, {c: c for c in cols}, [0.25, 0.5, 0.75])
    out = {}
    for c in cols:
        qs = quartiles[c]
        iqr = qs[2] - qs[0]
        out[c] = (F.col(c) - qs[1]) / F.when(iqr == 0, F.lit(1.0)).otherwise(iqr)
    return df.withColumns(out)


def qcut_edges(df: DataFrame, c: str, q: int = 5) -> Column:
    """Interpolated quantile edges 0, 1/q, ..., 1 of ``c`` (scalar array)."""
    from stopcast.operators.quantiles import quantiles
    return quantiles(df, c, [i / q for i in range(q + 1)])


def qcut_expr(x: str | Column, edges: Column, q: int = 5) -> Column:
    """``pd.qcut(x, q, labels=range(q), duplicates='drop')`` against an edges
    array: right-closed bins, lowest edge included; duplicate edges collapse
    (tiers are numbered over the distinct edges)."""
    e = F.array_distinct(edges)
    xc = col(x)
    # number of distinct edges strictly below x = tier + 1, except x == min edge -> tier 0;
    # unrolled over the at most q+1 edges (no higher-order function: edges may be a subquery)
    below = sum((F.coalesce((F.get(e, F.lit(i)) < xc).cast("int"), F.lit(0)) for i in range(q + 1)), F.lit(0))
    return (F.when(xc.isNull() | (xc < e[0]) | (xc > F.array_max(e)), F.lit(None))
             .when(xc == e[0], F.lit(0.0))
             .otherwise((below - 1).cast("double")))


def stop_tier(df: DataFrame, c: str = "stop_event_rate", q: int = 5, fit_on: DataFrame | None = None,
              out: str = "stop_tier") -> DataFrame:
    """FT5: 5 quantile tiers of the stop rate (qcut semantics)."""
    edges = qcut_edges(fit_on if fit_on is not None else df, c, q)
    return df.withColumn(out, qcut_expr(c, edges, q))


def onehot_tier(df: DataFrame, c: str = "stop_tier", n: int = 5) -> DataFrame:
    """FT7: one 0/1 column per tier."""
    return df.withColumns({f"{c}_{i}": (F.col(c) == i).cast("int") for i in range(n)})


def class_counts(df: DataFrame, label: str = "target") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weight_balanced(df: DataFrame, label: str = "target", out: str = "weight", fit_on: str | None = None) -> DataFrame:
    """FT10: w_c = n / (n_classes * n_c), counted on the rows where ``fit_on``
    holds (all, if None).  The class-count table has one row per class (a
    proven bound), so it is broadcast."""
    cc = class_counts(df if fit_on is None else df.where(fit_on), label)
    tot = fit_stats(cc, {"N": F.sum("n"), "K": F.count(F.lit(1))})
    w = cc.select(label, (tot["N"] / (tot["K"] * F.col("n"))).alias(out))
    return df.join(F.broadcast(w), on=label, how="left")


def scale_pos_weight(df: DataFrame, label: str = "target", factor: float = 1.0, out: str = "weight") -> DataFrame:
    """FT11: positives weigh factor * n0 / n1, negatives 1."""
    st = fit_stats(df, {"n0": F.sum((F.col(label) == 0).cast("long")), "n1": F.sum((F.col(label) == 1).cast("long"))})
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(factor) * st["n0"] / st["n1"]).otherwise(F.lit(1.0)))


def auto_class_weights(df: DataFrame, label: str = "target", out: str = "weight") -> DataFrame:
    """FT12: Balanced = max class total / class total."""
    cc = class_counts(df, label)
    mx = cc.agg(F.max("n")).scalar()
    w = cc.select(label, (mx / F.col("n")).alias(out))
    return df.join(F.broadcast(w), on=label, how="left")


def custom_class_weight(df: DataFrame, weights: dict[int, float] | None = None, label: str = "target",
                        out: str = "weight") -> DataFrame:
    """FT13: fixed {0: 1, 1: 12}."""
    weights = weights or {0: 1.0, 1: 12.0}
    e = None
    for k, v in weights.items():
        e = F.when(F.col(label) == k, F.lit(float(v))) if e is None else e.when(F.col(label) == k, F.lit(float(v)))
    return df.withColumn(out, e.otherwise(F.lit(1.0)))
