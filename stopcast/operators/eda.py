"""Exploratory aggregates, top-k and set operators (SURVEY §2.4 AG9-AG28,
§2.6, §2.7).

Statistics are distributed aggregates; wide results are unpivoted with
``stack`` into tidy long tables.  Quantiles are exact and interpolated
(pandas ``quantile``) via ``stopcast.operators.quantiles`` (ranked positions),
with the ``percentile_approx`` sketch as an option.  Correlations of any number of
columns come from one pass of block products (``comoments``).  Top-k uses a total order (value desc, then key) so ties are
deterministic.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopcast.functions.calendar import DAY_NAMES
from stopcast.operators.sums import added, centre, matrix

# Fixed values of the reference: imbalance thresholds, histogram and hexbin sizes.
IMBALANCE_SEVERE = 3.0
IMBALANCE_MODERATE = 1.5
HIST_BINS = 50
HEX_GRID = 50
IQR_K = 1.5


def _stack(row: DataFrame, names: Sequence[str], prefix: str, key: str = "feature", val: str = "value") -> DataFrame:
    pairs = ", ".join(f"'{n}', `{prefix}{i}`" for i, n in enumerate(names))
    return row.selectExpr(f"stack({len(names)}, {pairs}) as (`{key}`, `{val}`)")


def class_distribution(df: DataFrame, label: str = "target") -> DataFrame:
    """AG9: (class, n, pct, imbalance_ratio, severity)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # the class table has one row per class
    r = c.select(F.col(label).alias("class"), "n", (F.lit(100.0) * F.col("n") / F.sum("n").over(w)).alias("pct"),
                 (F.max("n").over(w) / F.min("n").over(w)).alias("imbalance_ratio"))
    sev = (F.when(F.col("imbalance_ratio") > IMBALANCE_SEVERE, F.lit("severe"))
            .when(F.col("imbalance_ratio") > IMBALANCE_MODERATE, F.lit("moderate")).otherwise(F.lit("balanced")))
    return r.withColumn("severity", sev)


def events_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    """AG10/AG13: counts per key value."""
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n_events"))


def peak(counts: DataFrame, key: str, val: str = "n_events") -> DataFrame:
    """Row with the largest value (ties -> smallest key)."""
    return counts.agg(F.min_by(key, F.struct((-F.col(val)).alias("v"), F.col(key).alias("k"))).alias(f"peak_{key}"),
                      F.max(val).alias(f"peak_{val}"))


def events_by_weekday(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """AG11: counts per day name in Monday..Sunday order (missing days NULL),
    with the busiest / quietest flags."""
    days = df.sparkSession.createDataFrame([(i, d) for i, d in enumerate(DAY_NAMES)], "day_idx int, day_name string")
    c = df.groupBy(F.weekday(ts).alias("day_idx")).agg(F.count(F.lit(1)).alias("n_events"))
    j = F.broadcast(days).join(c, on="day_idx", how="left")   # 7 rows
    w = Window.partitionBy()
    return j.select("day_idx", "day_name", "n_events",
                    (F.col("n_events") == F.max("n_events").over(w)).cast("int").alias("is_busiest"),
                    (F.col("n_events") == F.min("n_events").over(w)).cast("int").alias("is_quietest"))


def rate_by(df: DataFrame, key: Column, name: str, target: str = "target") -> DataFrame:
    """AG12: positive rate x100 per key."""
    return df.groupBy(key.alias(name)).agg((F.avg(target) * F.lit(100.0)).alias("rate_pct"))


def time_span(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """AG14: first, last, whole days between."""
    r = df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return r.withColumn("span_days", F.floor((F.unix_micros("last_ts") - F.unix_micros("first_ts")) / F.lit(86_400_000_000)).cast("long"))


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """AG15: count, mean, std, min, 25/50/75 %, max, missing, missing_pct per
    feature (one aggregate pass, long form)."""
    from stopcast.operators.quantiles import many_quantiles
    stats = ["count", "mean", "std", "min", "q25", "q50", "q75", "max", "missing"]
    aggs = []
    quartiles = many_quantiles(df, {c: c for c in cols}, [0.25, 0.5, 0.75], approx=not exact)
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        q = quartiles[c]
        aggs.append(F.struct(F.count(x).cast("double").alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                             F.min(x).alias("min"), q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"),
                             F.max(x).alias("max"), F.sum(x.isNull().cast("long")).cast("double").alias("missing")).alias(f"s{i}"))
    row = df.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    long = row.selectExpr("__n", f"stack({len(cols)}, " + ", ".join(f"'{c}', s{i}" for i, c in enumerate(cols)) + ") as (feature, s)")
    return long.select("feature", *[F.col(f"s.{s}").alias(s) for s in stats],
                       (F.lit(100.0) * F.col("s.missing") / F.col("__n")).alias("missing_pct"))


def entity_stats(df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """AG16: per entity kind: distinct entities, median / mean / max events
    per entity (two-level aggregate; the first level is map-side combined)."""
    parts = []
    for name, k in keys.items():
        per = df.where(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("n"))
        from stopcast.operators.quantiles import quantile
        parts.append(per.agg(F.lit(name).alias("entity"), F.count(F.lit(1)).alias("n_entities"),
                             quantile(per, "n", 0.5).alias("median_events"),
                             F.avg("n").alias("mean_events"), F.max("n").alias("max_events")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quantile_points(df: DataFrame, c: str) -> DataFrame:
    """AG17: P95, P99, mean, median."""
    from stopcast.operators.quantiles import quantiles
    q = quantiles(df, c, [0.95, 0.99, 0.5])
    return df.agg(F.avg(c).alias("mean")).select(q[0].alias("p95"), q[1].alias("p99"), "mean", q[2].alias("median"))


def iqr_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG18: Q1, Q3, fences at 1.5 IQR, outlier count and % per feature.
    Quartiles are scalar subqueries (ranked, ``quantiles``), the counts one
    aggregate pass: no join, no cross product."""
    from stopcast.operators.quantiles import many_quantiles
    aggs = []
    quartiles = many_quantiles(df, {c: c for c in cols}, [0.25, 0.75])
    for i, c in enumerate(cols):
        qs = quartiles[c]
        q1, q3 = qs[0], qs[1]
        iqr = q3 - q1
        lo, hi = q1 - F.lit(IQR_K) * iqr, q3 + F.lit(IQR_K) * iqr
        x = F.col(c)
        aggs.append(F.struct(q1.alias("q1"), q3.alias("q3"), iqr.alias("iqr"), lo.alias("lower"), hi.alias("upper"),
                             F.sum(((x < lo) | (x > hi)).cast("long")).alias("n_outliers")).alias(f"o{i}"))
    row = df.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    long = row.selectExpr("__n", f"stack({len(cols)}, " + ", ".join(f"'{c}', o{i}" for i, c in enumerate(cols)) + ") as (feature, o)")
    return long.select("feature", "o.q1", "o.q3", "o.iqr", "o.lower", "o.upper", "o.n_outliers",
                       (F.lit(100.0) * F.col("o.n_outliers") / F.col("__n")).alias("outlier_pct"))


def comoments(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Pairwise complete moments of ``left`` x ``right`` columns from one pass:
    (rows, sum of l, sum of r, sum of l^2, sum of r^2, sum of l r), all over the rows
    where both have a value and about a point amid the values.  A block of rows gives
    six products of matrices, which add up over all rows."""
    names = list(dict.fromkeys([*left, *right]))
    d = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    about = centre(d, names)
    li, ri = ([names.index(c) for c in some] for some in (left, right))

    def scan(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        got = np.zeros((len(left), 6, len(right)))
        for b in batches:
            x = matrix(b, names) - about
            ok = np.isfinite(x)
            x, v = np.where(ok, x, 0.0), ok.astype(float)
            lx, lv, rx, rv = x[:, li].T, v[:, li].T, x[:, ri], v[:, ri]
            for i, (p, q) in enumerate(((lv, rv), (lx, rv), (lv, rx), (lx * lx, rv), (lv, rx * rx), (lx, rx))):
                got[:, i] += p @ q
        return {i: got[i].ravel() for i in range(len(left))}

    found = added(d, scan)
    return np.stack([found[i].reshape(6, len(right)) if i in found else np.zeros((6, len(right))) for i in range(len(left))], axis=1)


def correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Pearson r of every pair; NaN with fewer than two rows or without spread."""
    n, sl, sr, ll, rr, lr = comoments(df, left, right)
    with np.errstate(invalid="ignore", divide="ignore"):
        vl, vr = ll - sl * sl / n, rr - sr * sr / n
        spread = (n > 1) & (vl > 1e-14 * ll) & (vr > 1e-14 * rr)
        return np.where(spread, np.clip((lr - sl * sr / n) / np.sqrt(vl * vr), -1.0, 1.0), np.nan)


def _or_null(x: float) -> float | None:
    return None if np.isnan(x) else float(x)


def corr_target(df: DataFrame, cols: Sequence[str], target: str = "target") -> DataFrame:
    """AG19: Pearson r of each feature with the target (pairwise complete)."""
    r = correlations(df, cols, [target])[:, 0]
    return df.sparkSession.createDataFrame([(c, _or_null(x)) for c, x in zip(cols, r, strict=True)], "feature string, corr double")


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG20: pairwise Pearson matrix in long form (f1, f2, corr), i < j and
    the diagonal omitted; one pass whatever the number of columns."""
    r = correlations(df, cols, cols)
    return df.sparkSession.createDataFrame([(a, b, _or_null(r[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j],
                                           "f1 string, f2 string, corr double")


def top_abs(corr: DataFrame, n: int, col: str = "corr", key: str = "feature") -> DataFrame:
    """SRT6: n largest by absolute value (ties -> key)."""
    return corr.where(F.col(col).isNotNull()).orderBy(F.abs(col).desc(), F.col(key)).limit(n)


def collinear_pairs(pairs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """AG21: |r| > threshold."""
    return pairs.where(F.abs("corr") > threshold)


def top_bottom(corr: DataFrame, n: int = 15, col: str = "corr", key: str = "feature") -> DataFrame:
    """SRT3: n highest and n lowest, concatenated."""
    base = corr.where(F.col(col).isNotNull())
    hi = base.orderBy(F.desc(col), key).limit(n).withColumn("side", F.lit("top"))
    lo = base.orderBy(F.asc(col), key).limit(n).withColumn("side", F.lit("bottom"))
    return hi.unionByName(lo)


def topk(df: DataFrame, score: str, n: int, key: str) -> DataFrame:
    """SRT2/SRT4: top n by score desc (ties -> key asc)."""
    return df.orderBy(F.desc(score), F.asc(key)).limit(n)


def top_entities(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """SRT4: top n keys by event count."""
    c = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_events"))
    return topk(c, "n_events", n, key)


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, examples: int = 5) -> DataFrame:
    """AG22: per column: type, exact distinct count, ``examples`` smallest
    distinct values (as text).  The examples are a top-n over the column's
    distinct values (``TakeOrderedAndProject``) read as a scalar subquery,
    so no task ever holds all distinct values."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    parts = []
    for c in cols:
        d = df.select(F.col(c).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
        smallest = d.orderBy("v").limit(examples).agg(F.array_join(F.array_sort(F.collect_list("v")), ", "))
        parts.append(d.agg(F.count(F.lit(1)).alias("n_distinct")).select(
            F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), "n_distinct",
            smallest.scalar().alias("examples")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def feature_variance(df: DataFrame, cols: Sequence[str], n: int = 20) -> DataFrame:
    """AG23: population variance per feature, top n."""
    row = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    return topk(_stack(row, cols, "v", "feature", "variance"), "variance", n, "feature")


def histogram(df: DataFrame, c: str, bins: int = HIST_BINS, below_quantile: float | None = None) -> DataFrame:
    """AG26: equal-width bins over [min, max] (numpy: the max falls in the
    last bin); optionally only values below the given quantile."""
    base = df.where(F.col(c).isNotNull())
    if below_quantile is not None:
        from stopcast.operators.quantiles import quantile
        base = base.where(F.col(c) < quantile(base, c, below_quantile))
    mm = base.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias("s")).scalar()
    lo, hi = mm["lo"], mm["hi"]
    width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
    b = F.least(F.floor(F.lit(float(bins)) * (F.col(c) - lo) / width), F.lit(bins - 1)).cast("int")
    return (base.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
                .withColumns({"bin_lo": lo + F.col("bin") * width / F.lit(float(bins)),
                              "bin_hi": lo + (F.col("bin") + 1) * width / F.lit(float(bins))}))


def hexbin_density(df: DataFrame, lat: str = "device_lat", lon: str = "device_lon", grid: int = HEX_GRID) -> DataFrame:
    """AG27: event density on a grid x grid square lattice over the extent
    of the valid coordinates (all rows, no sampling)."""
    from stopcast.operators.cleaning import coords_valid_pred
    base = df.where(coords_valid_pred(lat, lon))
    mm = base.agg(F.struct(F.min(lat).alias("a"), F.max(lat).alias("b"), F.min(lon).alias("c"),
                           F.max(lon).alias("d")).alias("s")).scalar()

    def cell(x: str, lo: Column, hi: Column) -> Column:
        w = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        return F.least(F.floor(F.lit(float(grid)) * (F.col(x) - lo) / w), F.lit(grid - 1)).cast("int")

    return base.groupBy(cell(lat, mm["a"], mm["b"]).alias("lat_cell"), cell(lon, mm["c"], mm["d"]).alias("lon_cell")).agg(
        F.count(F.lit(1)).alias("n"))


def geo_extent(df: DataFrame, lat: str = "device_lat", lon: str = "device_lon") -> DataFrame:
    """AG28: valid-coordinate count, lat/lon min and max."""
    from stopcast.operators.cleaning import coords_valid_pred
    return df.where(coords_valid_pred(lat, lon)).agg(
        F.count(F.lit(1)).alias("n_valid"), F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"))


def set_difference(all_names: DataFrame, selected: DataFrame, col: str = "feature") -> DataFrame:
    """SET3: removed = all - selected (bag difference)."""
    return all_names.select(col).exceptAll(selected.select(col))


def names_table(spark, names: Sequence[str], col: str = "feature") -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{col} string")
