"""Projections, filters and cleaning.

Quantile thresholds are scalar subqueries (``DataFrame.scalar()``) from
``stopcast.operators.quantiles`` (the column is counted first; only that
count reaches the driver): no cross join.  Filters run in sequence and every
quantile is taken on what is left, as in the reference.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from stopcast.semantics import nan_to_null

# Fixed values of the reference.
EVENT_KEEP = "bstop_open"
ETL_DROP_COLUMNS = [
    "event_date", "event_name", "ga_session_id", "platform", "operating_system_version", "mobile_brand_name",
    "mobile_model_name", "mobile_marketing_name", "traffic_source_source", "ctm_country", "ctm_state",
    "ctm_city", "ctm_district", "stop_address", "ctm_stop_fav", "ctm_service_fav", "headsign",
]
LEAKY_COLUMNS = [
    "y_pred", "y_pred_proba", "ctm_service_route", "direction", "lotacao_proxy_binaria",
    "user_conversion_rate", "user_total_conversions", "stop_conversion_rate",
    "conversion_interaction", "user_stop_affinity",
]
INDEX_ARTEFACTS = ["Unnamed: 0", "int64_field_0"]
FILL_DEFAULTS = {"headway_avg_stop_hour": 3600.0, "stop_dist_std": 0.0, "stop_headway_std": 0.0,
                 "user_recency_days": 999, "stop_recency_days": 999, "geo_cluster": -1}


def filter_event(df: DataFrame, name: str = EVENT_KEEP, col: str = "event_name") -> DataFrame:
    """PRJ1."""
    return df.where(F.col(col) == F.lit(name))


def drop_existing(df: DataFrame, cols: Iterable[str] = ETL_DROP_COLUMNS) -> DataFrame:
    """PRJ2: drop the listed columns that exist (``errors='ignore'``)."""
    return df.drop(*[c for c in cols if c in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ3."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def sanitize_names(df: DataFrame) -> DataFrame:
    """PRJ4: strip ``[]<>{}"`` and turn ``:`` / ``,`` into ``_`` in names."""
    def clean(n: str) -> str:
        n = re.sub(r'[\[\]<>{}"]', "", n)
        return re.sub(r"[:,]", "_", n)
    return df.toDF(*[clean(c) for c in df.columns])


def select_numeric(df: DataFrame, exclude: Iterable[str] = ("target", "event_id", "user_pseudo_id",
                                                            "gtfs_stop_id", "session_id")) -> list[str]:
    """PRJ5: numeric feature columns minus target, ids, timestamps and index
    artefacts (decided from the schema at plan-build time)."""
    ex = set(exclude) | set(INDEX_ARTEFACTS)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def drop_categorical(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """PRJ6: drop remaining string columns."""
    k = set(keep)
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in k])


def cast_all_float(df: DataFrame, features: Sequence[str], label: str = "target") -> DataFrame:
    """PRJ7: X -> double, y -> int."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("int").alias(label),
                     *[c for c in df.columns if c not in set(features) | {label}])


def leak_guard(df: DataFrame, leaky: Iterable[str] = LEAKY_COLUMNS) -> DataFrame:
    """PRJ8: remove target-derived columns; assert none is left."""
    out = df.drop(*[c for c in leaky if c in df.columns])
    assert not set(leaky) & set(out.columns)
    return out


def quantile_scalar(df: DataFrame, c: str, p: float, exact: bool = True) -> Column:
    """Linear-interpolated quantile of ``c`` (pandas ``quantile``) as a
    scalar subquery, computed by ranking (no single-task value buffer);
    ``exact=False`` uses the ``percentile_approx`` sketch."""
    from stopcast.operators.quantiles import quantile
    return quantile(df, c, p, approx=not exact)


def freq_quantile(df: DataFrame, p: float = 0.10, c: str = "user_frequency", exact: bool = True) -> DataFrame:
    """FLT1: keep ``c >= Q(p)``."""
    return df.where(F.col(c) >= quantile_scalar(df, c, p, exact))


def freq_min(df: DataFrame, n: int = 2, c: str = "user_frequency") -> DataFrame:
    """FLT2."""
    return df.where(F.col(c) >= n)


def coords_valid_pred(lat: str = "device_lat", lon: str = "device_lon") -> Column:
    return ~(F.col(lat).isNull() | F.col(lon).isNull()) & ~((F.col(lat) == 0) & (F.col(lon) == 0))


def coords_valid(df: DataFrame, lat: str = "device_lat", lon: str = "device_lon") -> DataFrame:
    """FLT3: drop NULL lat/lon, then exact (0, 0)."""
    return df.where(coords_valid_pred(lat, lon))


def dist_quantile(df: DataFrame, p: float = 0.98, c: str = "dist_device_stop", inclusive: bool = True,
                  exact: bool = True) -> DataFrame:
    """FLT4: ``c <= Q(p)`` (KNN, p=.98) or ``c < Q(p)`` (RF, p=.99)."""
    q = quantile_scalar(df, c, p, exact)
    return df.where(F.col(c) <= q if inclusive else F.col(c) < q)


def stop_min_events(df: DataFrame, p: float = 0.10, count_col: str = "stop_event_count",
                    headway_col: str | None = "headway_avg_stop_hour", max_headway: float = 3600.0) -> DataFrame:
    """FLT5: keep stops with ``count_col >= Q(p)`` and a valid headway."""
    out = df.where(F.col(count_col) >= quantile_scalar(df, count_col, p))
    if headway_col and headway_col in df.columns:
        out = out.where(F.col(headway_col).isNotNull() & (F.col(headway_col) > 0) & (F.col(headway_col) <= max_headway))
    return out


def clean_report(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """FLT6: rows removed by each cumulative predicate, in one pass.

    ``steps``: (name, keep predicate) applied in order.  Predicates must not
    depend on the filtered data (quantile steps are resolved beforehand).
    Returns (step_no, step, removed, removed_pct, kept).
    """
    total = F.count(F.lit(1))
    kept_exprs = []
    cum: Column | None = None
    for i, (_, pred) in enumerate(steps):
        p = F.coalesce(pred, F.lit(False))
        cum = p if cum is None else (cum & p)
        kept_exprs.append(F.sum(cum.cast("long")).alias(f"k{i}"))
    row = df.agg(total.alias("n"), *kept_exprs)
    prev = "n"
    parts = []
    for i, (name, _) in enumerate(steps):
        parts.append(F.struct(F.lit(i + 1).alias("step_no"), F.lit(name).alias("step"),
                              (F.col(prev) - F.col(f"k{i}")).alias("removed"),
                              (F.lit(100.0) * F.try_divide(F.col(prev) - F.col(f"k{i}"), F.col(prev))).alias("removed_pct"),
                              F.col(f"k{i}").alias("kept")))
        prev = f"k{i}"
    return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def dropna_label(df: DataFrame, label: str = "lotacao_proxy_binaria") -> DataFrame:
    """FLT7."""
    return df.where(F.col(label).isNotNull())


def inf_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """FLT8: +-inf and NaN -> NULL in floating columns."""
    from stopcast.semantics import normalize_nulls
    return normalize_nulls(df, cols)


def fill_null(df: DataFrame, defaults: dict | None = None, numeric_zero: bool = False) -> DataFrame:
    """FLT9: named defaults (3600 headway, 0 std, 999 recency, -1 cluster),
    then optionally 0 for every other numeric column (``fillna(0)``)."""
    d = {k: v for k, v in (defaults if defaults is not None else FILL_DEFAULTS).items() if k in df.columns}
    out = df.na.fill(d) if d else df
    if numeric_zero:
        num = [f.name for f in out.schema.fields if isinstance(f.dataType, NumericType)]
        out = out.na.fill(0, subset=num)
    return out


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """FLT10: (column, nulls, null_pct) for every column, one aggregate pass,
    unpivoted with ``stack``; sorted by nulls desc then name."""
    cols = list(cols or df.columns)
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(f"n{i}") for i, c in enumerate(cols)]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    long = row.selectExpr("__rows", f"stack({len(cols)}, {pairs}) as (`column`, nulls)")
    return (long.select("column", F.col("nulls").cast("long").alias("nulls"),
                        (F.lit(100.0) * F.col("nulls") / F.col("__rows")).alias("null_pct"))
            .orderBy(F.desc("nulls"), "column"))


def nan_safe(c: str) -> Column:
    return nan_to_null(c)
