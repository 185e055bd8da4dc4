"""Leak-free training frame (entry 2 of the reference): calendar parts,
expanding history, feature formulas, cleaning, temporal split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopcast.functions import calendar as cal
from stopcast.functions.features import with_poly_terms, with_rf_features, with_scores
from stopcast.operators import cleaning as C
from stopcast.operators.history import WARMUP_ROWS, rf_history
from stopcast.operators.rowindex import time_series_split

ID_COLS = ("event_id", "user_pseudo_id", "gtfs_stop_id", "gtfs_route_id", "session_id", "row_idx", "fold",
           "is_train", "is_test")


def rf_frame(df: DataFrame, *, warmup: int = WARMUP_ROWS) -> DataFrame:
    """Calendar + cyclic parts, WN1-WN5 history, SC3/SC11-SC15/SC17/SC20."""
    df = cal.date_parts(df, names={"hour": "hour", "day_of_week": "day_of_week", "day_of_month": "day_of_month",
                                   "month": "month"})
    df = cal.with_cyclic(df, {"hour": ("hour", 24), "day": ("day_of_week", 7), "month": ("month", 12)})
    df = rf_history(df, warmup=warmup)
    return with_rf_features(df)


def clean_rf(df: DataFrame, *, coord_nulls: str = "zero_fill", approx: bool = False) -> DataFrame:
    """RF cleaning: fillna(0) on numerics, ``user_frequency >= 2``, coords
    (after the fill only exact (0,0) rows go: 'zero_fill'; 'drop' filters
    real NULLs first), ``dist < Q99`` on what is left (``approx``: sketch
    quantile instead of the exact one)."""
    if coord_nulls == "drop":
        df = C.coords_valid(df)
    df = C.fill_null(df, {}, numeric_zero=True)
    if "user_frequency" in df.columns:
        df = C.freq_min(df, 2)
    if "device_lat" in df.columns:
        df = C.coords_valid(df)
    if "dist_device_stop" in df.columns:
        df = C.dist_quantile(df, 0.99, inclusive=False, exact=not approx)
    return df


def clean_knn(df: DataFrame, *, approx: bool = False) -> DataFrame:
    """k-NN cleaning: user_frequency >= Q10, coords on real NULLs, dist <= Q98
    (``approx``: sketch quantiles instead of exact ones)."""
    if "user_frequency" in df.columns:
        df = C.freq_quantile(df, 0.10, exact=not approx)
    if "device_lat" in df.columns:
        df = C.coords_valid(df)
    if "dist_device_stop" in df.columns:
        df = C.dist_quantile(df, 0.98, inclusive=True, exact=not approx)
    return df


def training_table(events: DataFrame, *, k: int = 3, extra: bool = False, approx: bool = False) -> DataFrame:
    """History features -> clean -> positions taken after cleaning ->
    ``fold`` / ``is_train`` / ``is_test`` of TimeSeriesSplit(k).  ``approx``
    uses sketch quantiles in the cleaning filters."""
    from stopcast.session import materialize
    df = rf_frame(events)
    if extra:
        df = with_scores(with_poly_terms(df))
    # the cleaning quantiles and the split's count / boundaries each read the
    # frame again: compute the history once and the cleaned table once
    df = materialize(clean_rf(materialize(df), approx=approx))
    return time_series_split(df, k)


def feature_columns(df: DataFrame) -> list[str]:
    """PRJ5 on the training table."""
    return C.select_numeric(df, exclude=set(ID_COLS) | {"target"})


def label_col(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("target").cast("double"))
