"""A representative subset of registered queries against their DuckDB oracle
at sf0.001 (the full set runs with scripts/oracle_check.py)."""

import os

import duckdb
import pytest

from scripts.oracle_check import compare
from stopcast.sources.tables import TABLES
from tests.conftest import SF001

SUBSET = ["warmup", "user_hist_ext", "nearest_stop_device", "join_window_label", "join_headway", "is_holiday",
          "build_features", "time_series_split", "clean_report", "describe", "iqr_outliers", "roc_auc", "roc_curve",
          "threshold_grid", "classification_report", "undersample_ratio", "knn_join", "smote", "stop_tier",
          "stream_hist"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    a = queries()[name](spark, SF001).toPandas()
    b = con.execute(oracle_sql()[name]).df()
    ok, msg = compare(a, b)
    assert ok, msg
