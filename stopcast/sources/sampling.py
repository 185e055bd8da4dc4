"""Deterministic scans, samples and row limits (SRC1, SRC2, SRC6).

A limit is kept only where it is the feature (the reference's
``SELECT * ... LIMIT n``); it is made deterministic by a total order.
Samples are hash-based, so they are repeatable, order-free and survive task
retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from stopcast.semantics import ORDER_COLS, hash_hex


def scan_limit(df: DataFrame, n: int, order: Sequence[str] = ORDER_COLS) -> DataFrame:
    """SRC1: first ``n`` rows in ``order``, nulls first (top-n, partial per partition).

    The order columns alone are read first, for the n-th smallest tuple; its first
    value then bounds the scan of the whole rows, so that files and row groups whose
    smallest value lies beyond are never decoded."""
    first, kind = order[0], df.schema[order[0]].dataType
    exact = F.unix_micros if isinstance(kind, TimestampType) else (lambda c: c)      # no zone of the driver's comes in
    cut = df.select(*order).orderBy(*order).limit(n).agg(exact(F.max(first))).first()[0]
    if cut is None:         # no value among the first rows, or no row
        return df.orderBy(*order).limit(n)
    value = F.timestamp_micros(F.lit(cut)) if isinstance(kind, TimestampType) else F.lit(cut).cast(kind)
    bounded = df.where((F.col(first) <= value) | F.col(first).isNull())
    return bounded.orderBy(*order).limit(n)


def hash_threshold(fraction: float, digits: int = 8) -> str:
    """Hex prefix threshold so that ``md5 prefix < t`` keeps ``fraction``."""
    return format(int(fraction * 16 ** digits), f"0{digits}x")


def hash_sample(df: DataFrame, fraction: float, seed: int = 42, id_col: str = "event_id") -> DataFrame:
    """SRC2: reproducible sample of ~``fraction`` of the rows (stands in for
    ``TABLESAMPLE SYSTEM (p PERCENT)``): keep rows whose md5(seed:id) prefix
    falls under the threshold."""
    return df.where(F.substring(hash_hex(seed, id_col), 1, 8) < F.lit(hash_threshold(fraction)))


def systematic_sample(indexed: DataFrame, m: int, n_total, idx_col: str = "row_idx") -> DataFrame:
    """SRC6: the rows at positions ``floor(j*(n-1)/(m-1))``, j = 0..m-1, of a
    table that carries a global 0-based index (see ``rowindex``); all rows
    when n <= m.  ``n_total`` is a Column (scalar subquery) or int.

    A position is selected iff some j maps onto it, i.e. iff
    ``ceil(i*(m-1)/(n-1))`` maps back to ``i`` -- a per-row test, no join.
    """
    n = n_total if not isinstance(n_total, int) else F.lit(n_total)
    i = F.col(idx_col)
    j = F.ceil(i * F.lit(m - 1) / (n - 1))
    hit = F.floor(j * (n - 1) / F.lit(m - 1)) == i
    return indexed.where((n <= F.lit(m)) | hit)
