"""Shared column semantics pinned to the reference behaviour.

* NaN/inf are normalised to SQL NULL at the source, because Spark orders NaN
  above every number and propagates it through ``avg`` while pandas skips it.
* Division uses ``try_divide`` (ANSI mode raises on x/0).
* Randomness is a hash of (id, seed): repeatable, order-free, and computable
  by any SQL engine (``md5`` is used because DuckDB and Spark agree on it).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, DoubleType, FloatType

# Fixed value: default event order used everywhere a total order is needed.
ORDER_COLS = ("event_timestamp", "event_id")

MICROS_PER_DAY = 86_400_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    return F.try_divide(col(num), col(den))


def nan_to_null(c: str | Column) -> Column:
    """NaN and +-inf -> NULL (pandas treats all three as missing)."""
    x = col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def normalize_nulls(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Replace NaN/inf by NULL in every floating column (or the given ones)."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    targets = [c for c in (cols if cols is not None else fl) if c in fl]
    if not targets:
        return df
    return df.withColumns({c: nan_to_null(c) for c in targets})


def whole_days(later: str | Column, earlier: str | Column) -> Column:
    """``(later - earlier).days`` of pandas: floor of elapsed micros / day."""
    return F.floor((F.unix_micros(col(later)) - F.unix_micros(col(earlier))) / F.lit(MICROS_PER_DAY)).cast("long")


def hash_hex(seed: int, *cols: str | Column) -> Column:
    """md5 of ``seed:c1:c2...`` as hex text; order-free pseudo-random key."""
    parts = [F.lit(str(seed))] + [col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_unit(seed: int, *cols: str | Column) -> Column:
    """Uniform [0,1) from the first 13 hex digits (52 bits) of ``hash_hex``."""
    h = F.substring(hash_hex(seed, *cols), 1, 13)
    return (F.conv(h, 16, 10).cast("double") / F.lit(float(16 ** 13)))


def cut_right_closed(x: str | Column, edges: Sequence[float], labels: Sequence | None = None) -> Column:
    """``pd.cut(x, bins=edges, right=True)``: (e0,e1] -> 0, (e1,e2] -> 1, ...;
    values <= e0, > e_last or NULL give NULL."""
    xc = col(x)
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    expr = None
    for i in range(len(edges) - 1):
        cond = (xc > F.lit(edges[i])) & (xc <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def require(df: DataFrame, cols: Iterable[str], op: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{op}: missing required columns {missing}")


SNAP_BITS = 24


def snap(x: str | Column, bits: int = SNAP_BITS) -> Column:
    """Round to the nearest multiple of 2^-bits: ``floor(x*2^b + 0.5) / 2^b``.

    Used to compare results across engines.  Multiplying by a power of two is
    exact, and the rounding boundaries are dyadic numbers, which sums and
    means of decimal data practically never hit; so two engines whose results
    differ by an ulp (different summation order) still agree after ``snap``.
    Decimal ``round()`` lacks that property (and Spark rounds the shortest
    decimal string while other engines round the binary value).
    """
    scale = float(2 ** bits)
    return F.floor(col(x).cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def rounded(df: DataFrame) -> DataFrame:
    """``snap`` every floating column (for stable cross-engine comparisons)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            exprs.append(snap(f.name).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)
