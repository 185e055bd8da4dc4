"""Global positional index without a one-partition window (G1, WN12) and
the temporal splits built on it (VS1, VS2).

Plan: a range partition on ALL order columns (and the row's place in the
input, so that rows that tie in all of them still split), a sort inside each
partition, and the position inside it; then the row counts of the partitions
(one row each), whose running sum is every partition's offset.  Spark samples
the ranges and splits them by rows, so no value, tied or not, and no burst of
equal timestamps makes a partition large.  The ranged rows are written once in
the shared folder: the counts and the positions must see the same ranges, and
the input is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopcast.semantics import ORDER_COLS
from stopcast.session import materialize

#: monotonically_increasing_id() = partition << 33 | row of the partition.
ROW_BITS = 33


def ranged_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` in ``order``, with ``__pos`` = range << 33 | row of the range."""
    keys = [f"__o{i}" for i in range(len(order))]
    d = df.withColumns({**dict(zip(keys, order, strict=True)), "__tie": F.monotonically_increasing_id()})
    d = d.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], F.col("__tie"))
    d = d.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys], "__tie")
    return materialize(d.drop(*keys, "__tie").withColumn("__pos", F.monotonically_increasing_id()))


def _range(c: str = "__pos") -> Column:
    return F.shiftright(c, ROW_BITS)


def _offsets(ranged: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """(__range, sums over all earlier ranges): one row a range, broadcast."""
    per = ranged.groupBy(_range().alias("__range")).agg(*[e.alias(f"__t_{n}") for n, e in sums.items()])
    w = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(per.select("__range", *[F.coalesce(F.sum(f"__t_{n}").over(w), F.lit(0)).alias(n) for n in sums]))


def global_row_index(df: DataFrame, order: Sequence[str] = ORDER_COLS, idx_col: str = "row_idx") -> DataFrame:
    """Add ``idx_col`` = 0-based position of the row in ``order``."""
    ranged = ranged_rows(df, [F.col(c) for c in order])
    offs = _offsets(ranged, {"__off": F.count(F.lit(1))})
    row = F.col("__pos").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (ranged.withColumn("__range", _range()).join(offs, "__range")
            .withColumn(idx_col, (F.col("__off") + row).cast("long")).drop("__pos", "__range", "__off"))


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def time_series_split(df: DataFrame, k: int = 3, order: Sequence[str] = ORDER_COLS, idx_col: str = "row_idx") -> DataFrame:
    """VS1: scikit-learn ``TimeSeriesSplit(k)`` positions.

    t = n div (k+1); fold i (0..k-1) tests rows [n-(k-i)t, n-(k-i-1)t) and
    trains on everything before.  Adds ``fold`` (test fold of the row, -1
    for the always-train head), ``is_train`` / ``is_test`` for the last fold
    (the holdout the scripts keep)."""
    ix = df if idx_col in df.columns else global_row_index(df, order, idx_col)
    n = row_count(df)
    t = F.floor(n / F.lit(k + 1))
    start = n - F.lit(k) * t
    i = F.col(idx_col)
    fold = F.when(i >= start, F.floor((i - start) / t)).otherwise(F.lit(-1)).cast("int")
    return ix.withColumns({"fold": fold, "is_train": (i < n - t).cast("int"), "is_test": (i >= n - t).cast("int")})


def holdout_split(df: DataFrame, train_frac: float = 0.8, order: Sequence[str] = ORDER_COLS,
                  idx_col: str = "row_idx") -> DataFrame:
    """VS2: first ``floor(frac * n)`` rows train, the rest test."""
    ix = df if idx_col in df.columns else global_row_index(df, order, idx_col)
    n = row_count(df)
    return ix.withColumn("is_train", (F.col(idx_col) < F.floor(n * F.lit(train_frac))).cast("int"))


def expanding_folds(df: DataFrame, k: int = 5, order: Sequence[str] = ORDER_COLS, idx_col: str = "row_idx") -> DataFrame:
    """Fold column for expanding-window CV (VS3): fold i in 0..k-1 is a test
    block; ``fold = -1`` rows are only ever train."""
    return time_series_split(df, k, order, idx_col)


def prefix_before(df: DataFrame, order_col: str | Sequence[str], cols: Sequence[str], *, descending: bool = False) -> DataFrame:
    """G2: add ``{c}_before`` = sum of ``c`` over the rows strictly before
    each row in the order of ``order_col`` (one row per value, e.g. an
    aggregated score table).  Sums inside each range plus the sums of the
    ranges before it."""
    names = [order_col] if isinstance(order_col, str) else list(order_col)
    ranged = ranged_rows(df, [-F.col(c) if descending else F.col(c) for c in names])
    offs = _offsets(ranged, {f"__o_{c}": F.sum(c) for c in cols})
    w = Window.partitionBy("__range").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("__range", _range()).withColumns({f"__l_{c}": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in cols})
    j = local.join(offs, "__range")
    return j.withColumns({f"{c}_before": F.col(f"__o_{c}") + F.col(f"__l_{c}") for c in cols}).drop(
        "__pos", "__range", *[f"__l_{c}" for c in cols], *[f"__o_{c}" for c in cols])
