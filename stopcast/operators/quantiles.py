"""Exact quantiles without a single-task buffer.

Spark's exact ``percentile`` aggregate keeps a value -> count map of every
distinct value and merges it in one final task: unbounded on a continuous
column of a very large table.  Here the (column, value) pairs of all asked
columns are counted in one pass (map-side combined, so a value that a third of
all rows share is one row), running sums over them in range order
(``rowindex.prefix_before``) give every value's positions, and the interpolated
quantile (pandas / ``quantile_cont``: position h = (n-1) p, value x[floor h] +
(h - floor h) (x[ceil h] - x[floor h])) is read from the two values at those
positions.  One plan at every size.  ``approx=True`` uses the
``percentile_approx`` sketch instead (bounded memory, returns a data value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.operators.rowindex import prefix_before
from stopcast.session import materialize

APPROX_ACCURACY = 10000


def quantile_table(df: DataFrame, columns: dict[str, str | Column], probs: Sequence[float]) -> DataFrame:
    """(name, q array<double>): the quantiles of all ``columns`` in one pass
    (NULLs ignored; a column without values has no row)."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("x"))
                      for n, c in columns.items()])
    counts = (df.select(F.explode(pairs).alias("p")).select("p.name", "p.x").where(F.col("x").isNotNull())
              .groupBy("name", "x").agg(F.count(F.lit(1)).alias("n")))
    ranks = prefix_before(counts, ["name", "x"], ["n"])
    return _at_positions(ranks, "name", F.broadcast(_spans(ranks, "name")), probs)      # a row a column


def group_quantiles(df: DataFrame, key: str, c: str, probs: Sequence[float]) -> DataFrame:
    """(key, q array<double>): the quantiles of ``c`` within every group (NULL
    keys and values ignored; a group without values has no row).

    The (key, value) pairs are counted, and a value's positions in its group are
    its running sum over all pairs in range order less that of the group's first
    value: a hot group's values lie in as many ranges as they need, and a value
    that it repeats is one row."""
    counts = (df.select(F.col(key), F.col(c).cast("double").alias("x")).where(F.col(key).isNotNull() & F.col("x").isNotNull())
              .groupBy(key, "x").agg(F.count(F.lit(1)).alias("n")))
    ranks = prefix_before(counts, [key, "x"], ["n"])
    return _at_positions(ranks, key, _spans(ranks, key), probs)


def _spans(ranks: DataFrame, by: str) -> DataFrame:
    """Where each group's values begin in the common order, and how many there are."""
    return ranks.groupBy(by).agg(F.min("n_before").alias("__first"), F.sum("n").alias("__n"))


def _at_positions(ranks: DataFrame, by: str, spans: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(by, q): each group's values at the positions of ``probs``, interpolated."""
    j = ranks.join(spans, by).withColumn("__at", F.col("n_before") - F.col("__first"))
    aggs, vals = [], []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        for side, pos in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            here = (F.col("__at") <= pos) & (pos < F.col("__at") + F.col("n"))
            aggs.append(F.max(F.when(here, F.col("x"))).alias(f"__{side}{i}"))
        vals.append(F.col(f"__lo{i}") + ((F.col("__n") - 1).cast("double") * F.lit(float(p))
                                         - F.floor((F.col("__n") - 1).cast("double") * F.lit(float(p))))
                    * (F.col(f"__hi{i}") - F.col(f"__lo{i}")))
    return j.groupBy(by, "__n").agg(*aggs).select(by, F.array(*vals).alias("q"))


def many_quantiles(df: DataFrame, columns: dict[str, str | Column], probs: Sequence[float],
                   approx: bool = False) -> dict[str, Column]:
    """Scalar ``array<double>`` of the quantiles of every column, from one pass: the
    table, one row a column, is written, so that no column and no use of a scalar
    counts the values again."""
    if approx:
        return {n: df.agg(F.percentile_approx((F.col(c) if isinstance(c, str) else c).cast("double"), list(probs),
                                              APPROX_ACCURACY).cast("array<double>")).scalar() for n, c in columns.items()}
    table = materialize(quantile_table(df, columns, probs))
    return {n: table.where(F.col("name") == n).select("q").scalar() for n in columns}


def quantiles(df: DataFrame, c: str | Column, probs: Sequence[float], approx: bool = False) -> Column:
    """Scalar ``array<double>`` of the quantiles of ``c`` (NULLs ignored;
    NULL when the column is empty)."""
    return many_quantiles(df, {"x": c}, probs, approx)["x"]


def quantile(df: DataFrame, c: str | Column, p: float, approx: bool = False) -> Column:
    """Scalar of one quantile."""
    return quantiles(df, c, [p], approx)[0]
