"""Leak-free "history so far" features (expanding windows).

Every feature of a row is computed from the rows of the same key that come
strictly *before* it in the total order ``(event_timestamp, event_id)``:
``ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING``.

Skew-safe plan (a key may hold a third of all rows): the rows of a hot key are
cut into ranges of its order, by bounds that are fixed once (``key_ranges``: from
a bounded sample, for all keys of a feature set together), and the frame is split
in two parts that add up

* rows of the same key earlier in the *same range*: a window partitioned by
  ``(key, range)``;
* rows of the same key in *earlier ranges*: per ``(key, range)`` partial
  aggregates of the hot keys, then a running sum over the ranges of each key.

A key that is not hot is one range, and needs the window alone.  Ranges are a
function of a row's own values and the bounds, so counts and windows see the same
ranges without the frame being written: it is shuffled once a key.  A missing
bound makes a range larger and changes no result.

Count, sum, non-null count and max(ts) add up; the sample std merges counts,
means and sums of square deviations, so large values with a small spread keep
their digits.  Null keys get no history (pandas ``==`` never matches NaN); their
rows are spread by a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopcast.semantics import ORDER_COLS, require, whole_days
from stopcast.session import materialize

# Fixed values of the reference: recency default and warm-up length.
RECENCY_DEFAULT = 999
WARMUP_ROWS = 100

RANGE_ROWS = 200_000        # rows of a key from which it is cut into ranges, at least
SAMPLE_ROWS = 65_536        # rows that are sampled for the bounds
RANGE_SAMPLE = 8            # sampled rows of a range, at least
NULL_PARTS = 1024           # groups over which rows without a key are spread


def warmup_flag(df: DataFrame, n: int, order: Sequence[str] = ORDER_COLS) -> Column:
    """True for the first ``n`` rows of the whole table in ``order``.

    The cut point is the n-th smallest order tuple, found by a top-n
    (``TakeOrderedAndProject``) in a scalar subquery: no global window and
    nothing collected to the driver.
    """
    if n <= 0:
        return F.lit(False)
    o = F.struct(*[F.col(c) for c in order])
    cut = df.select(o.alias("__o")).orderBy("__o").limit(n).agg(F.max("__o"))
    return o <= cut.scalar()


def key_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER_COLS) -> dict[str, DataFrame | None]:
    """For every key column the bounds of its hot keys' ranges, (key, ``__bounds``
    ascending order tuples), or None where no key is hot.

    One count and one sample for all of ``keys``.  The tables are bounded by the
    sample (SAMPLE_ROWS / RANGE_SAMPLE bounds together)."""
    n = df.count()
    per = max(RANGE_ROWS, RANGE_SAMPLE * n // SAMPLE_ROWS)
    if n <= per:
        return dict.fromkeys(keys)
    step = max(1, n // SAMPLE_ROWS)
    pick = F.pmod(F.xxhash64(*order, F.lit(step)), F.lit(step)) == 0
    sample = materialize(df.where(pick).select(*dict.fromkeys([*order, *keys])))
    every, out = max(1, per // step), {}
    for key in dict.fromkeys(keys):
        place = Window.partitionBy(key).orderBy(*[F.col(c) for c in order])
        hot = (sample.where(F.col(key).isNotNull())
               .withColumns({"__i": F.row_number().over(place), "__o": F.struct(*[F.col(c) for c in order])})
               .where(F.col("__i") % every == 0)
               .groupBy(F.col(key).alias("__key")).agg(F.sort_array(F.collect_list("__o")).alias("__bounds")))
        hot = materialize(hot)
        out[key] = hot if hot.limit(1).count() else None
    return out


def _range_of(bounds: Column, order: Sequence[str]) -> Column:
    """How many of the ascending ``bounds`` a row has reached, by bisection."""
    steps = [1 << i for i in reversed(range((SAMPLE_ROWS // RANGE_SAMPLE).bit_length()))]
    me = F.struct(*[F.col(c) for c in order])
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda at, x: F.when(
        (at + x <= F.size(bounds)) & (F.try_element_at(bounds, at + x) <= me), at + x).otherwise(at))


def expanding_history(
    df: DataFrame,
    key: str,
    prefix: str,
    *,
    order: Sequence[str] = ORDER_COLS,
    target: str | None = "target",
    mean_cols: Sequence[str] = (),
    std_cols: Sequence[str] = (),
    recency: bool = True,
    ranges: dict[str, DataFrame | None] | None = None,
) -> DataFrame:
    """Append raw history aggregates for ``key``.

    Adds ``{prefix}_n`` (rows before), and when ``target`` is given
    ``{prefix}_pos`` (sum of target, NULL if no labelled row) and
    ``{prefix}_lab`` (non-null targets); ``{prefix}_last_ts`` and
    ``{prefix}_recency`` (whole days, NULL when no history) if ``recency``;
    ``{prefix}_mean_{c}`` / ``{prefix}_std_{c}`` (NULL when undefined).
    ``ranges``: what ``key_ranges`` found for ``key`` on these rows; found here if
    not given.
    """
    require(df, [key, *order, *([target] if target else []), *mean_cols, *std_cols], "expanding_history")
    ts = order[0]
    k, b = f"__{prefix}_k", f"__{prefix}_b"
    bounds = (key_ranges(df, [key], order) if ranges is None else ranges)[key]
    spread = F.pmod(F.xxhash64(*order), F.lit(NULL_PARTS)).cast("int")
    if bounds is None:
        base = df.withColumns({k: F.col(key), b: F.when(F.col(key).isNull(), spread).otherwise(0)})
    else:
        base = (df.join(F.broadcast(bounds), F.col(key) == F.col("__key"), "left")      # bounded by the sample
                .withColumns({k: F.col(key), "__hot": F.col("__bounds").isNotNull(),
                              b: F.when(F.col(key).isNull(), spread).when(F.col("__bounds").isNull(), 0)
                              .otherwise(_range_of(F.col("__bounds"), order))}).drop("__key", "__bounds"))

    # (name, within-bucket frame expr builder, bucket total expr, combine kind)
    parts: list[tuple[str, Column, str]] = [("n", F.lit(1), "sum")]
    if target:
        parts += [("pos", F.col(target).cast("double"), "sum"),
                  ("lab", F.col(target).isNotNull().cast("long"), "sum")]
    if recency:
        parts += [("last", F.col(ts), "max")]
    mstats = sorted(set(mean_cols) | set(std_cols))
    for c in mstats:
        x = F.col(c).cast("double")
        parts += [(f"s1_{c}", x, "sum"), (f"c_{c}", x.isNotNull().cast("long"), "sum")]
        if c in std_cols:
            # mean and mean square deviation of the non-null values (a numerically stable aggregate)
            parts += [(f"m_{c}", x, "avg"), (f"v_{c}", x, "var_pop")]

    def agg_of(kind: str, e: Column) -> Column:
        return {"sum": F.sum, "max": F.max, "avg": F.avg, "var_pop": F.var_pop}[kind](e)

    w_in = Window.partitionBy(k, b).orderBy(*[F.col(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    over = [(n, kind) for n, _, kind in parts if kind in ("sum", "max")] + \
        [(f"{d}_{c}", "sum") for c in std_cols for d in ("d1", "d2")]
    inner = base.withColumns({f"__i_{n}": agg_of(kind, e).over(w_in) for n, e, kind in parts})

    if bounds is None:      # every key is one range
        def none(n: str, kind: str) -> Column:
            return F.lit(None).cast(df.schema[ts].dataType if kind == "max" else
                                    "bigint" if n in ("n", "lab") or n.startswith("c_") else "double")

        j = inner.withColumns({f"__p_{n}": none(n, kind) for n, kind in over}
                              | {f"__p_r_{c}": F.lit(None).cast("double") for c in std_cols})
    else:
        j = inner.drop("__hot").join(_earlier_ranges(base, k, b, parts, std_cols, over, agg_of), on=[k, b], how="left")

    def comb(n: str, kind: str) -> Column:
        i, p = F.col(f"__i_{n}"), F.col(f"__p_{n}")
        if kind == "max":
            return F.greatest(i, p)
        # sum: NULL only when both parts are NULL (no rows / no non-null values)
        return F.when(i.isNull() & p.isNull(), F.lit(None)).otherwise(F.coalesce(i, F.lit(0)) + F.coalesce(p, F.lit(0)))

    has_key = F.col(k).isNotNull()
    out: dict[str, Column] = {}
    n_rows = F.coalesce(comb("n", "sum"), F.lit(0)).cast("long")
    out[f"{prefix}_n"] = F.when(has_key, n_rows).otherwise(F.lit(0).cast("long"))
    if target:
        out[f"{prefix}_pos"] = F.when(has_key, comb("pos", "sum"))
        out[f"{prefix}_lab"] = F.when(has_key, F.coalesce(comb("lab", "sum"), F.lit(0))).otherwise(F.lit(0)).cast("long")
    if recency:
        last = F.when(has_key, comb("last", "max"))
        out[f"{prefix}_last_ts"] = last
        out[f"{prefix}_recency"] = whole_days(F.col(ts), last)
    for c in mstats:
        s1 = comb(f"s1_{c}", "sum")
        cnt = F.coalesce(comb(f"c_{c}", "sum"), F.lit(0))
        if c in mean_cols:
            out[f"{prefix}_mean_{c}"] = F.when(has_key & (cnt > 0), s1 / cnt)
        if c in std_cols:
            # merge of the two parts' (count, mean, sum of square deviations)
            zero = F.lit(0.0)
            n_in, n_pre = F.coalesce(F.col(f"__i_c_{c}"), F.lit(0)), F.coalesce(F.col(f"__p_c_{c}"), F.lit(0))
            d1 = F.col(f"__p_d1_{c}")
            m_pre = F.col(f"__p_r_{c}") + F.try_divide(d1, n_pre)
            q_pre = F.coalesce(F.col(f"__p_d2_{c}") - F.try_divide(d1 * d1, n_pre), zero)
            q_in = F.coalesce(F.col(f"__i_v_{c}") * n_in, zero)
            gap = F.coalesce(F.col(f"__i_m_{c}") - m_pre, zero)
            var = (q_in + q_pre + gap * gap * F.try_divide(n_in * n_pre, cnt)) / (cnt - 1)
            out[f"{prefix}_std_{c}"] = F.when(has_key & (cnt > 1), F.sqrt(F.greatest(var, zero)))
    res = j.withColumns(out)
    drop = [k, b] + [f"__i_{n}" for n, _, _ in parts] + [f"__p_{n}" for n, _ in over] + [f"__p_r_{c}" for c in std_cols]
    return res.drop(*drop)


def _earlier_ranges(base: DataFrame, k: str, b: str, parts: list[tuple[str, Column, str]], std_cols: Sequence[str],
                    over: list[tuple[str, str]], agg_of: Callable[[str, Column], Column]) -> DataFrame:
    """Sums over the earlier ranges of every (hot key, range)."""
    totals = (base.where("__hot")
              .groupBy(k, b)
              .agg(*[agg_of(kind, e).alias(f"__t_{n}") for n, e, kind in parts]))
    w_pre = Window.partitionBy(k).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    # Deviations of earlier buckets are taken about the mean of the key's first
    # bucket with a value, so that large values with a small spread lose nothing.
    w_key = Window.partitionBy(k).orderBy(b).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for c in std_cols:
        shift = F.col(f"__t_m_{c}") - F.first(f"__t_m_{c}", ignorenulls=True).over(w_key)
        totals = totals.withColumns({
            f"__t_r_{c}": F.first(f"__t_m_{c}", ignorenulls=True).over(w_key),
            f"__t_d1_{c}": F.col(f"__t_c_{c}") * shift,
            f"__t_d2_{c}": F.col(f"__t_c_{c}") * (F.col(f"__t_v_{c}") + shift * shift)})
    return totals.select(k, b, *[agg_of(kind, F.col(f"__t_{n}")).over(w_pre).alias(f"__p_{n}") for n, kind in over],
                               *[F.col(f"__t_r_{c}").alias(f"__p_r_{c}") for c in std_cols])


def key_frequency(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rows per key over the whole table (WN9 ``user_frequency``).

    Aggregate-and-join instead of ``count() over (partition by key)``: the
    aggregate is map-side combined, so a hot key never lands whole in one
    task; AQE broadcasts the count table at runtime when it is small and
    splits skewed join partitions otherwise.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return df.join(counts, on=key, how="left")


# --------------------------------------------------------------------------
# Reference feature sets built on ``expanding_history``
# --------------------------------------------------------------------------

def _rate(prefix: str) -> Column:
    """mean(target) over the history, 0 when undefined (fillna(0))."""
    return F.coalesce(F.try_divide(F.col(f"{prefix}_pos"), F.col(f"{prefix}_lab")), F.lit(0.0))


def history_features(df: DataFrame, specs: Sequence[tuple[str, str, bool]], *, warmup: int = 0,
                     target: str = "target") -> DataFrame:
    """Rate / count / recency history per key with the reference's names.

    ``specs``: (name, key column, with recency).  Adds
    ``{name}_hist_conversion_rate`` (0 when undefined), ``{name}_hist_count``
    and, if asked, ``{name}_recency_days`` (999 when no history).  The first
    ``warmup`` rows of the whole table keep the defaults but still count as
    history for later rows (WN5).
    """
    warm = warmup_flag(df, warmup)
    ranges = key_ranges(df, [key for _, key, _ in specs])
    cur = df
    for p, key, rec in specs:
        cur = expanding_history(cur, key, f"__h{p}", target=target, recency=rec, ranges=ranges)
    out: dict[str, Column] = {}
    for p, key, rec in specs:
        h = f"__h{p}"
        has = F.col(f"{h}_n") > 0
        out[f"{p}_hist_conversion_rate"] = F.when(warm | ~has, F.lit(0.0)).otherwise(_rate(h))
        out[f"{p}_hist_count"] = F.when(warm, F.lit(0).cast("long")).otherwise(F.col(f"{h}_n"))
        if rec:
            out[f"{p}_recency_days"] = F.when(warm | ~has, F.lit(RECENCY_DEFAULT).cast("long")).otherwise(F.col(f"{h}_recency"))
    cur = cur.withColumns(out)
    return cur.drop(*[c for c in cur.columns if c.startswith("__h")])


def rf_history(df: DataFrame, *, warmup: int = WARMUP_ROWS, line_key: str | None = "gtfs_route_id",
               user_key: str = "user_pseudo_id", stop_key: str = "gtfs_stop_id",
               target: str = "target") -> DataFrame:
    """WN1 + WN2 + WN3 + WN4 + WN5 with the random-forest script's names.

    ``user/stop/line_hist_conversion_rate``, ``user/stop/line_hist_count``,
    ``user/stop_recency_days``; the first ``warmup`` rows keep the defaults.
    The line features exist only when ``line_key`` is a column.
    """
    specs = [("user", user_key, True), ("stop", stop_key, True)]
    if line_key and line_key in df.columns:
        specs.append(("line", line_key, False))
    return history_features(df, specs, warmup=warmup, target=target)


def basic_rates(df: DataFrame, *, warmup: int = WARMUP_ROWS, user_key: str = "user_pseudo_id",
                stop_key: str = "gtfs_stop_id", target: str = "target") -> DataFrame:
    """WN8: only the user / stop history rate and count, with warm-up."""
    return rf_history(df, warmup=warmup, line_key=None, user_key=user_key, stop_key=stop_key,
                      target=target).drop("user_recency_days", "stop_recency_days")


def knn_history(df: DataFrame, *, user_key: str = "user_pseudo_id", stop_key: str = "gtfs_stop_id",
                target: str = "target", hour_col: str = "hour", dist_col: str = "dist_device_stop",
                freq_col: str = "user_frequency") -> DataFrame:
    """WN6 + WN7 with the k-NN script's names (warm-up = first row only).

    user: ``user_hist_events``, ``user_hist_conversions``,
    ``user_hist_conversion_rate``, ``user_avg_hour_hist``,
    ``user_avg_dist_hist``, ``user_std_dist_hist``; stop:
    ``stop_hist_events``, ``stop_hist_conversions``,
    ``stop_hist_conversion_rate``, ``stop_avg_freq_hist``.
    Defaults are 0 when there is no history; the std is NULL when exactly one
    prior distance exists (pandas ddof=1), as in the reference.
    """
    has_dist = dist_col in df.columns
    has_freq = freq_col in df.columns
    ranges = key_ranges(df, [user_key, stop_key])
    u = expanding_history(df, user_key, "__ku", target=target, recency=False, ranges=ranges,
                          mean_cols=[hour_col] + ([dist_col] if has_dist else []),
                          std_cols=[dist_col] if has_dist else [])
    s = expanding_history(u, stop_key, "__ks", target=target, recency=False, ranges=ranges,
                          mean_cols=[freq_col] if has_freq else [])
    warm = warmup_flag(df, 1)
    zero = F.lit(0.0)

    def feat(prefix: str, e: Column) -> Column:
        return F.when(warm | (F.col(f"{prefix}_n") == 0), zero).otherwise(e)

    out = {
        "user_hist_events": feat("__ku", F.col("__ku_n").cast("double")),
        "user_hist_conversions": feat("__ku", F.coalesce(F.col("__ku_pos"), zero)),
        "user_hist_conversion_rate": feat("__ku", F.try_divide(F.col("__ku_pos"), F.col("__ku_lab"))),
        "user_avg_hour_hist": feat("__ku", F.col(f"__ku_mean_{hour_col}")),
        "stop_hist_events": feat("__ks", F.col("__ks_n").cast("double")),
        "stop_hist_conversions": feat("__ks", F.coalesce(F.col("__ks_pos"), zero)),
        "stop_hist_conversion_rate": feat("__ks", F.try_divide(F.col("__ks_pos"), F.col("__ks_lab"))),
    }
    if has_dist:
        out["user_avg_dist_hist"] = feat("__ku", F.col(f"__ku_mean_{dist_col}"))
        out["user_std_dist_hist"] = feat("__ku", F.col(f"__ku_std_{dist_col}"))
    if has_freq:
        out["stop_avg_freq_hist"] = feat("__ks", F.col(f"__ks_mean_{freq_col}"))
    res = s.withColumns(out)
    return res.drop(*[c for c in res.columns if c.startswith("__k")])


def lgbm_expanding(df: DataFrame, **kw) -> DataFrame:
    """WN10: the boosted-tree report's expanding features, as aliases of WN6.

    ``user_conversion_rate_expanding``, ``user_avg_hour_expanding``,
    ``user_std_dist_expanding``, ``user_stop_affinity_expanding``
    (= prior user events x prior stop events).
    """
    h = knn_history(df, **kw)
    return h.select(
        *df.columns,
        F.col("user_hist_conversion_rate").alias("user_conversion_rate_expanding"),
        F.col("user_avg_hour_hist").alias("user_avg_hour_expanding"),
        F.col("user_std_dist_hist").alias("user_std_dist_expanding"),
        (F.col("user_hist_events") * F.col("stop_hist_events")).alias("user_stop_affinity_expanding"),
    )
