"""Calendar scalar functions (SC4-SC11, SC13, SC14, SC28).

All are column expressions (whole-stage codegen); nothing runs in Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.semantics import col, cut_right_closed

# Fixed values of the reference.
TIME_PERIOD_EDGES = [0, 6, 9, 12, 14, 17, 19, 24]       # pd.cut, right-closed, labels 0..6
CYCLE_PERIODS = {"hour": 24, "day_of_week": 7, "month": 12, "day_of_month": 31, "week_of_year": 52}
PEAK_CENTERS = (8, 18)
RECENCY_BIN_EDGES = [0, 1, 3, 7, 30, 999]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def tz_convert(ts: str | Column, tz: str = "America/Sao_Paulo") -> Column:
    """SC4: UTC instant -> local wall time of ``tz``."""
    return F.from_utc_timestamp(col(ts), tz)


def date_parts(df: DataFrame, ts: str = "event_timestamp", names: dict[str, str] | None = None) -> DataFrame:
    """SC5: hour, weekday (Monday=0), day, month, year, minute, ISO week,
    day name and date.  ``names`` maps part -> output column (subset)."""
    t = F.col(ts)
    exprs = {
        "hour": F.hour(t),
        "day_of_week": F.weekday(t),
        "day_of_month": F.dayofmonth(t),
        "month": F.month(t),
        "year": F.year(t),
        "minute": F.minute(t),
        "week_of_year": F.weekofyear(t),
        "day_name": F.date_format(t, "EEEE"),
        "date": F.to_date(t),
    }
    names = names or {p: p for p in exprs}
    return df.withColumns({out: exprs[p] for p, out in names.items()})


def cyclic(x: str | Column, period: float) -> tuple[Column, Column]:
    """SC10: (sin, cos) of 2*pi*x/period."""
    a = F.lit(2 * math.pi) * col(x) / F.lit(float(period))
    return F.sin(a), F.cos(a)


def with_cyclic(df: DataFrame, spec: dict[str, tuple[str, float]]) -> DataFrame:
    """``spec``: output prefix -> (column, period); adds ``{p}_sin``, ``{p}_cos``."""
    out = {}
    for p, (c, period) in spec.items():
        s, co = cyclic(c, period)
        out[f"{p}_sin"], out[f"{p}_cos"] = s, co
    return df.withColumns(out)


def is_weekend(dow: str | Column) -> Column:
    """SC7: weekday (Monday=0) >= 5."""
    return (col(dow) >= 5).cast("int")


def is_peak_hour(h: str | Column) -> Column:
    """SC8: 6 <= h < 9 or 17 <= h < 19."""
    x = col(h)
    return (((x >= 6) & (x < 9)) | ((x >= 17) & (x < 19))).cast("int")


def period_flags(h: str | Column) -> dict[str, Column]:
    """SC9: morning 6-9, evening 17-19, lunch 11-14 (inclusive), night >=22 or <=5."""
    x = col(h)
    return {
        "is_morning_peak": x.between(6, 9).cast("int"),
        "is_evening_peak": x.between(17, 19).cast("int"),
        "is_lunch_time": x.between(11, 14).cast("int"),
        "is_night": ((x >= 22) | (x <= 5)).cast("int"),
    }


def time_period(h: str | Column) -> Column:
    """SC11: ``pd.cut(hour, [0,6,9,12,14,17,19,24], right=True)`` as double;
    hour 0 falls outside the first bin and is NULL."""
    return cut_right_closed(h, TIME_PERIOD_EDGES).cast("double")


def distance_from_peak(h: str | Column) -> Column:
    """SC13: min(|h-8|, |h-18|)."""
    x = col(h)
    return F.least(F.abs(x - PEAK_CENTERS[0]), F.abs(x - PEAK_CENTERS[1]))


def weekend_peak(dow: str | Column, h: str | Column) -> Column:
    """SC28: weekend and peak hour."""
    return (is_weekend(dow) * is_peak_hour(h)).cast("int")


def recency_bin(days: str | Column) -> Column:
    """SC28: recency bins [0,1,3,7,30,999] right-closed, labels 0..4."""
    return cut_right_closed(days, RECENCY_BIN_EDGES).cast("int")
