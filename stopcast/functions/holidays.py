"""Holiday dimension (JN8): Brazilian national + São Paulo state holidays.

Generated per year from the years present in the data, so it never needs a
table: fixed dates plus Good Friday from the Gregorian Easter computus
(Meeus/Jones/Butcher), all in integer column arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (month, day, first year, name).  National: New Year,
# Tiradentes, Labour Day, Independence, Our Lady Aparecida, All Souls,
# Republic, Black Consciousness (national from 2024), Christmas; state (SP):
# Constitutionalist Revolution.  Movable: Good Friday = Easter - 2 days.
FIXED_HOLIDAYS = [
    (1, 1, 0, "Confraternização Universal"),
    (4, 21, 0, "Tiradentes"),
    (5, 1, 0, "Dia do Trabalhador"),
    (7, 9, 0, "Revolução Constitucionalista de 1932"),
    (9, 7, 0, "Independência do Brasil"),
    (10, 12, 0, "Nossa Senhora Aparecida"),
    (11, 2, 0, "Finados"),
    (11, 15, 0, "Proclamação da República"),
    (11, 20, 2024, "Dia Nacional de Zumbi e da Consciência Negra"),
    (12, 25, 0, "Natal"),
]
GOOD_FRIDAY_OFFSET = -2


def easter_date(y: Column) -> Column:
    """Gregorian Easter Sunday of year ``y`` (integer column)."""
    a = y % 19
    b = F.floor(y / 100)
    c = y % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    ll = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * ll) / 451)
    month = F.floor((h + ll - 7 * m + 114) / 31)
    day = ((h + ll - 7 * m + 114) % 31) + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def holiday_dim(years: DataFrame, year_col: str = "year") -> DataFrame:
    """(holiday_date, holiday_name) for every year row in ``years``."""
    fixed = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(y0).alias("y0"), F.lit(n).alias("n"))
                      for m, d, y0, n in FIXED_HOLIDAYS])
    y = F.col(year_col).cast("int")
    f = (years.select(y.alias("__y"), F.explode(fixed).alias("__h"))
              .where(F.col("__y") >= F.col("__h.y0"))
              .select(F.make_date("__y", F.col("__h.m"), F.col("__h.d")).alias("holiday_date"),
                      F.col("__h.n").alias("holiday_name")))
    gf = years.select(F.date_add(easter_date(y), GOOD_FRIDAY_OFFSET).alias("holiday_date"),
                      F.lit("Sexta-feira Santa").alias("holiday_name"))
    return f.unionByName(gf).dropDuplicates(["holiday_date"])


def is_holiday(df: DataFrame, ts: str = "event_timestamp", out: str = "is_holiday") -> DataFrame:
    """JN8: 1 when the local date of ``ts`` is a holiday, else 0.

    The dimension has at most 11 rows per distinct year of the data (a
    proven bound), so it is broadcast."""
    years = df.select(F.year(ts).alias("year")).where(F.col("year").isNotNull()).distinct()
    dim = F.broadcast(holiday_dim(years).select(F.col("holiday_date").alias("__hd")))
    j = df.join(dim, on=F.to_date(F.col(ts)) == F.col("__hd"), how="left")
    return j.withColumn(out, F.col("__hd").isNotNull().cast("int")).drop("__hd")
