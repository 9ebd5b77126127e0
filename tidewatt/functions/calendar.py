"""Calendar expressions and period sequences."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yyyymm(day: str | Column) -> Column:
    return F.date_format(_column(day), "yyyyMM")


def month_start(ym: str | Column) -> Column:
    """First day of a YYYYMM string."""
    return F.to_date(F.concat(_column(ym), F.lit("01")), "yyyyMMdd")


def shift_month(ym: str | Column, months: int) -> Column:
    return yyyymm(F.add_months(month_start(ym), months))


def iso_weekday(day: str | Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(_column(day)) + 1


def season(day: str | Column) -> Column:
    """Southern-hemisphere meteorological season."""
    m = F.month(_column(day))
    return (
        F.when(m.isin(12, 1, 2), "Summer")
        .when(m.isin(3, 4, 5), "Autumn")
        .when(m.isin(6, 7, 8), "Winter")
        .when(m.isin(9, 10, 11), "Spring")
    )


def season_year(day: str | Column) -> Column:
    """December counts towards the summer of the next year."""
    d = _column(day)
    return F.year(d) + F.when(F.month(d) == 12, 1).otherwise(0)


def period_start(day: str | Column, period: str | Column) -> Column:
    """Local start of a half-hour trading period, without any time-zone shift."""
    minutes = (_column(period) - 1) * 30
    return F.timestamp_add("MINUTE", minutes, _column(day).cast("timestamp_ntz"))


def period_second(day: str | Column, period: str | Column) -> Column:
    """The same instant as whole seconds since 1970-01-01 local."""
    days = F.datediff(_column(day), F.lit(date(1970, 1, 1))).cast("long")
    return days * 86400 + (_column(period).cast("long") - 1) * 1800


def wall_second(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a zone-less timestamp, independent of the session zone."""
    t = _column(ts)
    days = F.datediff(t.cast("date"), F.lit(date(1970, 1, 1))).cast("long")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def half_hour(ts: str | Column) -> Column:
    """Trading period 1..48 of a timestamp."""
    t = _column(ts)
    return F.hour(t) * 2 + F.floor(F.minute(t) / 30).cast("int") + 1


def date_spine(spark: SparkSession, start: date, end: date, name: str = "date_day") -> DataFrame:
    """One row per day of the half-open range [start, end)."""
    days = F.sequence(F.lit(start), F.date_sub(F.lit(end), 1))
    none = F.array().cast("array<date>")
    return spark.range(1).select(F.explode(F.when(F.lit(start < end), days).otherwise(none)).alias(name))


def month_spine(spark: SparkSession, first: str, last: str, name: str = "period") -> DataFrame:
    """One YYYYMM row per month, both ends included."""
    months = F.sequence(
        month_start(F.lit(first)), month_start(F.lit(last)), F.expr("INTERVAL 1 MONTH")
    )
    none = F.array().cast("array<date>")
    return spark.range(1).select(
        F.explode(F.when(F.lit(first <= last), months).otherwise(none)).alias("_d")
    ).select(yyyymm("_d").alias(name))


def last_complete_month(as_of: str | Column) -> Column:
    return yyyymm(F.add_months(_column(as_of), -1))


def months_back(end_ym: str | Column, n: int) -> Column:
    """First month of the inclusive window of n months ending at end_ym."""
    return shift_month(end_ym, 1 - n)


def complete_days(spark: SparkSession, ym: str, as_of: date, name: str = "period") -> DataFrame:
    """Days of a month that are over by as_of."""
    first = month_start(F.lit(ym))
    return (
        spark.range(1)
        .select(F.explode(F.sequence(first, F.last_day(first))).alias(name))
        .filter(F.col(name) < F.lit(as_of))
    )
