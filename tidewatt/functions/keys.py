"""Surrogate and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a hashed key, so keys equal those already published.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the '-'-joined string forms of the columns."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in columns
    ]
    return F.md5(F.concat_ws("-", *parts))


def date_key(day: str | Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
