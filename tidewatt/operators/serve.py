"""Filters, orderings and top-n cuts used when results are read."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_slice(df: DataFrame, column: str, start: date | None = None, end: date | None = None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end))
    return df


def month_slice(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive YYYYMM range; a reversed range is swapped."""
    if start and end and start > end:
        start, end = end, start
    if start:
        df = df.filter(F.col(column) >= start)
    if end:
        df = df.filter(F.col(column) <= end)
    return df


def keep_values(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """IN-list; no list or an empty one keeps everything."""
    return df.filter(F.col(column).isin(*values)) if values else df


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Global top n; Spark keeps n rows per task (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def optional_limit(df: DataFrame, n: int | None) -> DataFrame:
    return df if n is None else df.limit(max(1, int(n)))


def seeded_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """A repeatable pseudo-random choice of n rows: those whose seeded key digest sorts first."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(digest, *[F.col(k) for k in keys]).limit(n)
