"""Wide-to-long and long-to-wide reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_periods(
    df: DataFrame,
    ids: Sequence[str | Column],
    periods: int = 50,
    prefix: str = "tp",
    period: str = "tp_number",
    value: str = "value",
) -> DataFrame:
    """One row per filled period column; empty cells of short days drop out."""
    return _melt_periods(df, ids, periods, prefix, period, value).filter(F.col(value).isNotNull())


def unpivot_missing(
    df: DataFrame,
    ids: Sequence[str | Column],
    periods: int = 46,
    prefix: str = "tp",
    period: str = "tp_number",
    value: str = "value",
) -> DataFrame:
    """The opposite: periods every day must have, yet null or blank here."""
    long = _melt_periods(df, ids, periods, prefix, period, value)
    return long.filter(F.col(value).isNull() | (F.col(value) == "")).drop(value)


def _melt_periods(df, ids, periods, prefix, period, value):
    cells = [f"{prefix}{i}" for i in range(1, periods + 1)]
    long = df.unpivot(list(ids), cells, "_cell", value)
    number = F.substring("_cell", len(prefix) + 1, 3).cast("int")
    return long.withColumn(period, number).drop("_cell")


def melt_sum(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str, value: str) -> DataFrame:
    """Stack several measures and total them per id and measure name; nulls count as zero."""
    long = df.unpivot(list(ids), list(measures), name, "_v")
    return long.groupBy(*ids, name).agg(F.sum(F.coalesce("_v", F.lit(0))).alias(value))


def pivot_filled(
    df: DataFrame,
    row: Sequence[str] | str,
    column: str,
    labels: dict,
    measure: Column,
    fill: float | None = 0.0,
) -> DataFrame:
    """Matrix with a fixed column set {value: label}; absent cells take `fill`.

    The value list is always given, so no extra pass has to discover it.
    """
    rows = [row] if isinstance(row, str) else list(row)
    wide = df.groupBy(*rows).pivot(column, list(labels)).agg(measure)
    named = [F.col(f"`{v}`").alias(label) for v, label in labels.items()]
    out = wide.select(*rows, *named)
    return out if fill is None else out.fillna(fill, subset=list(labels.values()))
