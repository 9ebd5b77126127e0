"""Latest-row selection and duplicate reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in `order`, which should end in a total tie-break.

    The rank filter lets Spark keep one row per key in every map task before the
    shuffle (WindowGroupLimit), so a key with a third of all rows ships one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def newest_value_per_key(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Per column, its value in the last row of the group where it is present."""
    picks = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns
    ]
    return df.groupBy(*keys).agg(*picks)
