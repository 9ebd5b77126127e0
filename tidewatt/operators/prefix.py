"""Running totals and ranks over groups of any size.

A running frame over a huge group would be one task. The group is cut into bands: a band is
a coarse, order-preserving value of the leading sort column (a price step, a day). Rows are
shuffled by (keys, band); what lies before a band comes from one total per band. The bands
of a group are few whatever its size, as their number depends on the value range only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.session import scratch_path


def _carry(df, keys, measure: Column, descending: bool) -> DataFrame:
    """Sum of `measure` over all earlier bands, per band."""
    totals = df.groupBy(*keys, "_band").agg(measure.alias("_total"))
    first = F.col("_band").desc() if descending else F.col("_band").asc()
    earlier = (
        Window.partitionBy(*keys).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *keys, "_band", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_carry")
    )


def _before() -> Column:
    return F.coalesce("_carry", F.lit(0))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    band: Column,
    out: str,
    descending: bool = False,
) -> DataFrame:
    """SUM(value) from the first row of the group up to each row, in a total `order`.

    Band must rise (or fall, if descending) with the order. Keys and band should not be null:
    rows where they are stay in the result but count from their own band only.
    """
    keys = list(keys)
    banded = df.withColumn("_band", band)
    inside = (
        Window.partitionBy(*keys, "_band").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = banded.withColumn("_local", F.sum(value).over(inside))
    joined = local.join(_carry(banded, keys, F.sum(value), descending), [*keys, "_band"], "left")
    return joined.select(*df.columns, (F.col("_local") + _before()).alias(out))


def running_sum_ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """SUM(value) from the first row of the group up to each row, in ascending `order`, for groups of any size and distribution.

    Bands are the ranges of a range partitioning by keys and order, whose bounds Spark samples, so they hold about the same
    number of rows whatever the values are. The ordered rows are written once to the shared folder, because the bounds
    of a second sampling would differ. Columns of `order` may hold nulls, which come first; rows that are equal in all of
    them follow each other in any order.
    """
    keys, order = list(keys), list(order)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "running")
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    ranged.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_band", F.shiftright("_id", 33))
    inside = Window.partitionBy(*keys, "_band").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_local", F.sum(value).over(inside))
    carried = _carry(rows, keys, F.sum(value), False)
    on = local["_band"] == carried["_band"]
    for k in keys:
        on = on & local[k].eqNullSafe(carried[k])
    joined = local.join(carried, on, "left").select(*[local[c] for c in df.columns], "_local", "_carry")
    return joined.select(*df.columns, (F.coalesce("_local", F.lit(0)) + _before()).alias(out))


def _ranked(df, keys, order, band, out, fn, descending):
    keys = list(keys)
    banded = df.withColumn("_band", band)
    local = banded.withColumn("_local", fn().over(Window.partitionBy(*keys, "_band").orderBy(*order)))
    joined = local.join(_carry(banded, keys, F.count(F.lit(1)), descending), [*keys, "_band"], "left")
    return joined.select(*df.columns, (F.col("_local") + _before()).cast("long").alias(out))


def position(df, keys, order, band, out, descending=False) -> DataFrame:
    """ROW_NUMBER kept as a column, for groups of any size."""
    return _ranked(df, keys, order, band, out, F.row_number, descending)


def rank(df, keys, order, band, out, descending=False) -> DataFrame:
    """RANK (ties share a rank), for groups of any size. Peers must share a band."""
    return _ranked(df, keys, order, band, out, F.rank, descending)
