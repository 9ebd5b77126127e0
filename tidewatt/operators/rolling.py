"""Trailing-window statistics that never put a whole series into one task.

Spark runs a window partition in a single task and re-aggregates a sliding frame row by
row, so a 30-day frame over one busy series is both skewed and quadratic. Here a series is
cut into slices; a slice is one shuffle group. A trailing frame is then the tail of an
older slice, whole slices in between, and the head of the row's own slice. Head and tail
are running frames (one pass), whole slices are folded from one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400
_FIELDS = "n mean m2 lo hi".split()


def _moments(x: Column, name: str, window=None) -> list[Column]:
    """Count, mean, sum of squared deviations and range of x as columns {name}_n, {name}_mean, ..."""

    def agg(fn):
        return fn(x) if window is None else fn(x).over(window)

    n = agg(F.count)
    values = [n, agg(F.avg), agg(F.var_pop) * n, agg(F.min), agg(F.max)]
    return [v.alias(f"{name}_{f}") for v, f in zip(values, _FIELDS)]


def _combine(df: DataFrame, unions: dict[str, Sequence[str]]) -> DataFrame:
    """Moments of unions of disjoint parts, {name: parts}; a part without rows may be null.

    The mean comes first, deviations are taken from it: no cancellation of large squares.
    """
    zero = F.lit(0.0)

    def count(p):
        return F.coalesce(F.col(f"{p}_n"), F.lit(0))

    counts, means, rest = {}, {}, {}
    for name, parts in unions.items():
        total = sum((count(p) for p in parts[1:]), count(parts[0]))
        weighted = [count(p) * F.coalesce(F.col(f"{p}_mean"), zero) for p in parts]
        spread = [
            F.coalesce(F.col(f"{p}_m2"), zero)
            + count(p) * F.coalesce(F.pow(F.col(f"{p}_mean") - F.col(f"{name}_mean"), 2), zero)
            for p in parts
        ]
        counts[f"{name}_n"] = total
        means[f"{name}_mean"] = sum(weighted[1:], weighted[0]) / F.nullif(
            F.col(f"{name}_n").cast("double"), zero
        )
        rest[f"{name}_m2"] = sum(spread[1:], spread[0])
        rest[f"{name}_lo"] = F.least(*[F.col(f"{p}_lo") for p in parts])
        rest[f"{name}_hi"] = F.greatest(*[F.col(f"{p}_hi") for p in parts])
    return df.withColumns(counts).withColumns(means).withColumns(rest)


def _mean(m: str) -> Column:
    # Equal extremes mean a constant frame, where the value itself is the exact mean.
    return F.when(F.col(f"{m}_lo") == F.col(f"{m}_hi"), F.col(f"{m}_lo")).otherwise(F.col(f"{m}_mean"))


def _stddev(m: str) -> Column:
    n = F.col(f"{m}_n")
    return (
        F.when(n < 2, None)
        .when(F.col(f"{m}_lo") == F.col(f"{m}_hi"), 0.0)
        .otherwise(F.sqrt(F.col(f"{m}_m2") / (n - 1)))
    )


def day_moments(df: DataFrame, keys: Sequence[str], second: Column, value: str) -> DataFrame:
    """One row per key and day: count, mean, squares and range of value. Days of separate loads are simply put together."""
    rows = df.withColumn("_day", F.floor(second / DAY))
    return rows.groupBy(*keys, "_day").agg(*_moments(F.col(value), "_d"))


def trailing_days(
    df: DataFrame,
    keys: Sequence[str],
    second: Column,
    value: str,
    mean: str,
    stddev: str,
    days: int = 30,
    kept: DataFrame | None = None,
    since: int | None = None,
) -> DataFrame:
    """AVG and STDDEV_SAMP of `value` over [t - days, t - 1 second] per key.

    `second` is the event time in whole seconds. Slices are days: after trading-period
    deduplication a key has at most 50 rows a day, however long its series is.

    A refresh gives kept, the day_moments of all days saved before and of the new ones, and since, the first day (in days
    of the epoch) to compute; df then needs no rows before since - days, and only rows from since on come out.
    """
    keys = list(keys)
    x = F.col(value)
    rows = df.withColumn("_at", second).withColumn("_day", F.floor(F.col("_at") / DAY))
    rows = rows.withColumn("_tod", F.col("_at") - F.col("_day") * DAY).drop("_at")

    # One row per key and day. Days are folded around the key's own mean, so that squares stay
    # small; a frame holds at most days - 1 of these rows.
    daily = kept if kept is not None else day_moments(df, keys, second, value)
    series = Window.partitionBy(*keys)
    between = series.orderBy("_day").rangeBetween(1 - days, -1)
    centre = F.sum(F.col("_d_n") * F.col("_d_mean")).over(series) / F.nullif(
        F.sum("_d_n").over(series), F.lit(0)
    )
    daily = daily.withColumn("_c", centre).withColumn("_off", F.col("_d_mean") - F.col("_c"))
    n, off = F.sum("_d_n").over(between), F.sum(F.col("_d_n") * F.col("_off")).over(between)
    square = F.sum(F.col("_d_m2") + F.col("_d_n") * F.col("_off") * F.col("_off")).over(between)
    mean_off = off / F.nullif(n, F.lit(0))
    whole = daily.select(
        *keys,
        "_day",
        n.alias("_whole_n"),
        (F.col("_c") + mean_off).alias("_whole_mean"),
        F.greatest(square - off * mean_off, F.lit(0.0)).alias("_whole_m2"),
        F.min("_d_lo").over(between).alias("_whole_lo"),
        F.max("_d_hi").over(between).alias("_whole_hi"),
    )

    # Every row also visits the day it leaves the frame, as a copy without payload.
    payload = [c for c in rows.columns if c not in {*keys, "_day", "_tod", value}]
    copies = rows.withColumn("_shift", F.explode(F.array(F.lit(0), F.lit(days))))
    if since is not None:
        copies = copies.filter(F.col("_day") + F.col("_shift") >= since)
    own = F.col("_shift") == 0
    copies = copies.select(
        *keys,
        value,
        "_tod",
        (F.col("_day") + F.col("_shift")).alias("_day"),
        own.alias("_own"),
        *[F.when(own, F.col(c)).alias(c) for c in payload],
    )
    head = (
        Window.partitionBy(*keys, "_day").orderBy("_tod")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    tail = (
        Window.partitionBy(*keys, "_day").orderBy(F.col("_tod").desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    framed = copies.select(
        "*",
        *_moments(F.when(F.col("_own"), x), "_head", head),
        *_moments(F.when(~F.col("_own"), x), "_tail", tail),
    ).filter("_own")
    joined = framed.join(whole, [*keys, "_day"], "left")
    out = _combine(joined, {"_m": ["_tail", "_whole", "_head"]})
    return out.select(*df.columns, _mean("_m").alias(mean), _stddev("_m").alias(stddev))


def trailing_rows(
    df: DataFrame,
    keys: Sequence[str],
    slice_by: str,
    order: Sequence[str],
    measures: dict[str, tuple[str, str]],
    previous: dict[str, str] | None = None,
    n: int = 336,
) -> DataFrame:
    """Statistics over the n rows before the current one, and the row just before it.

    measures maps an output name to (column, "avg" | "stddev"); previous maps an output name
    to the column to lag by one. `slice_by` (a day, say) with `order` inside it gives the row
    order; a slice must be small enough for one task.

    Rows get their position in the series from per-slice counts. With blocks of n positions
    the frame of any row is the tail of the previous block plus the head of its own.
    """
    keys = list(keys)
    in_slice = Window.partitionBy(*keys, slice_by).orderBy(*order)
    before = (
        Window.partitionBy(*keys).orderBy(slice_by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = (
        df.groupBy(*keys, slice_by).agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, slice_by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    rows = (
        df.withColumn("_r", F.row_number().over(in_slice))
        .join(start, [*keys, slice_by], "left")
        .withColumn("_pos", F.coalesce("_start", F.lit(0)) + F.col("_r") - 1)
        .drop("_r", "_start")
    )

    used = {c for c, _ in measures.values()} | set((previous or {}).values())
    payload = [c for c in df.columns if c not in {*keys, *used}]
    copies = rows.withColumn("_shift", F.explode(F.array(F.lit(0), F.lit(1))))
    own = F.col("_shift") == 0
    copies = copies.select(
        *keys,
        *used,
        "_pos",
        (F.floor(F.col("_pos") / n) + F.col("_shift")).alias("_block"),
        (F.col("_pos") % n).alias("_slot"),
        own.alias("_own"),
        *[F.when(own, F.col(c)).alias(c) for c in payload],
    )
    block = Window.partitionBy(*keys, "_block")
    by_pos = block.orderBy("_pos")
    head = by_pos.rowsBetween(Window.unboundedPreceding, -1)
    tail = (
        block.orderBy(F.col("_slot").desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sources = sorted({c for c, _ in measures.values()})
    framed = copies.select(
        "*",
        *[F.lag(c).over(by_pos).alias(out) for out, c in (previous or {}).items()],
        *[m for c in sources for m in _moments(F.when(F.col("_own"), F.col(c)), f"_head_{c}", head)],
        *[m for c in sources for m in _moments(F.when(~F.col("_own"), F.col(c)), f"_tail_{c}", tail)],
    ).filter("_own")
    framed = _combine(framed, {f"_m_{c}": [f"_tail_{c}", f"_head_{c}"] for c in sources})
    finish = {"avg": _mean, "stddev": _stddev}
    return framed.select(
        *df.columns,
        *(previous or {}),
        *[finish[kind](f"_m_{c}").alias(out) for out, (c, kind) in measures.items()],
    )
