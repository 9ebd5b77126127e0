"""Aggregate building blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.session import scratch_path


def sum_where(condition: Column, value: str | Column) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, v).otherwise(F.lit(0)))


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def avg_where(condition: Column, value: str | Column) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.avg(F.when(condition, v))


def sums_up_to(price: str, amount: str, limits: Sequence[int], prefix: str) -> list[Column]:
    """Cumulative buckets: amount at or below each limit."""
    return [
        sum_where(F.col(price) <= F.lit(float(limit)), amount).alias(f"{prefix}{limit}")
        for limit in limits
    ]


def rate(condition: Column) -> Column:
    """Mean of a boolean; nulls stay out of both counts."""
    return F.avg(condition.cast("double"))


def weighted_avg(value: str, weight: str) -> Column:
    w = F.sum(weight)
    return F.when(w != 0, F.sum(F.col(weight) * F.col(value)) / w)


# Rows of a group that one ordered pass of median may hold, and the steps of the sketches that narrow to them.
MEDIAN_ROWS = 100_000
MEDIAN_STEPS = 1000


def median(df: DataFrame, keys: Sequence[str], value: str, out: str, most: int = MEDIAN_ROWS) -> DataFrame:
    """Exact median per group; no task orders more than about `most` rows of a group, whatever its size.

    A bracket around the middle is narrowed until few rows are left in it: a mergeable quantile sketch of the rows inside
    gives MEDIAN_STEPS steps, and the steps next to the middle, ten times the sketch's rank error away, are the next
    bracket. Each pass leaves a few thousandths of the rows (three passes for 10^12). Rows outside are only counted, and
    equal values inside are one row, so many repeats of the middle end the narrowing as well.
    """
    keys = list(keys)
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    present = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    below = F.coalesce(v < lo, F.lit(False))
    inside = ~below & F.coalesce(v <= hi, F.lit(True))
    brackets = present.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    brackets = brackets.withColumns({c: F.lit(None).cast("double") for c in ("_lo", "_hi")})
    while True:
        tagged = _with_bracket(present, brackets, keys)
        held = tagged.groupBy(*keys).agg(
            F.count_if(below).alias("_below"), F.count_if(inside).alias("_inside"), F.count("*").alias("_n"),
            F.min(F.when(inside, v)).alias("_least"), F.max(F.when(inside, v)).alias("_largest"))
        wide = held.filter((F.col("_inside") > most) & (F.col("_least") < F.col("_largest")))
        if wide.limit(1).count() == 0:
            break
        cuts = tagged.filter(inside).groupBy(*keys).agg(F.percentile_approx(
            "_v", F.array(*[F.lit(i / MEDIAN_STEPS) for i in range(MEDIAN_STEPS + 1)]), 10 * MEDIAN_STEPS).alias("_cuts"))
        placed = _null_safe_join(held, cuts, keys) if keys else held.withColumn("_cuts", cuts.scalar())
        # Ranks of the middle rows among those inside, as steps.
        low, high = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
        step = lambda r: F.floor(MEDIAN_STEPS * (r - F.col("_below")) / F.col("_inside")).cast("int")
        at = lambda i: F.element_at("_cuts", F.greatest(F.least(i + 1, F.lit(MEDIAN_STEPS + 1)), F.lit(1)))
        narrowed = placed.select(*keys, at(step(low) - 1).alias("_lo"), at(step(high) + 2).alias("_hi"))
        before = brackets
        brackets = stored_brackets(narrowed, before)
    side = F.when(below, -1).when(inside, 0).otherwise(1)
    # One row per distinct value inside the bracket, one row for each side outside it.
    steps = tagged.groupBy(*keys, side.alias("_side"), F.when(inside, v).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*keys)
    running = group.orderBy("_side", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = steps.select(
        *keys,
        "_side",
        "_v",
        F.sum("_c").over(running).alias("_last"),
        (F.sum("_c").over(running) - F.col("_c") + 1).alias("_first"),
        F.sum("_c").over(group).alias("_n"),
    )
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)

    def found(r):
        hit = (F.col("_side") == 0) & (F.col("_first") <= r) & (F.col("_last") >= r)
        return F.max(F.when(hit, F.col("_v")))

    return placed.groupBy(*keys).agg(((found(low) + found(high)) / 2).alias(out))


def stored_brackets(narrowed: DataFrame, before: DataFrame) -> DataFrame:
    """The next brackets, one row per group, cut off from the passes that made them."""
    spark = narrowed.sparkSession
    path = scratch_path(spark, "median")
    narrowed.select(*before.columns).write.parquet(path)
    return spark.read.schema(before.schema).parquet(path)


def _with_bracket(rows: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        return _null_safe_join(rows, brackets, keys)
    one = brackets.first()
    return rows.withColumns({c: F.lit(one[c] if one else None).cast("double") for c in ("_lo", "_hi")})


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, on, "left").drop(*[f"_r_{k}" for k in keys])


def mode(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Most frequent value; the smallest on a tie."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.col(count).desc(), F.col(column).asc_nulls_last()).limit(1)


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal-width bins between the overall minimum and maximum.

    The top value falls into the last bin; the limits are one-row scalar subqueries.
    """
    present = df.filter(F.col(value).isNotNull())
    lo = present.agg(F.min(value).cast("double")).scalar()
    hi = present.agg(F.max(value).cast("double")).scalar()
    v = F.col(value).cast("double")
    boxed = present.withColumn("_lo", lo).withColumn("_hi", hi)
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    slot = F.when(F.col("_hi") == F.col("_lo"), 1).otherwise(
        F.least(F.floor((v - F.col("_lo")) / F.nullif(width, F.lit(0.0))) + 1, F.lit(bins))
    )
    return boxed.groupBy(*by, slot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def share_of_total(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Percentage of the group total per row; the total is aggregated, not windowed."""
    group = list(group)
    totals = df.groupBy(*group).agg(F.sum(value).cast("double").alias("_total"))
    joined = df.join(totals, group, "left")
    pct = F.when(F.col("_total") != 0, F.col(value).cast("double") / F.col("_total") * 100.0)
    return joined.select(*df.columns, pct.alias(out))
