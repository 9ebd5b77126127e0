"""Lookback windows and incremental refresh."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.functions.calendar import yyyymm
from tidewatt.session import staged
from tidewatt.sources import sinks
from tidewatt.sources.files import read_or_empty

EPOCH = date(1900, 1, 1)


def lookback_start(target: DataFrame, column: str, days: int) -> date:
    """First day to process again. One value comes back, so that Spark prunes by a literal."""
    newest = target.agg(F.max(column)).first()[0]
    return (newest or EPOCH) - timedelta(days=days)


def lookback_filter(source: DataFrame, target: DataFrame, column: str, days: int) -> DataFrame:
    return source.filter(F.col(column) >= F.lit(lookback_start(target, column, days)))


def month_lookback_start(target: DataFrame, column: str) -> str:
    """The month before the newest one; the beginning of time for an empty target."""
    newest = target.agg(F.max(column)).first()[0]
    if newest is None:
        return "000000"
    return _month_before(newest)


def month_lookback_filter(
    source: DataFrame, target: DataFrame, source_column: str, target_column: str
) -> DataFrame:
    return source.filter(F.col(source_column) >= month_lookback_start(target, target_column))


@dataclass(frozen=True)
class Incremental:
    """Key and time column of an incrementally maintained table."""

    keys: tuple[str, ...]
    column: str  # a date, or a YYYYMM string
    monthly: bool = False
    source_column: str | None = None


_TP = ("poc_code", "trading_date", "tp_number")
TABLES = {
    "fct_price": Incremental(_TP, "trading_date"),
    "fct_market_volume": Incremental(_TP, "trading_date"),
    "mart_generation_daily": Incremental(("trading_date", "fuel_type"), "trading_date"),
    "mart_generation_monthly": Incremental(("year_month", "fuel_type"), "year_month", True, "trading_month"),
    "mart_plant_ranking": Incremental(("year_month", "site_code"), "year_month", True, "trading_month"),
    "mart_renewable_ratio": Incremental(("year_month",), "year_month", True, "trading_month"),
    "mart_price_daily": Incremental(("poc_code", "trading_date"), "trading_date"),
    "mart_price_spike_events": Incremental(_TP, "trading_date"),
    "mart_renewable_price_impact": Incremental(_TP, "trading_date"),
}
PERIOD = "period_month"  # partition folder: the month of the row


def with_period(df: DataFrame, spec: Incremental) -> DataFrame:
    month = F.col(spec.column) if spec.monthly else yyyymm(spec.column)
    return df.withColumn(PERIOD, month)


def months_from(first_period: str | None):
    """Restricts a frame to the months from a given one on and takes the period column off; all months for None."""

    def within(df: DataFrame) -> DataFrame:
        if PERIOD not in df.columns:
            return df
        return (df if first_period is None else df.filter(F.col(PERIOD) >= first_period)).drop(PERIOD)

    return within


def _month_before(period: str) -> str:
    year, month = int(period[:4]), int(period[4:])
    return f"{year - (month == 1):04d}{(month - 2) % 12 + 1:02d}" if year else period


def refresh(
    spark: SparkSession,
    path: str,
    name: str,
    source: DataFrame,
    build,
    lookback_days: int = 3,
    exact: bool = False,
) -> None:
    """Rebuild the lookback window of table `name` at `path` from `source`.

    build(source, within) maps the filtered source to table rows; within(df) cuts any other fact it joins to the same
    months. Facts that carry the period column are pruned by it, so a refresh opens the window's folders only. A month
    of a monthly table may hold days of the file before, so one more month is read there. By default keys of the new rows replace
    their old versions and rows that are no longer produced stay, as a delete+insert does;
    exact=True clears the whole window first.
    """
    spec = TABLES[name]
    everything = months_from(None)
    target = read_or_empty(spark, path, with_period(build(everything(source), everything), spec).schema)
    column = spec.source_column or spec.column
    if spec.monthly:
        start = month_lookback_start(target, PERIOD)
        first_period = start
    else:
        # The newest folder is known without reading data; only its rows are looked at.
        newest = target.agg(F.max(PERIOD)).first()[0]
        start = lookback_start(target.filter(F.col(PERIOD) == newest), spec.column, lookback_days)
        first_period = start.strftime("%Y%m")
    within = months_from(_month_before(first_period) if spec.monthly else first_period)
    batch = with_period(build(within(source).filter(F.col(column) >= F.lit(start)), within), spec)
    if exact:
        sinks.replace_window(spark, path, batch, spec.column, start, PERIOD, first_period)
    else:
        sinks.upsert(spark, path, batch, spec.keys, PERIOD)


def changed_periods(source: DataFrame, marks: DataFrame, modified: str) -> DataFrame:
    """(PERIOD, newest) of the periods of source that are newer than their mark, or have none; and, with a null
    newest, of marked periods that the source no longer has."""
    now = source.groupBy(PERIOD).agg(F.max(modified).alias("newest"))
    both = now.join(marks.select(PERIOD, F.col("newest").alias("_mark")), PERIOD, "full_outer")
    return both.filter("_mark is null or newest is null or newest > _mark").select(PERIOD, "newest")


def refresh_changed(spark: SparkSession, path: str, source: DataFrame, build, modified: str) -> list[str]:
    """Rebuild the periods whose source files changed, however old they are; returns them.

    source carries PERIOD and the modification time of its file. build(source, within) maps the rows of those periods to
    table rows of the same periods, with PERIOD; within(df) cuts other facts to them. The table is published below
    path/table, all changed periods at once; then their marks are kept in path/marks. A failure in between refreshes the
    same periods again. Only the two columns of the source are read to find out; a period that the source no longer has,
    or that yields no row, leaves the table.
    """
    schema = T.StructType([T.StructField(PERIOD, T.StringType()), T.StructField("newest", source.schema[modified].dataType)])
    marks = read_or_empty(spark, f"{path}/marks", schema)
    changed = changed_periods(source, marks, modified)
    with staged(changed, "changed") as changed:
        # One entry per month.
        periods = sorted(r[0] for r in changed.select(PERIOD).collect())
        if not periods:
            return []
        within = lambda df: df.filter(F.col(PERIOD).isin(*periods))
        with staged(build(within(source), within), "rebuilt") as batch:
            made = {r[0] for r in batch.select(PERIOD).distinct().collect()}
            sinks.publish_periods(spark, batch, f"{path}/table", PERIOD, gone=[p for p in periods if p not in made])
        kept = marks.join(changed.select(PERIOD), PERIOD, "left_anti").unionByName(changed.filter("newest is not null"))
        with staged(kept, "marks") as kept:
            sinks.replace_all(kept, f"{path}/marks")
    return periods


def load(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at `path` with the columns of `like`; empty while nothing was written."""
    schema = T.StructType([*like.schema.fields, T.StructField(PERIOD, T.StringType())])
    return read_or_empty(spark, path, schema).select(*like.columns)


def with_folder(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at `path` with its period column, for readers that prune by it."""
    schema = T.StructType([*like.schema.fields, T.StructField(PERIOD, T.StringType())])
    return read_or_empty(spark, path, schema)
