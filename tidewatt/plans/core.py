"""Intermediate tables, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatt.functions.calendar import date_spine, iso_weekday, season, season_year
from tidewatt.functions.keys import date_key, surrogate_key
from tidewatt.operators import prefix
from tidewatt.operators.aggregates import avg_where, sum_where
from tidewatt.operators.dedup import latest_per_key, newest
from tidewatt.operators.joins import look_up, look_up_seed
from tidewatt.params import Params
from tidewatt.schemas import MTIME

TP_KEY = ["poc_code", "trading_date", "tp_number"]


def int_generation_by_poc(stg_generation: DataFrame) -> DataFrame:
    """Plants of a node summed per half hour and fuel, so that price joins cannot fan out."""
    return (
        stg_generation.filter("poc_code IS NOT NULL")
        .groupBy("poc_code", "trading_date", F.col("trading_period").alias("tp_number"), "fuel_type", "is_renewable")
        .agg(F.sum("generation_kwh").alias("generation_kwh"))
    )


def int_price_daily(fct_price: DataFrame) -> DataFrame:
    """Half-hour prices with the day's averages on every row (a node has at most 50 rows a day)."""
    day = Window.partitionBy("poc_code", "trading_date")
    return fct_price.select(
        *TP_KEY, "price_nzd_mwh", "is_proxy", "pricing_regime",
        F.avg("price_nzd_mwh").over(day).alias("avg_price_all"),
        avg_where(~F.col("is_proxy"), "price_nzd_mwh").over(day).alias("avg_price_non_proxy"),
    )


def calendar(days: DataFrame, holidays: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes of the given days."""
    base = days.select(F.col(day).cast("date").alias("trading_date"))
    known = look_up_seed(base, holidays.withColumnRenamed("holiday_date", "trading_date"), "trading_date", "left")
    weekday = iso_weekday("trading_date")
    return known.select(
        date_key("trading_date").alias("date_key"),
        "trading_date",
        F.year("trading_date").alias("year"),
        F.quarter("trading_date").alias("quarter"),
        F.month("trading_date").alias("month"),
        F.dayofmonth("trading_date").alias("day"),
        weekday.alias("day_of_week_iso"),
        weekday.isin(6, 7).alias("is_weekend"),
        F.col("holiday_name").isNotNull().alias("is_nz_holiday"),
        "holiday_name",
        season("trading_date").alias("season"),
        season_year("trading_date").alias("season_year"),
    )


def dim_date(spark: SparkSession, holidays: DataFrame, p: Params = Params()) -> DataFrame:
    return calendar(date_spine(spark, p.calendar_start, p.calendar_end), holidays)


def dim_fuel(fuel_codes: DataFrame) -> DataFrame:
    return fuel_codes.groupBy("fuel_type").agg(F.bool_or("is_renewable").alias("is_renewable")).select(
        surrogate_key("fuel_type").alias("fuel_id"), "fuel_type", "is_renewable"
    )


def dim_plant(stg_generation: DataFrame) -> DataFrame:
    """Latest snapshot per plant."""
    keys = ["site_code", "gen_code"]
    attributes = ["poc_code", "nwk_code", "fuel_type", "tech_code"]
    order = [newest(c) for c in (MTIME, "trading_date", *attributes)]
    latest = latest_per_key(stg_generation.select(*keys, *attributes, "trading_date", MTIME), keys, order)
    return latest.select(surrogate_key(*keys).alias("plant_id"), *keys, *attributes)


def dim_node(stg_nsp: DataFrame) -> DataFrame:
    """One row per node: latest start date (none counts as oldest), then the first supply point."""
    start = F.coalesce("start_date", F.lit("1900-01-01").cast("date")).desc()
    order = [start, F.col("nsp_code").asc_nulls_last(), newest(MTIME), newest("network_participant")]
    return latest_per_key(stg_nsp, ["poc_code"], order).select(
        surrogate_key("poc_code").alias("node_id"), "poc_code", "nsp_code", "network_participant",
        "reconciliation_type", "region", "region_id", "zone", "island", "nztm_easting", "nztm_northing",
    )


def dim_catchment(catchments: DataFrame) -> DataFrame:
    return catchments.select(surrogate_key("site_code").alias("catchment_key"), *catchments.columns)


def fct_generation(stg_generation: DataFrame) -> DataFrame:
    return stg_generation.select(
        "generation_id", surrogate_key("site_code", "gen_code").alias("plant_id"), "site_code", "gen_code",
        "fuel_type", "is_renewable", "trading_date", "trading_month", "trading_period", "generation_kwh",
    )


def fct_price(stg_price: DataFrame) -> DataFrame:
    return stg_price.select(
        date_key("trading_date").alias("date_key"), "trading_date", "poc_code",
        F.col("trading_period").alias("tp_number"), "price_nzd_mwh", "is_proxy", "pricing_regime", MTIME,
    )


def fct_market_volume(stg_market_volume: DataFrame) -> DataFrame:
    """Participants and directions folded to one row per node and half hour."""
    injection = sum_where(F.col("flow_direction") == "injection", "volume_kwh")
    offtake = sum_where(F.col("flow_direction") == "offtake", "volume_kwh")
    folded = stg_market_volume.groupBy(
        "poc_code", "trading_date", F.col("trading_period").alias("tp_number")
    ).agg(
        F.max("network").alias("network"),
        F.max("island").alias("island"),
        F.count_distinct("participant").alias("participant_count"),
        injection.alias("injection_kwh"),
        offtake.alias("offtake_kwh"),
        F.max(MTIME).alias(MTIME),
    )
    return folded.select(
        date_key("trading_date").alias("date_key"), *TP_KEY, "network", "island", "participant_count",
        "injection_kwh", "offtake_kwh",
        (F.col("injection_kwh") - F.col("offtake_kwh")).alias("net_injection_kwh"), MTIME,
    )


def fct_offer_stack(stg_energy_offer: DataFrame) -> DataFrame:
    """Supply stack: offers of a node and half hour in price order with the running MW.

    A group is one node and half hour, bounded by its participants, units and tranches whatever the history, so a plain
    window in one shuffle is enough.
    """
    offers = stg_energy_offer.select(
        "offer_id",
        date_key("trading_date").alias("date_key"),
        "participant_code", "poc_code", "unit", "trading_date",
        F.col("trading_period").alias("tp_number"),
        "tranche", "offer_mw", "offer_price_nzd_mwh",
        (F.col("offer_mw") * F.col("offer_price_nzd_mwh")).alias("offered_mw_price_value"),
        "maximum_ramp_up_mw_per_hour", "maximum_ramp_down_mw_per_hour", "maximum_output_mw",
        "forecast_generation_potential_mw", MTIME,
    )
    order = [F.col(c).asc_nulls_last() for c in ("offer_price_nzd_mwh", "tranche", "participant_code", "unit")]
    so_far = Window.partitionBy(*TP_KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return offers.withColumn("cumulative_offered_mw", F.sum("offer_mw").over(so_far))


def fct_hydro(stg_hydro_storage: DataFrame, dim_catchment: DataFrame) -> DataFrame:
    joined = look_up(
        stg_hydro_storage, dim_catchment, "site_code", ["catchment_name", "island", "plant_group", "scheme"]
    )
    return joined.select(
        surrogate_key("site_code", "trading_date").alias("hydro_id"),
        date_key("trading_date").alias("date_key"),
        "trading_date", "site_code", "catchment_name", "island", "plant_group", "scheme", "level_m",
        "active_storage_mm3", "contingent_storage_mm3", "quality_code",
    )


def fct_run(stg_run: DataFrame) -> DataFrame:
    """Telemetry with success flag and, per node, the recency of each run (1 = newest)."""
    base = stg_run.select(
        "invocation_id", "generated_at", F.col("generated_at").cast("date").alias("generated_date"),
        "dbt_version", "node_unique_id", "node_type", "node_name", "status", "execution_time_seconds",
        "failures", "message", "relation_name", "adapter_message",
        F.col("status").isin("pass", "success").alias("is_success"),
    )
    order = [newest("generated_at"), F.col("invocation_id").asc_nulls_last()]
    # An undated run sorts last, so it gets the earliest band.
    band = F.coalesce("generated_date", F.lit("0001-01-01").cast("date"))
    return prefix.position(base, ["node_unique_id"], order, band, "invocation_rank_desc", descending=True)
