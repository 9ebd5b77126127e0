"""Raw text to typed, deduplicated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.calendar import yyyymm
from tidewatt.functions.casts import (
    blank_to_null,
    lenient_date,
    lenient_double,
    lenient_int,
    strict,
)
from tidewatt.functions.keys import surrogate_key
from tidewatt.functions.measures import price_outlier, pricing_regime
from tidewatt.operators.dedup import latest_per_key, newest
from tidewatt.operators.joins import look_up_seed, only_keys
from tidewatt.operators.reshape import unpivot_missing, unpivot_periods
from tidewatt.params import Params
from tidewatt.schemas import MTIME


GENERATION_IDS = [
    "site_code", "poc_code", "nwk_code", "gen_code", "raw_fuel_code", "fuel_type", "is_renewable",
    "tech_code", "trading_date", "trading_month", MTIME,
]


def generation_cells(raw: DataFrame, fuel_codes: DataFrame) -> DataFrame:
    """Filled cells of the period matrix, for fuels that map to a type."""
    # The 12-row seed join comes first: rows of unmapped fuels are not expanded at all.
    mapped = look_up_seed(raw.withColumnRenamed("fuel_code", "raw_fuel_code"), fuel_codes, "raw_fuel_code")
    return unpivot_periods(mapped, GENERATION_IDS, period="trading_period", value="cell")


def latest_generation(cells: DataFrame) -> DataFrame:
    """Typed cells, one per generator and half hour; the last file wins."""
    typed = (
        cells.withColumn("trading_date", strict("trading_date", "date"))
        .withColumn("generation_kwh", lenient_int("cell"))
        .drop("cell")
        .filter("generation_kwh IS NOT NULL")
    )
    keys = ["trading_date", "trading_period", "site_code", "gen_code"]
    order = [newest(c) for c in (MTIME, "generation_kwh", "poc_code", "nwk_code", "raw_fuel_code", "tech_code")]
    return latest_per_key(typed, keys, order).select(
        surrogate_key("site_code", "gen_code", "trading_date", "trading_period").alias("generation_id"),
        "site_code", "poc_code", "nwk_code", "gen_code", "raw_fuel_code", "fuel_type", "is_renewable",
        "tech_code", "trading_date", "trading_month", "trading_period", "generation_kwh", MTIME,
    )


def stg_generation(raw: DataFrame, fuel_codes: DataFrame) -> DataFrame:
    return latest_generation(generation_cells(raw, fuel_codes))


def unmapped_fuel_codes(raw: DataFrame, fuel_codes: DataFrame) -> DataFrame:
    """Raw rows the inner join of stg_generation drops, per fuel code."""
    codes = raw.groupBy(F.col("fuel_code").alias("raw_fuel_code")).agg(F.count(F.lit(1)).alias("row_count"))
    return look_up_seed(codes, fuel_codes, "raw_fuel_code", "left_anti")


def stg_generation_null_audit(raw: DataFrame) -> DataFrame:
    """Empty cells among the 46 periods every day has."""
    renamed = raw.withColumnRenamed("fuel_code", "raw_fuel_code")
    ids = ["site_code", "gen_code", "raw_fuel_code", "trading_date", "trading_month", MTIME]
    return unpivot_missing(renamed, ids, period="trading_period").select(
        "site_code", "gen_code", "raw_fuel_code",
        strict("trading_date", "date").alias("trading_date"),
        "trading_month", "trading_period", MTIME,
    )


def stg_price(raw: DataFrame, p: Params = Params()) -> DataFrame:
    present = raw.dropna(subset=["trading_date", "trading_period", "point_of_connection"])
    typed = present.select(
        strict("trading_date", "date").alias("trading_date"),
        strict("trading_period", "int").alias("trading_period"),
        F.col("point_of_connection").alias("poc_code"),
        strict("dollars_per_mwh", "double").alias("price_nzd_mwh"),
        F.lit(False).alias("is_proxy"),
        "trading_month",
        MTIME,
    ).withColumn("pricing_regime", pricing_regime("trading_date", p))
    keys = ["poc_code", "trading_date", "trading_period"]
    latest = latest_per_key(typed, keys, [newest(MTIME), newest("price_nzd_mwh"), newest("trading_month")])
    return latest.select(
        surrogate_key(*keys).alias("price_id"), *keys, "price_nzd_mwh", "pricing_regime", "is_proxy",
        "trading_month", MTIME,
    )


def stg_price_outlier_audit(stg_price: DataFrame, p: Params = Params()) -> DataFrame:
    return stg_price.select(
        "poc_code", "trading_date", "trading_period", "price_nzd_mwh", "pricing_regime",
        price_outlier("price_nzd_mwh", p).alias("outlier_type"),
    ).filter("outlier_type IS NOT NULL")


def stg_market_volume(raw: DataFrame) -> DataFrame:
    """Typed volumes. Repeated rows stay; the uniqueness check reports them."""
    present = raw.dropna(
        subset=["point_of_connection", "trading_date", "trading_period", "flow_direction", "kilowatt_hours"]
    )
    day = strict("trading_date", "date")
    return present.select(
        surrogate_key(
            "network", "point_of_connection", "participant", "trading_date", "trading_period", "flow_direction"
        ).alias("market_volume_id"),
        F.col("point_of_connection").alias("poc_code"),
        "network",
        "island",
        "participant",
        day.alias("trading_date"),
        strict("trading_period", "int").alias("trading_period"),
        "trading_period_start_time",
        F.lower("flow_direction").alias("flow_direction"),
        strict("kilowatt_hours", "double").alias("volume_kwh"),
        yyyymm(day).alias("trading_month"),
        MTIME,
    )


def stg_energy_offer(raw: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Latest energy-injection offers; superseded submissions never get as far as the dedup.

    only: nodes and half hours (poc_code, trading_date, tp_number) outside which offers are left out before the dedup.
    """
    present = raw.dropna(
        subset=[
            "trading_date", "trading_period", "participant_code", "point_of_connection", "unit",
            "tranche", "megawatts", "dollars_per_mwh",
        ]
    )
    day = strict("trading_date", "date")
    optional = [
        "maximum_ramp_up_mw_per_hour", "maximum_ramp_down_mw_per_hour",
        "partially_loaded_spinning_reserve_percent", "maximum_output_mw", "forecast_generation_potential_mw",
    ]
    typed = present.select(
        "participant_code",
        F.col("point_of_connection").alias("poc_code"),
        "unit",
        F.lower("product_type").alias("product_type"),
        F.lower("product_class").alias("product_class"),
        "reserve_type",
        "product_description",
        day.alias("trading_date"),
        strict("trading_period", "int").alias("trading_period"),
        strict("utc_submission_date", "date").alias("utc_submission_date"),
        "utc_submission_time",
        strict("submission_order", "int").alias("submission_order"),
        (F.upper(F.coalesce("is_latest_yes_no", F.lit(""))) == "Y").alias("is_latest"),
        strict("tranche", "int").alias("tranche"),
        *[strict(blank_to_null(c), "double").alias(c) for c in optional],
        strict("megawatts", "double").alias("offer_mw"),
        strict("dollars_per_mwh", "double").alias("offer_price_nzd_mwh"),
        yyyymm(day).alias("trading_month"),
        MTIME,
    )
    wanted = typed.filter("product_type = 'energy' AND product_class = 'injection' AND is_latest")
    if only is not None:
        wanted = only_keys(wanted, only.withColumnRenamed("tp_number", "trading_period"), ["poc_code", "trading_date", "trading_period"])
    keys = ["participant_code", "poc_code", "unit", "trading_date", "trading_period", "tranche"]
    order = [
        newest(c)
        for c in ("submission_order", MTIME, "offer_price_nzd_mwh", "offer_mw", "utc_submission_date",
                  "utc_submission_time", *optional)
    ]
    return latest_per_key(wanted, keys, order).select(
        surrogate_key(*keys).alias("offer_id"), "participant_code", "poc_code", "unit", "product_type",
        "product_class", "reserve_type", "product_description", "trading_date", "trading_period",
        "utc_submission_date", "utc_submission_time", "submission_order", "is_latest", "tranche",
        *optional, "offer_mw", "offer_price_nzd_mwh", "trading_month", MTIME,
    )


def stg_nsp(raw: DataFrame) -> DataFrame:
    """Current network supply points, trimmed and typed."""
    current = raw.filter((F.trim("current_flag") == "1") & (F.trim("poc_code") != ""))
    text = {
        "nsp_code": "nsp",
        "poc_code": "poc_code",
        "network_participant": "network_participant",
        "reconciliation_type": "reconciliation_type",
        "description": "description",
        "region": "network_reporting_region",
        "region_id": "network_reporting_region_id",
        "zone": "zone",
        "island": "island",
    }
    return current.select(
        *[F.trim(source).alias(target) for target, source in text.items()],
        lenient_int("nztm_easting").alias("nztm_easting"),
        lenient_int("nztm_northing").alias("nztm_northing"),
        lenient_date("start_date").alias("start_date"),
        lenient_date("end_date").alias("end_date"),
        MTIME,
    )


def stg_hydro_storage(raw: DataFrame, p: Params = Params()) -> DataFrame:
    typed = raw.select(
        "site_code",
        lenient_date("date_str").alias("trading_date"),
        lenient_double("level_m").alias("level_m"),
        lenient_double("active_storage_mm3").alias("active_storage_mm3"),
        lenient_double("contingent_storage_mm3").alias("contingent_storage_mm3"),
        lenient_int("quality_code").alias("quality_code"),
    )
    return typed.filter(
        (F.col("trading_date") >= F.lit(p.hydro_floor)) & F.col("active_storage_mm3").isNotNull()
    )


def stg_run(raw: DataFrame) -> DataFrame:
    """Typed run telemetry."""
    return raw.select(
        "invocation_id",
        strict("generated_at", "timestamp_ntz").alias("generated_at"),
        "dbt_version", "node_unique_id", "node_type", "node_name", "status",
        strict(blank_to_null("execution_time_seconds"), "double").alias("execution_time_seconds"),
        strict(blank_to_null("failures"), "int").alias("failures"),
        *[blank_to_null(c).alias(c) for c in ("message", "relation_name", "adapter_message")],
    )
