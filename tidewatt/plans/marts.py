"""Marts: the tables analysts and dashboards read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatt.functions.calendar import period_second, season, season_year, yyyymm
from tidewatt.functions.keys import date_key
from tidewatt.functions.measures import (
    half_hour_kwh_to_mw,
    kwh_to_gwh,
    price_outlier,
    safe_ratio,
    share_pct,
)
from tidewatt.operators import prefix
from tidewatt.operators.aggregates import avg_where, count_where, sum_where, sums_up_to, weighted_avg
from tidewatt.operators.joins import look_up, with_matched_flag
from tidewatt.operators.rolling import trailing_days, trailing_rows
from tidewatt.params import Params
from tidewatt.plans.core import TP_KEY
from tidewatt.schemas import MTIME

OFFER_LIMITS = (0, 100, 300, 500)


# ---- generation -----------------------------------------------------------------------------


def mart_generation_daily(fct_generation: DataFrame) -> DataFrame:
    total = F.sum("generation_kwh")
    return fct_generation.groupBy("trading_date", "fuel_type").agg(
        total.alias("total_generation_kwh"),
        kwh_to_gwh(total).alias("total_generation_gwh"),
        F.count_distinct("gen_code").alias("generator_count"),
    )


def generation_totals(fct_generation: DataFrame) -> DataFrame:
    """Sums per month and fuel: all that marts without distinct counts need, in a few rows a month."""
    return fct_generation.groupBy("trading_month", "fuel_type", "is_renewable").agg(
        F.sum("generation_kwh").alias("generation_kwh")
    )


def fuel_totals(totals: DataFrame) -> DataFrame:
    """The totals of mart_generation_monthly, without its distinct counts."""
    total = F.sum("generation_kwh")
    return totals.groupBy(F.col("trading_month").alias("year_month"), "fuel_type").agg(
        total.alias("total_generation_kwh"), kwh_to_gwh(total).alias("total_generation_gwh")
    )


def mart_generation_monthly(fct_generation: DataFrame) -> DataFrame:
    # One pass to (month, fuel, generator, day) first: the two distinct counts then expand
    # that small table instead of the half-hour rows.
    small = fct_generation.groupBy("trading_month", "fuel_type", "gen_code", "trading_date").agg(
        F.sum("generation_kwh").alias("_kwh")
    )
    total = F.sum("_kwh")
    return small.groupBy(F.col("trading_month").alias("year_month"), "fuel_type").agg(
        total.alias("total_generation_kwh"),
        kwh_to_gwh(total).alias("total_generation_gwh"),
        F.count_distinct("gen_code").alias("generator_count"),
        F.count_distinct("trading_date").alias("active_days"),
    )


def mart_plant_ranking(fct_generation: DataFrame, rank_step_kwh: float = 1e6) -> DataFrame:
    """Monthly ranking of sites with the fuel that contributed most (first name on a tie)."""
    by_fuel = fct_generation.groupBy(F.col("trading_month").alias("year_month"), "site_code", "fuel_type").agg(
        F.sum("generation_kwh").alias("_kwh")
    )
    total = F.sum("_kwh")
    sites = by_fuel.groupBy("year_month", "site_code").agg(
        total.alias("total_generation_kwh"),
        kwh_to_gwh(total).alias("total_generation_gwh"),
        F.min_by("fuel_type", F.struct(-F.col("_kwh"), "fuel_type")).alias("primary_fuel_type"),
    )
    kwh = F.col("total_generation_kwh")
    return prefix.rank(
        sites, ["year_month"], [kwh.desc()], F.floor(kwh / rank_step_kwh), "monthly_rank", descending=True
    )


def mart_renewable_ratio(fct_generation: DataFrame) -> DataFrame:
    """Battery output counts in the total but not as renewable."""
    total, green = F.sum("generation_kwh"), sum_where(F.col("is_renewable"), "generation_kwh")
    pct = F.when(total != 0, green.cast("double") * 100.0 / total.cast("double"))
    return fct_generation.groupBy(F.col("trading_month").alias("year_month")).agg(
        total.alias("total_kwh"),
        kwh_to_gwh(total).alias("total_gwh"),
        green.alias("renewable_kwh"),
        kwh_to_gwh(green).alias("renewable_gwh"),
        F.round(pct, 2).alias("renewable_pct"),
    )


def mart_seasonal_pattern(fct_generation: DataFrame) -> DataFrame:
    # Days map to seasons, so sum per day before deriving them.
    daily = fct_generation.groupBy("trading_date", "fuel_type").agg(
        F.sum("generation_kwh").alias("_kwh"), F.count("generation_kwh").alias("_n")
    )
    total = F.sum("_kwh")
    return daily.groupBy(
        season_year("trading_date").alias("season_year"), season("trading_date").alias("season"), "fuel_type"
    ).agg(
        kwh_to_gwh(total).alias("total_generation_gwh"),
        kwh_to_gwh(safe_ratio(total, F.sum("_n"))).alias("avg_generation_gwh"),
    )


# ---- prices ---------------------------------------------------------------------------------


def mart_price_daily(fct_price: DataFrame, dim_node: DataFrame, p: Params = Params()) -> DataFrame:
    price = F.col("price_nzd_mwh")
    daily = fct_price.groupBy("poc_code", "trading_date").agg(
        F.count(F.lit(1)).alias("tp_count"),
        F.avg(price).alias("avg_price_all"),
        avg_where(~F.col("is_proxy"), price).alias("avg_price_non_proxy"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.stddev_samp(price).alias("stddev_price"),
        count_where(price > p.spike_threshold).alias("spike_tp_count"),
        count_where(price < p.negative_threshold).alias("negative_tp_count"),
        F.max("pricing_regime").alias("pricing_regime"),
    )
    return look_up(daily, dim_node, "poc_code", ["island", "region", "zone", "network_participant"]).select(
        date_key("trading_date").alias("date_key"), "trading_date", "poc_code", "island", "region", "zone",
        "network_participant", "tp_count", "avg_price_all", "avg_price_non_proxy", "min_price", "max_price",
        "stddev_price", "spike_tp_count", "negative_tp_count", "pricing_regime",
    )


def generation_share(int_generation_by_poc: DataFrame) -> DataFrame:
    """Generation of a node and half hour split by renewability."""
    green, other = F.col("is_renewable"), ~F.col("is_renewable")
    return int_generation_by_poc.groupBy(*TP_KEY).agg(
        F.sum("generation_kwh").alias("total_generation_kwh"),
        sum_where(green, "generation_kwh").alias("renewable_generation_kwh"),
        sum_where(other, "generation_kwh").alias("thermal_generation_kwh"),
    )


def mart_price_spike_events(
    fct_price: DataFrame, int_generation_by_poc: DataFrame, dim_node: DataFrame, p: Params = Params()
) -> DataFrame:
    """Prices above the threshold with the generation running at the node."""
    spikes = fct_price.filter(F.col("price_nzd_mwh") > p.spike_threshold).select(
        *TP_KEY, "price_nzd_mwh", "pricing_regime", "is_proxy"
    )
    events = with_matched_flag(spikes, generation_share(int_generation_by_poc), TP_KEY, "unmatched_generation")
    return look_up(events, dim_node, "poc_code", ["island", "region"]).select(
        *TP_KEY, "price_nzd_mwh", "pricing_regime", "is_proxy", "island", "region", "total_generation_kwh",
        "renewable_generation_kwh", "thermal_generation_kwh", "unmatched_generation",
    )


def price_z_scores(fct_price: DataFrame, days: int = 30) -> DataFrame:
    """Every price with the mean and deviation of its node's preceding days."""
    prices = fct_price.select(*TP_KEY, "price_nzd_mwh", "pricing_regime", "is_proxy")
    context = trailing_days(
        prices, ["poc_code"], period_second("trading_date", "tp_number"), "price_nzd_mwh",
        "rolling_30d_avg_price", "rolling_30d_stddev_price", days,
    )
    sd = F.col("rolling_30d_stddev_price")
    z = F.when(sd > 0, (F.col("price_nzd_mwh") - F.col("rolling_30d_avg_price")) / sd)
    return context.withColumn("price_z_score", z)


def mart_price_anomaly_events(
    fct_price: DataFrame, fct_market_volume: DataFrame, dim_node: DataFrame, p: Params = Params()
) -> DataFrame:
    """Spikes, negative prices and statistical outliers, in this precedence."""
    kind = F.coalesce(
        price_outlier("price_nzd_mwh", p),
        F.when(F.abs("price_z_score") >= 3, "statistical_outlier"),
    )
    flagged = price_z_scores(fct_price).withColumn("anomaly_type", kind).filter("anomaly_type IS NOT NULL")
    volume = fct_market_volume.withColumnRenamed("island", "_volume_island")
    joined = look_up(
        flagged, volume, TP_KEY, ["injection_kwh", "offtake_kwh", "net_injection_kwh", "_volume_island"]
    )
    return look_up(joined, dim_node, "poc_code", ["island", "region", "zone"]).select(
        *TP_KEY, "price_nzd_mwh", "pricing_regime", "is_proxy", "rolling_30d_avg_price",
        "rolling_30d_stddev_price", "price_z_score", "anomaly_type", "injection_kwh", "offtake_kwh",
        "net_injection_kwh", F.coalesce("island", "_volume_island").alias("island"), "region", "zone",
    )


def mart_offer_curve(fct_offer_stack: DataFrame) -> DataFrame:
    """Supply-curve summary per node and half hour."""
    price = F.col("offer_price_nzd_mwh")
    curve = fct_offer_stack.groupBy(*TP_KEY).agg(
        F.count(F.lit(1)).alias("offer_tranche_count"),
        # Two distinct counts would copy every offer; the sets of a node and half hour are small.
        F.size(F.collect_set("participant_code")).cast("long").alias("offer_participant_count"),
        F.size(F.collect_set("unit")).cast("long").alias("offer_unit_count"),
        F.sum("offer_mw").alias("total_offered_mw"),
        *sums_up_to("offer_price_nzd_mwh", "offer_mw", OFFER_LIMITS, "offered_mw_at_or_below_"),
        F.min(price).alias("min_offer_price_nzd_mwh"),
        F.max(price).alias("max_offer_price_nzd_mwh"),
        F.avg(price).alias("avg_offer_price_nzd_mwh"),
        weighted_avg("offer_price_nzd_mwh", "offer_mw").alias("weighted_avg_offer_price_nzd_mwh"),
        F.max("cumulative_offered_mw").alias("max_cumulative_offered_mw"),
        F.max(MTIME).alias(MTIME),
    )
    return curve.select(
        date_key("trading_date").alias("date_key"),
        *[c for c in curve.columns if c != MTIME],
        safe_ratio("offered_mw_at_or_below_300", "total_offered_mw").alias("cheap_offer_share_below_300"),
        MTIME,
    )


def mart_price_offer_context(
    fct_price: DataFrame, fct_market_volume: DataFrame, mart_offer_curve: DataFrame
) -> DataFrame:
    """Every price with the volume and the offer curve of its node and half hour."""
    volume = ["injection_kwh", "offtake_kwh", "net_injection_kwh"]
    curve = [
        "offer_tranche_count", "offer_participant_count", "offer_unit_count", "total_offered_mw",
        *[f"offered_mw_at_or_below_{x}" for x in OFFER_LIMITS],
        "min_offer_price_nzd_mwh", "max_offer_price_nzd_mwh", "avg_offer_price_nzd_mwh",
        "weighted_avg_offer_price_nzd_mwh", "cheap_offer_share_below_300",
    ]
    joined = look_up(look_up(fct_price, fct_market_volume, TP_KEY, volume), mart_offer_curve, TP_KEY, curve)
    offtake_mw = half_hour_kwh_to_mw("offtake_kwh")
    return joined.select(
        "date_key", *TP_KEY, "price_nzd_mwh", "pricing_regime", "is_proxy", *volume,
        half_hour_kwh_to_mw("injection_kwh").alias("injection_mw"),
        offtake_mw.alias("offtake_mw"),
        *curve,
        safe_ratio("total_offered_mw", offtake_mw).alias("offered_to_offtake_ratio"),
    )


def mart_price_spike_features(
    fct_price: DataFrame,
    fct_market_volume: DataFrame,
    mart_offer_curve: DataFrame,
    int_generation_by_poc: DataFrame,
    dim_node: DataFrame,
    dim_date: DataFrame,
    p: Params = Params(),
) -> DataFrame:
    """Model-ready features per node and half hour; the target is is_price_spike."""
    price = fct_price.select(*TP_KEY, "price_nzd_mwh", "pricing_regime", "is_proxy")
    volume = ["injection_kwh", "offtake_kwh", "net_injection_kwh"]
    curve = [
        "offer_tranche_count", "offer_participant_count", "offer_unit_count", "total_offered_mw",
        "offered_mw_at_or_below_100", "offered_mw_at_or_below_300", "weighted_avg_offer_price_nzd_mwh",
        "cheap_offer_share_below_300",
    ]
    share = generation_share(int_generation_by_poc).select(
        *TP_KEY,
        F.col("total_generation_kwh").alias("generation_kwh"),
        "renewable_generation_kwh",
        share_pct("renewable_generation_kwh", "total_generation_kwh").alias("renewable_pct"),
    )
    base = look_up(price, fct_market_volume, TP_KEY, volume)
    # 336 rows are seven ordinary days, counted as rows: a short day reaches further back.
    rolled = trailing_rows(
        base, ["poc_code"], "trading_date", ["tp_number"],
        measures={
            "rolling_7d_avg_price": ("price_nzd_mwh", "avg"),
            "rolling_7d_stddev_price": ("price_nzd_mwh", "stddev"),
            "rolling_7d_avg_offtake_kwh": ("offtake_kwh", "avg"),
        },
        previous={"previous_tp_price": "price_nzd_mwh"},
        n=336,
    )
    # Wide attributes join last, so the window shuffle does not carry them.
    rolled = look_up(rolled, mart_offer_curve, TP_KEY, curve)
    rolled = look_up(rolled, share, TP_KEY, ["generation_kwh", "renewable_generation_kwh", "renewable_pct"])
    located = look_up(rolled, dim_node, "poc_code", ["island", "region"])
    days = ["month", "day_of_week_iso", "is_weekend", "is_nz_holiday", "season"]
    dated = look_up(located, dim_date, "trading_date", days)
    return dated.select(
        *TP_KEY, "price_nzd_mwh", (F.col("price_nzd_mwh") > p.spike_threshold).alias("is_price_spike"),
        "pricing_regime", "is_proxy", "previous_tp_price", "rolling_7d_avg_price", "rolling_7d_stddev_price",
        *volume, "rolling_7d_avg_offtake_kwh", *curve, "generation_kwh", "renewable_generation_kwh",
        "renewable_pct", "island", "region", *days,
    )


def mart_renewable_price_impact(
    fct_price: DataFrame, int_generation_by_poc: DataFrame, dim_node: DataFrame
) -> DataFrame:
    """Renewable share against price, for nodes that generate."""
    share = generation_share(int_generation_by_poc).drop("thermal_generation_kwh")
    priced = fct_price.select(*TP_KEY, "price_nzd_mwh", "pricing_regime").join(share, TP_KEY)
    priced = priced.withColumn("renewable_pct", share_pct("renewable_generation_kwh", "total_generation_kwh"))
    return look_up(priced, dim_node, "poc_code", ["island", "region"])


# ---- hydro and usage ------------------------------------------------------------------------


def mart_hydro_price_driver(fct_hydro: DataFrame, mart_price_daily: DataFrame) -> DataFrame:
    """Monthly lake storage against price per island."""
    daily = fct_hydro.filter("island IS NOT NULL").groupBy("island", "trading_date").agg(
        F.sum("active_storage_mm3").alias("_storage"), F.count_distinct("site_code").alias("_sites")
    )
    storage = daily.groupBy("island", yyyymm("trading_date").alias("year_month")).agg(
        F.avg("_storage").alias("avg_total_storage_mm3"),
        F.min("_storage").alias("min_storage_mm3"),
        F.max("_storage").alias("max_storage_mm3"),
        F.count(F.lit(1)).alias("observation_days"),
        F.avg(F.col("_sites").cast("double")).alias("avg_sites_reporting"),
    )
    # One row per island and month by now: a group has as many rows as months.
    peak = F.max("avg_total_storage_mm3").over(Window.partitionBy("island"))
    pct = F.round(safe_ratio(F.lit(100.0) * F.col("avg_total_storage_mm3"), peak), 1)
    storage = storage.withColumn("storage_pct_of_max", pct)
    price = mart_price_daily.filter("island IS NOT NULL").groupBy(
        "island", yyyymm("trading_date").alias("year_month")
    ).agg(
        F.avg("avg_price_all").alias("avg_price_nzd_mwh"),
        F.avg("avg_price_non_proxy").alias("avg_price_non_proxy"),
        F.count_distinct("trading_date").alias("price_days"),
        F.count_distinct("poc_code").alias("poc_count"),
    )
    return storage.join(price, ["island", "year_month"], "left").select(
        "island", "year_month", "avg_total_storage_mm3", "min_storage_mm3", "max_storage_mm3",
        "storage_pct_of_max", "observation_days", "avg_sites_reporting", "avg_price_nzd_mwh",
        "avg_price_non_proxy", "price_days", "poc_count",
    )


def mart_usage_cost(metering: DataFrame, queries: DataFrame, p: Params = Params()) -> DataFrame:
    """Credits and query health per day and warehouse over the last days."""
    today = F.current_date() if p.as_of is None else F.lit(p.as_of)
    since = F.date_sub(today, p.usage_window_days)
    day = F.col("start_time").cast("date")
    used = metering.filter(day >= since).groupBy(day.alias("usage_date"), "warehouse_name").agg(
        *[F.sum(c).alias(c) for c in ("credits_used", "credits_used_compute", "credits_used_cloud_services")]
    )
    ran = (
        queries.filter((day >= since) & F.col("warehouse_name").isNotNull())
        .groupBy(day.alias("usage_date"), "warehouse_name")
        .agg(
            F.count(F.lit(1)).alias("total_queries"),
            count_where(F.col("execution_status") != "SUCCESS").alias("failed_queries"),
            (F.avg("total_elapsed_time") / 1000.0).alias("avg_query_seconds"),
        )
    )
    return used.join(ran, ["usage_date", "warehouse_name"], "left").select(
        "usage_date", "warehouse_name", "credits_used", "credits_used_compute", "credits_used_cloud_services",
        (F.col("credits_used") * p.usd_per_credit).alias("usd_estimated"),
        F.coalesce("total_queries", F.lit(0)).alias("total_queries"),
        F.coalesce("failed_queries", F.lit(0)).alias("failed_queries"),
        "avg_query_seconds",
    )


