"""Read-side queries. Each pushes its aggregation into the plan and returns a small result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.functions.calendar import month_start, shift_month
from tidewatt.functions.measures import (
    SHARE_BANDS,
    change_pct,
    correlation,
    direction,
    event_label,
    on_target,
    ordinal,
    safe_ratio,
    share_band,
)
from tidewatt.operators import aggregates as agg
from tidewatt.operators.dedup import newest_value_per_key
from tidewatt.operators.joins import look_up, recent_ids
from tidewatt.operators.reshape import melt_sum, pivot_filled
from tidewatt.operators.serve import (
    date_slice,
    keep_values,
    month_slice,
    optional_limit,
    seeded_sample,
    top_n,
)
from tidewatt.session import kept

# Display orders.
SEASONS = ("Summer", "Autumn", "Winter", "Spring")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Columns and order in which each mart is listed: name -> (columns, order); "-" sorts downwards.
LISTINGS = {
    "mart_generation_monthly": (
        ["year_month", "fuel_type", "total_generation_gwh", "generator_count", "active_days"],
        ["year_month", "fuel_type"],
    ),
    "mart_renewable_ratio": (["year_month", "total_gwh", "renewable_gwh", "renewable_pct"], ["year_month"]),
    "mart_plant_ranking": (
        ["year_month", "site_code", "total_generation_gwh", "monthly_rank", "primary_fuel_type"],
        ["-year_month", "monthly_rank"],
    ),
    "mart_seasonal_pattern": (
        ["season_year", "season", "fuel_type", "total_generation_gwh", "avg_generation_gwh"],
        ["season_year", "season", "fuel_type"],
    ),
    "mart_price_daily": (
        ["trading_date", "poc_code", "island", "region", "zone", "tp_count", "avg_price_all", "min_price",
         "max_price", "stddev_price", "spike_tp_count", "negative_tp_count", "pricing_regime"],
        ["trading_date", "poc_code"],
    ),
    "mart_price_spike_events": (
        ["trading_date", "poc_code", "tp_number", "price_nzd_mwh", "island", "region",
         "total_generation_kwh", "renewable_generation_kwh", "thermal_generation_kwh", "unmatched_generation"],
        ["trading_date", "tp_number", "poc_code"],
    ),
    "mart_renewable_price_impact": (
        ["trading_date", "poc_code", "tp_number", "price_nzd_mwh", "total_generation_kwh",
         "renewable_generation_kwh", "renewable_pct", "island", "region"],
        ["trading_date", "tp_number", "poc_code"],
    ),
    "fct_run": (
        ["invocation_id", "generated_at", "generated_date", "dbt_version", "node_unique_id", "node_type",
         "node_name", "status", "execution_time_seconds", "failures", "is_success", "invocation_rank_desc"],
        ["-generated_at"],
    ),
    "mart_hydro_price_driver": (
        ["island", "year_month", "avg_total_storage_mm3", "min_storage_mm3", "max_storage_mm3",
         "storage_pct_of_max", "observation_days", "avg_sites_reporting", "avg_price_nzd_mwh",
         "avg_price_non_proxy", "price_days", "poc_count"],
        ["island", "year_month"],
    ),
    "fct_hydro": (
        ["site_code", "catchment_name", "island", "scheme", "trading_date", "active_storage_mm3", "level_m",
         "quality_code"],
        ["island", "site_code", "trading_date"],
    ),
    "mart_usage_cost": (
        ["usage_date", "warehouse_name", "credits_used", "credits_used_compute",
         "credits_used_cloud_services", "usd_estimated", "total_queries", "failed_queries",
         "avg_query_seconds"],
        ["-usage_date", "warehouse_name"],
    ),
}


def listing(mart: DataFrame, name: str) -> DataFrame:
    """A mart's public columns in its stable order; months also as a date, zero-padded."""
    columns, order = LISTINGS[name]
    keys = [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in order
    ]
    out = mart.select(*columns).orderBy(*keys)
    if "year_month" in columns:
        padded = F.lpad(F.col("year_month").cast("string"), 6, "0")
        out = out.withColumn("year_month", padded).withColumn("date", month_start("year_month"))
    return out


def _latest_month(df: DataFrame):
    return df.agg(F.max("year_month")).scalar()


# ---- executive overview and fuel mix ---------------------------------------------------------


def month_totals(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("year_month").agg(F.sum("total_generation_gwh").alias("total_generation_gwh"))


def against_last_year(series: DataFrame, value: str, prior: str, pct: str) -> DataFrame:
    """A monthly series with its value a year before and the change; NULL where there is none.

    A join on the shifted month, so gaps in the months do no harm.
    """
    before = series.select(shift_month("year_month", 12).alias("year_month"), F.col(value).alias(prior))
    return series.join(before, "year_month", "left").withColumn(pct, change_pct(value, prior))


def year_over_year(monthly: DataFrame) -> DataFrame:
    """Month totals against the same month a year before."""
    return against_last_year(month_totals(monthly), "total_generation_gwh", "prior_generation_gwh", "yoy_pct")


def renewable_year_over_year(renewable: DataFrame) -> DataFrame:
    """Change of the renewable share itself against a year before."""
    series = renewable.select("year_month", "renewable_pct")
    return against_last_year(series, "renewable_pct", "prior_renewable_pct", "yoy_pct")


def latest_mix(monthly: DataFrame) -> DataFrame:
    """Fuels of the latest month with their share, largest first."""
    last = monthly.filter(F.col("year_month") == _latest_month(monthly))
    mix = last.groupBy("year_month", "fuel_type").agg(F.sum("total_generation_gwh").alias("total_generation_gwh"))
    shared = agg.share_of_total(mix, ["year_month"], "total_generation_gwh", "share_pct")
    return shared.orderBy(F.col("total_generation_gwh").desc(), "fuel_type")


def last_months(monthly: DataFrame, n: int = 24) -> DataFrame:
    """The n latest month totals in time order."""
    return month_totals(monthly).orderBy(F.col("year_month").desc()).limit(n).orderBy("year_month")


def overview(monthly: DataFrame, renewable: DataFrame, price_daily: DataFrame, spikes: DataFrame) -> DataFrame:
    """The headline figures in one row."""
    top = latest_mix(monthly).limit(1).select(
        "year_month", F.col("fuel_type").alias("top_fuel"), F.col("share_pct").alias("top_fuel_share_pct")
    )
    head = year_over_year(monthly).join(top, "year_month").join(
        renewable.select("year_month", "renewable_pct"), "year_month", "left"
    )
    # Both price figures are one subquery, so the days are grouped once.
    prices = price_daily.agg(F.struct(F.avg("avg_price_all").alias("avg"), F.max("max_price").alias("peak"))).scalar()
    return head.select(
        "*",
        prices.getField("avg").alias("avg_price"),
        prices.getField("peak").alias("peak_price"),
        spikes.agg(F.count(F.lit(1))).scalar().alias("spike_events"),
    )


def pass_rate(runs: DataFrame) -> DataFrame:
    """Success rate of the latest run of every node."""
    return runs.filter("invocation_rank_desc = 1").agg((agg.rate(F.col("is_success")) * 100.0).alias("pass_rate_pct"))


def fuel_share(monthly: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    view = month_slice(monthly, "year_month", start, end)
    return agg.share_of_total(view, ["year_month"], "total_generation_gwh", "share_pct")


def renewable_trend(renewable: DataFrame, months: int = 12, min_months: int = 3) -> DataFrame:
    """Rolling mean over the last rows, shown from min_months rows on (fewer if there are fewer).

    One row per month: the ordered pass is as long as the calendar.
    """
    frame = Window.orderBy("year_month").rowsBetween(1 - months, 0)
    need = F.least(F.lit(min_months), F.count(F.lit(1)).over(Window.partitionBy()))
    rolling = F.when(
        F.count("renewable_pct").over(frame) >= need, F.avg("renewable_pct").over(frame)
    )
    return renewable.select("year_month", "renewable_pct", rolling.alias("rolling_pct"))


def renewable_extremes(renewable: DataFrame) -> DataFrame:
    """Average, best and worst month (the earliest on a tie)."""
    share = F.col("renewable_pct")
    return renewable.filter(share.isNotNull()).agg(
        F.avg(share).alias("avg_pct"),
        F.min_by("year_month", F.struct(-share, "year_month")).alias("best_month"),
        F.max(share).alias("best_pct"),
        F.min_by("year_month", F.struct(share, "year_month")).alias("worst_month"),
        F.min(share).alias("worst_pct"),
        F.max("year_month").alias("latest_month"),
    )


def renewable_annual(renewable: DataFrame) -> DataFrame:
    return renewable.groupBy(F.substring("year_month", 1, 4).cast("int").alias("year")).agg(
        F.avg("renewable_pct").alias("renewable_pct"),
        F.sum("renewable_gwh").alias("renewable_gwh"),
        F.sum("total_gwh").alias("total_gwh"),
    )


# ---- seasons and stations --------------------------------------------------------------------


def season_totals(seasonal: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """Totals by season and fuel in calendar-of-seasons order."""
    if start_year is not None and end_year is not None and start_year > end_year:
        start_year, end_year = end_year, start_year
    if start_year is not None:
        seasonal = seasonal.filter(F.col("season_year") >= start_year)
    if end_year is not None:
        seasonal = seasonal.filter(F.col("season_year") <= end_year)
    totals = seasonal.groupBy("season", "fuel_type").agg(F.sum("total_generation_gwh").alias("total_generation_gwh"))
    return totals.withColumn("season_order", ordinal("season", SEASONS)).orderBy("season_order", "fuel_type")


def peak_season(seasonal: DataFrame) -> DataFrame:
    totals = seasonal.groupBy("season").agg(F.sum("total_generation_gwh").alias("total_generation_gwh"))
    return top_n(totals, 1, F.col("total_generation_gwh").desc(), F.col("season"))


def month_heatmap(monthly: DataFrame) -> DataFrame:
    """Average monthly generation, one row per fuel and one column per calendar month."""
    numbered = monthly.withColumn("month_num", F.substring("year_month", 5, 2).cast("int"))
    labels = {i + 1: name for i, name in enumerate(MONTHS)}
    return pivot_filled(numbered, "fuel_type", "month_num", labels, F.avg("total_generation_gwh"))


def top_stations(ranking: DataFrame, year_month: str | None = None, n: int = 10) -> DataFrame:
    month = _latest_month(ranking) if year_month is None else F.lit(year_month)
    view = ranking.filter(F.col("year_month") == month)
    return top_n(view, n, F.col("monthly_rank"), F.col("site_code"))


def concentration(ranking: DataFrame, n: int = 10) -> DataFrame:
    """Share of the n best-ranked stations in every month (all peers of rank n count)."""
    gwh, top = F.col("total_generation_gwh"), F.col("monthly_rank") <= n
    top_gwh, all_gwh = agg.sum_where(top, gwh), F.sum(gwh)
    return ranking.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("stations"), (safe_ratio(top_gwh, all_gwh) * 100.0).alias("top_share_pct")
    )


# ---- prices ----------------------------------------------------------------------------------


def price_view(
    df: DataFrame, islands=None, start: date | None = None, end: date | None = None, nodes=None
) -> DataFrame:
    """The filters every price page offers."""
    return keep_values(keep_values(date_slice(df, "trading_date", start, end), "island", islands), "poc_code", nodes)


def price_kpis(price_daily: DataFrame) -> DataFrame:
    spikes, negatives, periods = F.sum("spike_tp_count"), F.sum("negative_tp_count"), F.sum("tp_count")
    return price_daily.agg(
        F.count(F.lit(1)).alias("node_days"),
        F.avg("avg_price_all").alias("avg_price"),
        F.max("max_price").alias("peak_price"),
        spikes.alias("spike_periods"),
        safe_ratio(spikes, periods).alias("spike_rate"),
        negatives.alias("negative_periods"),
        safe_ratio(negatives, periods).alias("negative_rate"),
    )


def price_by_island(price_daily: DataFrame) -> DataFrame:
    """Daily mean of node averages; nodes without an island form their own line."""
    return price_daily.groupBy("trading_date", "island").agg(F.avg("avg_price_all").alias("avg_price_all"))


def daily_outlier_counts(price_daily: DataFrame) -> DataFrame:
    return price_daily.groupBy("trading_date").agg(
        F.sum("spike_tp_count").alias("spike_tp_count"), F.sum("negative_tp_count").alias("negative_tp_count")
    )


def price_histogram(price_daily: DataFrame, bins: int = 40) -> DataFrame:
    return agg.histogram(price_daily, "avg_price_all", bins, ["island"])


def spike_kpis(spikes: DataFrame) -> DataFrame:
    top = agg.mode(spikes, "poc_code", "top_node_events").withColumnRenamed("poc_code", "top_node")
    unmatched = agg.count_where(F.coalesce("unmatched_generation", F.lit(False)))
    head = spikes.agg(
        F.count(F.lit(1)).alias("spike_events"),
        F.count_distinct("poc_code").alias("nodes"),
        F.max("price_nzd_mwh").alias("peak_price"),
        (safe_ratio(unmatched, F.count(F.lit(1))) * 100.0).alias("unmatched_pct"),
    )
    return head.select(
        "*", top.select("top_node").scalar().alias("top_node"),
        top.select("top_node_events").scalar().alias("top_node_events"),
    )


def spike_density(spikes: DataFrame) -> DataFrame:
    """Day by trading-period matrix of spike counts."""
    labels = {i: f"tp{i}" for i in range(1, 51)}
    return pivot_filled(spikes, "trading_date", "tp_number", labels, F.count(F.lit(1)), fill=0)


def top_spike_nodes(spikes: DataFrame, n: int = 20) -> DataFrame:
    """Nodes with most spikes, the higher peak first among equals."""
    nodes = spikes.groupBy("poc_code", "island").agg(
        F.count(F.lit(1)).alias("spike_events"), F.max("price_nzd_mwh").alias("peak_price")
    )
    return top_n(nodes, n, F.col("spike_events").desc(), F.col("peak_price").desc(), F.col("poc_code"))


def spike_mix(spikes: DataFrame) -> DataFrame:
    """Renewable and thermal energy during matched spikes, per day in long form."""
    matched = spikes.filter(~F.coalesce("unmatched_generation", F.lit(False))).select(
        "trading_date",
        F.col("renewable_generation_kwh").alias("renewable_kwh"),
        F.col("thermal_generation_kwh").alias("thermal_kwh"),
    )
    return melt_sum(matched, ["trading_date"], ["renewable_kwh", "thermal_kwh"], "source", "kwh")


def island_spread(price_daily: DataFrame, north: str = "NI", south: str = "SI") -> DataFrame:
    """Daily average of both islands and their difference; nodes without an island stay out."""
    located = price_daily.filter("island IS NOT NULL")
    wide = pivot_filled(located, "trading_date", "island", {north: "ni", south: "si"}, F.avg("avg_price_all"), fill=None)
    return wide.withColumn("spread", F.col("ni") - F.col("si"))


def spread_summary(spread: DataFrame) -> DataFrame:
    mean = F.avg("spread")
    return spread.agg(
        F.avg("ni").alias("avg_ni"),
        F.avg("si").alias("avg_si"),
        mean.alias("mean_spread"),
        F.max(F.abs("spread")).alias("max_abs_spread"),
        F.when(mean > 0, "North Island").when(mean < 0, "South Island").otherwise("Neither island").alias("dearer"),
    )


def renewable_price_kpis(impact: DataFrame) -> DataFrame:
    both = impact.dropna(subset=["renewable_pct", "price_nzd_mwh"])
    return both.agg(
        F.count(F.lit(1)).alias("periods"),
        F.avg("renewable_pct").alias("avg_renewable_pct"),
        F.avg("price_nzd_mwh").alias("avg_price"),
        correlation("renewable_pct", "price_nzd_mwh").alias("correlation"),
    )


def price_by_share_band(impact: DataFrame) -> DataFrame:
    both = impact.dropna(subset=["renewable_pct", "price_nzd_mwh"])
    bands = both.groupBy(share_band("renewable_pct").alias("band")).agg(
        F.count(F.lit(1)).alias("n_tps"), F.avg("price_nzd_mwh").alias("avg_price")
    )
    return bands.withColumn("band_order", ordinal("band", SHARE_BANDS)).orderBy("band_order")


def renewable_price_sample(impact: DataFrame, n: int = 8000) -> DataFrame:
    both = impact.dropna(subset=["renewable_pct", "price_nzd_mwh"])
    return seeded_sample(both, n, ["poc_code", "trading_date", "tp_number"])


# ---- hydro -----------------------------------------------------------------------------------


def latest_storage(driver: DataFrame) -> DataFrame:
    """Per island the latest known value of each measure."""
    measures = ["avg_total_storage_mm3", "storage_pct_of_max", "avg_price_nzd_mwh"]
    return newest_value_per_key(driver, ["island"], "year_month", ["year_month", *measures])


def storage_price_correlation(driver: DataFrame) -> DataFrame:
    """Per island; needs three months that have both measures."""
    r = driver.groupBy("island").agg(
        correlation("avg_total_storage_mm3", "avg_price_nzd_mwh", min_points=3).alias("correlation")
    )
    return r.withColumn("reading", direction("correlation"))


# ---- market context --------------------------------------------------------------------------


def located_spikes(context: DataFrame, dim_node: DataFrame, threshold: float = 300) -> DataFrame:
    """Spike rows with node attributes in no order, for aggregates, which would sort in vain."""
    spikes = context.filter(F.col("price_nzd_mwh") > threshold)
    return look_up(spikes, dim_node, "poc_code", ["island", "region", "zone"])


def spike_context(context: DataFrame, dim_node: DataFrame, limit: int | None = None, threshold: float = 300) -> DataFrame:
    """Spike rows of the offer context with node attributes, newest and dearest first."""
    located = located_spikes(context, dim_node, threshold)
    ordered = located.orderBy(F.col("trading_date").desc(), F.col("price_nzd_mwh").desc(), "tp_number", "poc_code")
    return optional_limit(ordered, limit)


def context_window(context: DataFrame, poc: str, day: date, start_tp: int, end_tp: int) -> DataFrame:
    """One node and day around an event, clipped to the periods a day can have."""
    lo, hi = max(1, int(start_tp)), min(50, int(end_tp))
    return context.filter(
        (F.col("poc_code") == poc) & (F.col("trading_date") == F.lit(day)) & F.col("tp_number").between(lo, hi)
    ).select(
        "trading_date", "poc_code", "tp_number", "price_nzd_mwh", "injection_mw", "offtake_mw",
        "total_offered_mw", "offered_mw_at_or_below_100", "offered_mw_at_or_below_300",
        "weighted_avg_offer_price_nzd_mwh", "cheap_offer_share_below_300", "offered_to_offtake_ratio",
    ).orderBy("tp_number")


def windows_around(events: DataFrame, reach: int = 6) -> DataFrame:
    """The half hours around each event (event_tp), clipped to the periods a day can have."""
    around = F.sequence(F.greatest(F.col("tp_number") - reach, F.lit(1)), F.least(F.col("tp_number") + reach, F.lit(50)))
    return events.select(
        "poc_code", "trading_date", F.col("tp_number").alias("event_tp"), F.explode(around).alias("tp_number")
    )


def event_windows(context: DataFrame, events: DataFrame, reach: int = 6) -> DataFrame:
    """context_window for many events at once; events carry poc_code, trading_date, tp_number."""
    return windows_around(events, reach).join(context, ["poc_code", "trading_date", "tp_number"])


KPI_COLUMNS = ("price_nzd_mwh", "total_offered_mw", "offtake_mw", "injection_mw", "cheap_offer_share_below_300")


def context_kpis(spikes: DataFrame) -> DataFrame:
    """Coverage and middle of the spikes; their rows are kept once, as the median passes over them several times."""
    spikes = kept(spikes.select(*KPI_COLUMNS), "spikes")
    has_offer = F.col("total_offered_mw").isNotNull()
    has_volume = F.col("offtake_mw").isNotNull() | F.col("injection_mw").isNotNull()
    head = spikes.agg(
        F.count(F.lit(1)).alias("spike_events"),
        F.max("price_nzd_mwh").alias("peak_price"),
        (agg.rate(has_offer) * 100.0).alias("offer_coverage_pct"),
        (agg.rate(has_volume) * 100.0).alias("volume_coverage_pct"),
        F.avg("cheap_offer_share_below_300").alias("cheap_offer_share"),
    )
    middle = agg.median(spikes, [], "offtake_mw", "median_offtake_mw").scalar()
    return head.withColumn("median_offtake_mw", middle)


def spikes_by_day(spikes: DataFrame) -> DataFrame:
    return spikes.groupBy("trading_date").agg(F.count(F.lit(1)).alias("spike_events"))


def event_list(spikes: DataFrame) -> DataFrame:
    """Labels of the drill-down list in display order."""
    label = event_label("trading_date", "tp_number", "poc_code", "price_nzd_mwh")
    return spikes.orderBy(
        F.col("trading_date").desc(), F.col("tp_number").asc(), F.col("price_nzd_mwh").desc(), "poc_code"
    ).select("trading_date", "tp_number", "poc_code", label.alias("event_label"))


# ---- pipeline health and usage ----------------------------------------------------------------

SLO_FRESHNESS_DAYS = 7
SLO_TEST_PASS_RATE = 0.99
SLO_MODEL_SUCCESS_RATE = 0.95


def slo_status(runs: DataFrame, now, days: int = 30) -> DataFrame:
    """Freshness, model success and test pass rate against their targets, in one row."""
    at = F.lit(now).cast("timestamp_ntz")
    recent = F.col("generated_at") >= at - F.make_dt_interval(days=F.lit(days))
    model, test = F.col("node_type") == "model", F.col("node_type") == "test"
    measured = runs.agg(
        F.max(F.when(model & F.col("is_success"), F.col("generated_at"))).alias("_last"),
        F.avg(F.when(recent & model, F.col("is_success").cast("double"))).alias("model_success_rate"),
        F.avg(F.when(recent & test, (F.col("status") == "pass").cast("double"))).alias("test_pass_rate"),
        F.count_distinct("invocation_id").alias("invocations"),
    )
    age = F.floor(F.timestamp_diff("SECOND", F.col("_last"), at) / 86400)
    return measured.withColumn("freshness_days", age).select(
        "freshness_days",
        on_target("freshness_days", F.col("freshness_days") <= SLO_FRESHNESS_DAYS).alias("freshness_status"),
        "model_success_rate",
        on_target("model_success_rate", F.col("model_success_rate") >= SLO_MODEL_SUCCESS_RATE).alias("model_status"),
        "test_pass_rate",
        on_target("test_pass_rate", F.col("test_pass_rate") >= SLO_TEST_PASS_RATE).alias("test_status"),
        "invocations",
    )


def daily_success(runs: DataFrame, now=None, days: int = 30) -> DataFrame:
    if now is not None:
        at = F.lit(now).cast("timestamp_ntz")
        runs = runs.filter(F.col("generated_at") >= at - F.make_dt_interval(days=F.lit(days)))
    n, ok = F.count(F.lit(1)), agg.count_where(F.col("is_success"))
    return runs.groupBy(F.col("generated_date").alias("date"), "node_type").agg(
        n.alias("n"), ok.alias("success"), safe_ratio(ok, n).alias("success_rate")
    )


def slowest_models(runs: DataFrame, invocations: int = 10, n: int = 10) -> DataFrame:
    """Median run time per model over the most recent invocations, slowest first."""
    models = runs.filter("node_type = 'model'")
    recent = models.join(recent_ids(models, "invocation_id", "generated_at", invocations), "invocation_id", "left_semi")
    medians = agg.median(recent, ["node_name"], "execution_time_seconds", "execution_time_seconds")
    return top_n(medians, n, F.col("execution_time_seconds").desc(), F.col("node_name"))


def latest_problems(runs: DataFrame) -> DataFrame:
    """Nodes whose latest run did not pass."""
    return runs.filter(
        F.col("status").isin("fail", "error", "warn", "skipped") & (F.col("invocation_rank_desc") == 1)
    ).select("generated_at", "node_type", "node_name", "status", "failures", "execution_time_seconds")


def usage_totals(cost: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    recent = cost.filter(F.col("usage_date") >= F.date_sub(F.lit(as_of), days))
    return recent.agg(
        F.sum("credits_used").alias("credits_used"),
        F.sum("usd_estimated").alias("usd_estimated"),
        F.sum("total_queries").alias("total_queries"),
        F.sum("failed_queries").alias("failed_queries"),
    )


def usage_by_day(cost: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    recent = cost.filter(F.col("usage_date") >= F.date_sub(F.lit(as_of), days))
    return recent.groupBy("usage_date", "warehouse_name").agg(F.sum("credits_used").alias("credits_used"))
