"""Staging, dimension, fact and mart models."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registry import stand_ins as s
from registry.base import SQL, query, r4, rounded, sql4, table
from registry.ctes import DATE_KEY, SEASON, SEASON_YEAR, with_
from tidewatt.functions import calendar as cal
from tidewatt.functions.casts import lenient_int
from tidewatt.functions.keys import date_key, surrogate_key
from tidewatt.operators import prefix
from tidewatt.operators.dedup import latest_per_key, newest
from tidewatt.operators.joins import look_up, look_up_seed
from tidewatt.operators.rolling import day_moments, trailing_days
from tidewatt.params import Params
from tidewatt.plans import core, marts, staging
from tidewatt.schemas import MTIME
from tidewatt.session import scratch_path
from tidewatt.sources import seeds, sinks

# ---- staging ---------------------------------------------------------------------------------


@query(
    "unpivot_periods",
    with_("cells", """SELECT site_code, gen_code, trading_date, trading_period, version, reading AS kwh
          FROM cells WHERE raw_fuel_code <> 'Gas&Oil'"""),
)
def unpivot_periods(spark, sf):
    cells = staging.generation_cells(s.raw_generation(spark, sf), seeds.fuel_codes(spark))
    return cells.select(
        "site_code", "gen_code", F.col("trading_date").cast("date").alias("trading_date"), "trading_period",
        (F.dayofmonth(MTIME) - 1).cast("long").alias("version"), F.col("cell").cast("double").alias("kwh"),
    )


@query(
    "stg_generation",
    with_("generation", """SELECT md5(site_code || '-' || gen_code || '-' || trading_date || '-' || trading_period)
          AS generation_id, site_code, poc_code, gen_code, raw_fuel_code, fuel_type, is_renewable, trading_date,
          strftime(trading_date, '%Y%m') AS trading_month, trading_period, generation_kwh FROM generation"""),
)
def stg_generation(spark, sf):
    return s.stg_generation(spark, sf).drop("nwk_code", "tech_code", MTIME)


@query(
    "unmapped_codes",
    """SELECT 'Gas&Oil' AS raw_fuel_code, count(*) AS row_count FROM (
         SELECT DISTINCT user_id, event_type, CAST(ts AS DATE), event_id % 2 FROM events WHERE event_type = 'error')""",
)
def unmapped_codes(spark, sf):
    return staging.unmapped_fuel_codes(s.raw_generation(spark, sf), seeds.fuel_codes(spark))


@query(
    "null_audit",
    with_("cells", """, wide AS (SELECT DISTINCT site_code, gen_code, raw_fuel_code, trading_date, version FROM cells)
          SELECT w.site_code, w.gen_code, w.raw_fuel_code, w.trading_date, CAST(t.tp AS INTEGER) AS trading_period,
            w.version
          FROM wide w, range(1, 47) AS t(tp)
          WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.site_code = w.site_code AND c.gen_code = w.gen_code
            AND c.trading_date = w.trading_date AND c.version = w.version AND c.trading_period = t.tp)"""),
)
def null_audit(spark, sf):
    return staging.stg_generation_null_audit(s.raw_generation(spark, sf)).select(
        "site_code", "gen_code", "raw_fuel_code", "trading_date", "trading_period",
        (F.dayofmonth(MTIME) - 1).cast("long").alias("version"),
    )


@query(
    "stg_price",
    with_("price", """SELECT md5(poc_code || '-' || trading_date || '-' || tp_number) AS price_id, poc_code,
          trading_date, tp_number AS trading_period, price_nzd_mwh, pricing_regime, is_proxy,
          strftime(trading_date, '%Y%m') AS trading_month, mtime AS loaded_at FROM price"""),
)
def stg_price(spark, sf):
    return staging.stg_price(s.raw_price(spark, sf)).withColumnRenamed(MTIME, "loaded_at")


@query(
    "outlier_audit",
    with_("price", """SELECT poc_code, trading_date, tp_number AS trading_period, price_nzd_mwh, pricing_regime,
          CASE WHEN price_nzd_mwh > 300 THEN 'positive_spike' ELSE 'negative_price' END AS outlier_type
          FROM price WHERE price_nzd_mwh > 300 OR price_nzd_mwh < 0"""),
)
def outlier_audit(spark, sf):
    return staging.stg_price_outlier_audit(staging.stg_price(s.raw_price(spark, sf)))


@query(
    "stg_market_volume",
    with_("slots", """SELECT md5('W' || l_linestatus || '-' || poc_code || '-' || participant || '-' || trading_date || '-'
            || tp_number || '-' || CASE WHEN l_returnflag = 'R' THEN 'Injection' ELSE 'Offtake' END) AS market_volume_id,
          poc_code, 'W' || l_linestatus AS network, participant, trading_date, tp_number AS trading_period,
          CASE WHEN l_returnflag = 'R' THEN 'injection' ELSE 'offtake' END AS flow_direction,
          l_quantity*100 AS volume_kwh, strftime(trading_date, '%Y%m') AS trading_month FROM slots"""),
)
def stg_market_volume(spark, sf):
    return staging.stg_market_volume(s.raw_market_volume(spark, sf)).drop("island", "trading_period_start_time", MTIME)


@query(
    "stg_energy_offer",
    with_("offers", """SELECT md5(participant_code || '-' || poc_code || '-' || unit || '-' || trading_date || '-' ||
          tp_number || '-' || tranche) AS offer_id, participant_code, poc_code, unit, trading_date,
          tp_number AS trading_period, tranche, submission_order, offer_mw, offer_price_nzd_mwh, maximum_output_mw,
          CAST(NULL AS DOUBLE) AS forecast_generation_potential_mw, true AS is_latest, 'energy' AS product_type
          FROM offers"""),
)
def stg_energy_offer(spark, sf):
    return staging.stg_energy_offer(s.raw_offers(spark, sf)).select(
        "offer_id", "participant_code", "poc_code", "unit", "trading_date", "trading_period", "tranche",
        "submission_order", "offer_mw", "offer_price_nzd_mwh", "maximum_output_mw",
        "forecast_generation_potential_mw", "is_latest", "product_type",
    )


@query("stg_nsp", with_("nsp", "SELECT * FROM nsp"))
def stg_nsp(spark, sf):
    return staging.stg_nsp(s.raw_nsp(spark, sf)).drop(MTIME)


HYDRO = Params(hydro_floor=date(1996, 1, 1))


@query(
    "stg_hydro_storage",
    with_("hydro", """SELECT site_code, trading_date, active_storage_mm3 AS level_m, active_storage_mm3,
          CAST(NULL AS DOUBLE) AS contingent_storage_mm3, quality_code FROM hydro"""),
)
def stg_hydro_storage(spark, sf):
    return staging.stg_hydro_storage(s.raw_hydro(spark, sf), HYDRO)


@query(
    "stg_run",
    with_("runs", """SELECT invocation_id, generated_at, node_unique_id, node_type, node_name, status,
          execution_time_seconds, failures, CAST(NULL AS VARCHAR) AS message, adapter_message FROM runs"""),
)
def stg_run(spark, sf):
    return staging.stg_run(s.raw_run(spark, sf)).drop("dbt_version", "relation_name")


# ---- scalar expressions ----------------------------------------------------------------------


@query(
    "try_cast_rounding",
    """SELECT o_orderkey, CAST(round(o_totalprice/4) AS INTEGER) AS rounded,
         CAST(NULLIF(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END, '') AS INTEGER) AS blank,
         CAST(left(o_orderpriority, 1) AS INTEGER) AS word FROM orders""",
)
def try_cast_rounding(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        lenient_int(F.col("o_totalprice").cast("decimal(18,2)").cast("double").__truediv__(4).cast("string")).alias("rounded"),
        lenient_int(F.when(F.col("o_orderkey") % 2 == 0, "").otherwise(F.col("o_orderkey").cast("string"))).alias("blank"),
        lenient_int(F.coalesce(F.regexp_extract("o_orderpriority", "^([0-9])", 1), "o_orderpriority")).alias("word"),
    )


@query(
    "surrogate_key",
    """SELECT l_orderkey, l_linenumber, md5(l_orderkey || '-' || l_linenumber || '-' ||
         coalesce(nullif(l_returnflag, 'R'), '_dbt_utils_surrogate_key_null_') || '-' || CAST(l_shipdate AS DATE)) AS key
       FROM lineitem""",
)
def surrogate(spark, sf):
    l = table(spark, sf, "lineitem")
    flag = F.nullif(F.col("l_returnflag"), F.lit("R"))
    return l.select(
        "l_orderkey", "l_linenumber",
        surrogate_key("l_orderkey", "l_linenumber", flag, F.col("l_shipdate").cast("date")).alias("key"),
    )


@query(
    "calendar_fields",
    f"""SELECT o_orderkey, {DATE_KEY.format('o_orderdate')} AS date_key, strftime(o_orderdate, '%Y%m') AS year_month,
         strftime(o_orderdate - INTERVAL 1 MONTH, '%Y%m') AS previous_month,
         CAST(isodow(o_orderdate) AS INTEGER) AS weekday, {SEASON.format('o_orderdate')} AS season,
         {SEASON_YEAR.format('o_orderdate')} AS season_year,
         CASE WHEN o_orderdate < DATE '1998-11-01' THEN 'ex_post' ELSE 'real_time' END AS regime,
         strftime(o_orderdate - INTERVAL 11 MONTH, '%Y%m') AS year_window_start
       FROM orders""",
)
def calendar_fields(spark, sf):
    from tidewatt.functions.measures import pricing_regime

    o = table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    ym = cal.yyyymm("d")
    return o.select(
        "o_orderkey", date_key("d").alias("date_key"), ym.alias("year_month"),
        cal.last_complete_month("d").alias("previous_month"), cal.iso_weekday("d").alias("weekday"),
        cal.season("d").alias("season"), cal.season_year("d").alias("season_year"),
        pricing_regime("d", Params(regime_cutover=date(1998, 11, 1))).alias("regime"),
        cal.months_back(ym, 12).alias("year_window_start"),
    )


@query(
    "yyyymm_prev",
    """SELECT strftime(l_shipdate, '%Y%m') AS year_month, strftime(l_shipdate - INTERVAL 1 MONTH, '%Y%m') AS previous,
         count(*) AS n FROM (SELECT date_trunc('month', l_shipdate) AS l_shipdate FROM lineitem) GROUP BY ALL""",
)
def yyyymm_prev(spark, sf):
    months = table(spark, sf, "lineitem").groupBy(cal.yyyymm("l_shipdate").alias("year_month")).agg(F.count(F.lit(1)).alias("n"))
    return months.select("year_month", cal.shift_month("year_month", -1).alias("previous"), "n")


@query(
    "text_functions",
    """SELECT c_custkey, lower(c_mktsegment) AS low, upper(trim('  ' || c_name || ' ')) AS up,
         replace(substr(c_name, 1, 12), '#', '-') AS part, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS padded,
         coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment, round(abs(c_acctbal)/3 + 1e-9, 2) AS third
       FROM customer""",
)
def text_functions(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        F.lower("c_mktsegment").alias("low"),
        F.upper(F.trim(F.concat(F.lit("  "), "c_name", F.lit(" ")))).alias("up"),
        F.replace(F.substring("c_name", 1, 12), F.lit("#"), F.lit("-")).alias("part"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("padded"),
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("none")).alias("segment"),
        F.round(F.abs("c_acctbal") / 3 + 1e-9, 2).alias("third"),
    )


# ---- dimensions and deduplication ------------------------------------------------------------


@query(
    "date_spine",
    """SELECT d.day, coalesce(o.n, 0) AS orders FROM (
         SELECT CAST(unnest(range(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders) d
       LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) o USING (day)""",
)
def date_spine(spark, sf):
    per_day = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    first, last = per_day.agg(F.min("day"), F.max("day")).first()
    spine = cal.date_spine(spark, first, last, "day")
    return look_up(spine, per_day, "day", ["orders"]).fillna(0, ["orders"])


HOLIDAYS = ", ".join(f"DATE '{line[:10]}'" for line in seeds.PUBLIC_HOLIDAYS.split("\n") if line)


@query(
    "calendar_dimension",
    f"""SELECT trading_date, n AS orders, {DATE_KEY.format('trading_date')} AS date_key,
         CAST(year(trading_date) AS INTEGER) AS year, CAST(quarter(trading_date) AS INTEGER) AS quarter,
         CAST(month(trading_date) AS INTEGER) AS month, CAST(day(trading_date) AS INTEGER) AS day,
         CAST(isodow(trading_date) AS INTEGER) AS day_of_week_iso, isodow(trading_date) IN (6, 7) AS is_weekend,
         {SEASON.format('trading_date')} AS season, {SEASON_YEAR.format('trading_date')} AS season_year,
         trading_date IN ({HOLIDAYS}) AS is_nz_holiday
       FROM (SELECT CAST(o_orderdate AS DATE) + 9131 AS trading_date, count(*) AS n FROM orders GROUP BY 1)""",
)
def calendar_dimension(spark, sf):
    """Order days moved twenty-five years on, into the range of the holiday list."""
    days = table(spark, sf, "orders").groupBy(F.date_add(F.col("o_orderdate").cast("date"), 9131).alias("d")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    dim = core.calendar(days, seeds.public_holidays(spark), "d").drop("holiday_name")
    return look_up(dim, days.withColumnRenamed("d", "trading_date"), "trading_date", ["orders"])


@query(
    "dedup_latest",
    """SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_latest(spark, sf):
    order = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    return latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [newest(c) for c in order])


@query("dedup_tiebreak", with_("node", "SELECT * FROM node"))
def dim_node(spark, sf):
    return s.dim_node(spark, sf)


@query(
    "dim_plant",
    with_("generation", """SELECT md5(site_code || '-' || gen_code) AS plant_id, site_code, gen_code,
          'N' || substr(site_code, 2) AS poc_code, max(fuel_type) AS fuel_type FROM generation GROUP BY site_code, gen_code"""),
)
def dim_plant(spark, sf):
    return core.dim_plant(s.stg_generation(spark, sf)).drop("nwk_code", "tech_code")


@query(
    "dim_fuel",
    with_("history", """SELECT md5(fuel_type) AS fuel_id, fuel_type, bool_or(is_renewable) AS is_renewable,
          count(*) AS readings FROM history GROUP BY fuel_type"""),
)
def dim_fuel(spark, sf):
    readings = s.history(spark, sf).groupBy("fuel_type").agg(F.count(F.lit(1)).alias("readings"))
    return look_up_seed(readings, core.dim_fuel(seeds.fuel_codes(spark)), "fuel_type").select(
        "fuel_id", "fuel_type", "is_renewable", "readings"
    )


# ---- facts -----------------------------------------------------------------------------------


@query(
    "fct_generation",
    with_("generation", """SELECT md5(site_code || '-' || gen_code) AS plant_id, site_code, gen_code, fuel_type,
          is_renewable, trading_date, trading_period, generation_kwh FROM generation"""),
)
def fct_generation(spark, sf):
    return core.fct_generation(s.stg_generation(spark, sf)).drop("generation_id", "trading_month")


@query("date_key", with_("price", "SELECT * EXCLUDE mtime FROM price"))
def fct_price(spark, sf):
    return s.fct_price(spark, sf).drop(MTIME)


@query("volume_pivot", with_("volume", "SELECT * FROM volume"))
def fct_market_volume(spark, sf):
    return s.fct_market_volume(spark, sf).drop(MTIME)


@query(
    "offer_stack",
    with_("stack", f"""SELECT participant_code, poc_code, unit, trading_date, tp_number, tranche, offer_mw,
          offer_price_nzd_mwh, {sql4('offer_mw*offer_price_nzd_mwh', 'offered_mw_price_value')},
          {sql4('cumulative_offered_mw')} FROM stack"""),
)
def offer_stack(spark, sf):
    return rounded(s.fct_offer_stack(spark, sf), "offered_mw_price_value", "cumulative_offered_mw").select(
        "participant_code", "poc_code", "unit", "trading_date", "tp_number", "tranche", "offer_mw",
        "offer_price_nzd_mwh", "offered_mw_price_value", "cumulative_offered_mw",
    )


@query(
    "fct_hydro",
    with_("hydro", """SELECT md5(site_code || '-' || trading_date) AS hydro_id, date_key, trading_date, site_code,
          island, active_storage_mm3, quality_code FROM hydro"""),
)
def fct_hydro(spark, sf):
    return s.fct_hydro(spark, sf, HYDRO).select(
        "hydro_id", "date_key", "trading_date", "site_code", "island", "active_storage_mm3", "quality_code"
    )


@query(
    "run_recency",
    with_("runs", """SELECT invocation_id, generated_at, generated_date, node_unique_id, status, is_success,
          invocation_rank_desc FROM runs"""),
)
def run_recency(spark, sf):
    return s.fct_run(spark, sf).select(
        "invocation_id", "generated_at", "generated_date", "node_unique_id", "status", "is_success",
        "invocation_rank_desc",
    )


@query("generation_by_poc", with_("by_poc", "SELECT * FROM by_poc"))
def generation_by_poc(spark, sf):
    return core.int_generation_by_poc(s.stg_generation(spark, sf))


@query(
    "daily_window_avg",
    with_("price", f"""SELECT poc_code, trading_date, tp_number, price_nzd_mwh, is_proxy, pricing_regime,
          {sql4('avg(price_nzd_mwh) OVER w', 'avg_price_all')},
          {sql4('avg(CASE WHEN NOT is_proxy THEN price_nzd_mwh END) OVER w', 'avg_price_non_proxy')}
          FROM price WINDOW w AS (PARTITION BY poc_code, trading_date)"""),
)
def daily_window_avg(spark, sf):
    return rounded(core.int_price_daily(s.fct_price(spark, sf)), "avg_price_all", "avg_price_non_proxy")


# ---- generation marts ------------------------------------------------------------------------


@query(
    "generation_daily",
    with_("history", """SELECT trading_date, fuel_type, CAST(sum(generation_kwh) AS BIGINT) AS total_generation_kwh,
          CAST(sum(generation_kwh) AS DOUBLE)/1e6 AS total_generation_gwh, count(DISTINCT gen_code) AS generator_count
          FROM history GROUP BY ALL"""),
)
def generation_daily(spark, sf):
    return marts.mart_generation_daily(s.history(spark, sf))


@query("monthly_two_distincts", with_("monthly", "SELECT * FROM monthly"))
def generation_monthly(spark, sf):
    return marts.mart_generation_monthly(s.history(spark, sf))


@query("plant_rank", with_("ranking", "SELECT * FROM ranking"))
def plant_rank(spark, sf):
    return marts.mart_plant_ranking(s.history(spark, sf), rank_step_kwh=50_000.0)


@query("renewable_ratio", with_("ratio", "SELECT * FROM ratio"))
def renewable_ratio(spark, sf):
    return marts.mart_renewable_ratio(s.history(spark, sf))


SEASONAL = ("total_generation_gwh", "avg_generation_gwh")


@query(
    "seasonal_pattern",
    with_("seasonal", f"SELECT season_year, season, fuel_type, {', '.join(sql4(c) for c in SEASONAL)} FROM seasonal"),
)
def seasonal_pattern(spark, sf):
    return rounded(marts.mart_seasonal_pattern(s.history(spark, sf)), *SEASONAL)


# ---- price marts -----------------------------------------------------------------------------


STATS = ("avg_price_all", "avg_price_non_proxy", "stddev_price")


@query(
    "price_daily",
    with_("price_daily", f"SELECT * REPLACE ({', '.join(sql4(c) for c in STATS)}) FROM price_daily"),
)
def price_daily(spark, sf):
    return rounded(marts.mart_price_daily(s.fct_price(spark, sf), s.dim_node(spark, sf)), *STATS)


@query("spike_events", with_("spikes", "SELECT * FROM spikes"))
def spike_events(spark, sf):
    return marts.mart_price_spike_events(
        s.fct_price(spark, sf), core.int_generation_by_poc(s.stg_generation(spark, sf)), s.dim_node(spark, sf)
    )


ZS = ("rolling_30d_avg_price", "rolling_30d_stddev_price", "price_z_score")
Z_SQL = """, z AS (SELECT *, CASE WHEN sd > 0 THEN (price_nzd_mwh - mean)/sd END AS price_z_score FROM (
     SELECT *, avg(price_nzd_mwh) OVER w AS mean, stddev_samp(price_nzd_mwh) OVER w AS sd
     FROM (SELECT *, CAST(trading_date AS TIMESTAMP) + (tp_number - 1)*INTERVAL 30 MINUTES AS start_ts FROM price)
     WINDOW w AS (PARTITION BY poc_code ORDER BY start_ts
                  RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND INTERVAL 1 SECOND PRECEDING)))"""
Z_COLUMNS = f"""{sql4('mean', 'rolling_30d_avg_price')}, {sql4('sd', 'rolling_30d_stddev_price')},
     {sql4('price_z_score')}"""


@query(
    "anomaly_range_window",
    with_("price volume node", Z_SQL.format(days=30) + f"""
      SELECT z.poc_code, z.trading_date, z.tp_number, z.price_nzd_mwh, z.pricing_regime, z.is_proxy, {Z_COLUMNS},
        CASE WHEN price_nzd_mwh > 300 THEN 'positive_spike' WHEN price_nzd_mwh < 0 THEN 'negative_price'
          ELSE 'statistical_outlier' END AS anomaly_type,
        v.injection_kwh, v.offtake_kwh, v.net_injection_kwh, coalesce(n.island, v.island) AS island, n.region, n.zone
      FROM z LEFT JOIN volume v USING (poc_code, trading_date, tp_number) LEFT JOIN node n USING (poc_code)
      WHERE price_nzd_mwh > 300 OR price_nzd_mwh < 0 OR abs(price_z_score) >= 3"""),
)
def anomaly_events(spark, sf):
    return rounded(
        marts.mart_price_anomaly_events(s.fct_price(spark, sf), s.fct_market_volume(spark, sf), s.dim_node(spark, sf)),
        *ZS,
    )


@query(
    "rolling_week_scores",
    with_("price", Z_SQL.format(days=7) + f"""
      SELECT poc_code, trading_date, tp_number, price_nzd_mwh, pricing_regime, is_proxy, {Z_COLUMNS} FROM z"""),
)
def rolling_week_scores(spark, sf):
    """Every price scored against the preceding seven days."""
    return rounded(marts.price_z_scores(s.fct_price(spark, sf), days=7), *ZS)


@query(
    "rolling_shipments",
    f"""SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity,
         {sql4('avg(l_quantity) OVER w', 'mean')}, {sql4('stddev_samp(l_quantity) OVER w', 'sd')}
       FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate
         RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 SECOND PRECEDING)""",
)
def rolling_shipments(spark, sf):
    """The 30-day frame over seven years, many rows per instant."""
    l = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity"
    )
    return rounded(
        trailing_days(l, ["l_suppkey"], cal.wall_second("l_shipdate"), "l_quantity", "mean", "sd"), "mean", "sd"
    )


@query("rolling_kept_state", SQL["rolling_shipments"])
def rolling_kept_state(spark, sf):
    """The same frames in two loads: the second sees its own rows, the month before them, and the saved moments of days."""
    columns = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity"]
    l, second, path = table(spark, sf, "lineitem").select(*columns), cal.wall_second("l_shipdate"), scratch_path(spark, "moments")
    since, keys = date(1998, 3, 1), ["l_suppkey"]
    day = (since - date(1970, 1, 1)).days
    before = l.filter(F.col("l_shipdate") < F.lit(since))
    sinks.replace_all(day_moments(before, keys, second, "l_quantity"), path)
    first = trailing_days(before, keys, second, "l_quantity", "mean", "sd")
    saved = spark.read.parquet(path)
    new = l.filter(F.col("l_shipdate") >= F.lit(since))
    kept = saved.unionByName(day_moments(new, keys, second, "l_quantity"))
    recent = l.filter(F.col("l_shipdate") >= F.date_sub(F.lit(since), 30))
    rest = trailing_days(recent, keys, second, "l_quantity", "mean", "sd", kept=kept, since=day)
    return rounded(first.unionByName(rest), "mean", "sd")


@query(
    "running_quantity",
    """SELECT k, l_extendedprice, l_orderkey, l_linenumber, l_quantity, sum(l_quantity) OVER (PARTITION BY k
         ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_quantity, l_discount, l_tax ROWS UNBOUNDED PRECEDING) AS running
       FROM (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN -1 ELSE l_suppkey % 10 END AS k FROM lineitem)""",
    k="BIGINT",
)
def running_quantity(spark, sf):
    """A running sum by price, in groups of which one has a third of all rows."""
    l = table(spark, sf, "lineitem").withColumn("k", F.when(F.col("l_suppkey") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("l_suppkey") % 10))
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"]
    found = prefix.running_sum_ranged(l.select("k", *order), ["k"], order, "l_quantity", "running")
    return found.select("k", "l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity", "running")


CURVE = ("total_offered_mw", "avg_offer_price_nzd_mwh", "weighted_avg_offer_price_nzd_mwh",
         "max_cumulative_offered_mw", "cheap_offer_share_below_300")


@query("offer_curve", with_("curve", f"SELECT * REPLACE ({', '.join(sql4(c) for c in CURVE)}) FROM curve"))
def offer_curve(spark, sf):
    return rounded(s.mart_offer_curve(spark, sf).drop(MTIME), *CURVE)


@query(
    "weighted_avg",
    f"""SELECT l_suppkey, {sql4('sum(l_quantity*l_discount)/sum(l_quantity)', 'weighted_discount')},
         sum(CASE WHEN l_discount <= 0 THEN l_quantity ELSE 0 END) AS qty_0,
         sum(CASE WHEN l_discount <= 1 THEN l_quantity ELSE 0 END) AS qty_1 FROM lineitem GROUP BY l_suppkey""",
)
def weighted_avg(spark, sf):
    from tidewatt.operators.aggregates import sums_up_to
    from tidewatt.operators.aggregates import weighted_avg as wavg

    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        r4(wavg("l_discount", "l_quantity")).alias("weighted_discount"),
        *sums_up_to("l_discount", "l_quantity", (0, 1), "qty_"),
    )


CONTEXT = ("avg_offer_price_nzd_mwh", "weighted_avg_offer_price_nzd_mwh", "cheap_offer_share_below_300",
           "offered_to_offtake_ratio")


@query(
    "price_offer_context",
    with_("context", f"SELECT * REPLACE ({', '.join(sql4(c) for c in CONTEXT)}) FROM context"),
)
def price_offer_context(spark, sf):
    return rounded(s.price_context(spark, sf), *CONTEXT)


FEATURES = ("rolling_7d_avg_price", "rolling_7d_stddev_price", "rolling_7d_avg_offtake_kwh",
            "weighted_avg_offer_price_nzd_mwh", "cheap_offer_share_below_300", "renewable_pct")


@query(
    "spike_features",
    with_("price volume curve share node", f"""
      SELECT * REPLACE ({', '.join(sql4(c) for c in FEATURES)}) FROM (
      SELECT p.poc_code, p.trading_date, p.tp_number, p.price_nzd_mwh, p.price_nzd_mwh > 300 AS is_price_spike,
        p.pricing_regime, p.is_proxy, lag(p.price_nzd_mwh) OVER o AS previous_tp_price,
        avg(p.price_nzd_mwh) OVER w AS rolling_7d_avg_price, stddev_samp(p.price_nzd_mwh) OVER w AS rolling_7d_stddev_price,
        v.injection_kwh, v.offtake_kwh, v.net_injection_kwh, avg(v.offtake_kwh) OVER w AS rolling_7d_avg_offtake_kwh,
        c.offer_tranche_count, c.offer_participant_count, c.offer_unit_count, c.total_offered_mw,
        c.offered_mw_at_or_below_100, c.offered_mw_at_or_below_300, c.weighted_avg_offer_price_nzd_mwh,
        c.cheap_offer_share_below_300, g.total_generation_kwh AS generation_kwh, g.renewable_generation_kwh,
        CASE WHEN g.total_generation_kwh > 0 THEN 100.0::DOUBLE*g.renewable_generation_kwh/g.total_generation_kwh END
          AS renewable_pct,
        n.island, n.region, CAST(month(p.trading_date) AS INTEGER) AS month,
        CAST(isodow(p.trading_date) AS INTEGER) AS day_of_week_iso, isodow(p.trading_date) IN (6, 7) AS is_weekend,
        p.trading_date IN (DATE '2024-01-01', DATE '2024-01-02') AS is_nz_holiday, 'Summer' AS season
      FROM price p LEFT JOIN volume v USING (poc_code, trading_date, tp_number)
        LEFT JOIN curve c USING (poc_code, trading_date, tp_number)
        LEFT JOIN share g USING (poc_code, trading_date, tp_number) LEFT JOIN node n USING (poc_code)
      WINDOW o AS (PARTITION BY p.poc_code ORDER BY p.trading_date, p.tp_number),
        w AS (PARTITION BY p.poc_code ORDER BY p.trading_date, p.tp_number ROWS BETWEEN 336 PRECEDING AND 1 PRECEDING))"""),
)
def spike_features(spark, sf):
    return rounded(
        marts.mart_price_spike_features(
            s.fct_price(spark, sf), s.fct_market_volume(spark, sf), s.mart_offer_curve(spark, sf),
            core.int_generation_by_poc(s.stg_generation(spark, sf)), s.dim_node(spark, sf),
            core.dim_date(spark, seeds.public_holidays(spark)),
        ),
        *FEATURES,
    )


@query(
    "rolling_rows",
    f"""SELECT *, {sql4('avg(q) OVER w', 'mean')}, {sql4('stddev_samp(q) OVER w', 'sd')},
         lag(q) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, q) AS previous
       FROM (SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity AS q FROM lineitem)
       WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, q
                    ROWS BETWEEN 336 PRECEDING AND 1 PRECEDING)""",
)
def rolling_rows(spark, sf):
    """The 336-row frame over series that are longer than the frame."""
    from tidewatt.operators.rolling import trailing_rows

    l = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("q")
    )
    rolled = trailing_rows(
        l, ["l_suppkey"], "l_shipdate", ["l_orderkey", "l_linenumber", "l_partkey", "q"],
        {"mean": ("q", "avg"), "sd": ("q", "stddev")}, {"previous": "q"},
    )
    return rounded(rolled, "mean", "sd")


@query(
    "renewable_price_impact",
    with_("impact", f"SELECT * REPLACE ({sql4('renewable_pct')}) FROM impact"),
)
def renewable_price_impact(spark, sf):
    return rounded(renewable_impact(spark, sf), "renewable_pct")


def renewable_impact(spark, sf):
    return marts.mart_renewable_price_impact(
        s.fct_price(spark, sf), core.int_generation_by_poc(s.stg_generation(spark, sf)), s.dim_node(spark, sf)
    )


# ---- hydro and usage -------------------------------------------------------------------------


def hydro_driver(spark, sf):
    daily = marts.mart_price_daily(s.history_price(spark, sf), s.dim_node(spark, sf))
    return marts.mart_hydro_price_driver(s.fct_hydro(spark, sf, HYDRO), daily)


DRIVER = ("avg_total_storage_mm3", "min_storage_mm3", "max_storage_mm3", "avg_sites_reporting", "avg_price_nzd_mwh",
          "avg_price_non_proxy")


@query("hydro_price_driver", with_("driver", f"SELECT * REPLACE ({', '.join(sql4(c) for c in DRIVER)}) FROM driver"))
def hydro_price_driver(spark, sf):
    return rounded(hydro_driver(spark, sf), *DRIVER)


USAGE = Params(as_of=date(2001, 8, 1), usage_window_days=900)
COST = ("credits_used_compute", "credits_used_cloud_services", "avg_query_seconds")


def usage(spark, sf):
    return marts.mart_usage_cost(s.metering(spark, sf), s.query_history(spark, sf), USAGE)


@query("usage_cost", with_("cost", f"SELECT * REPLACE ({', '.join(sql4(c) for c in COST)}) FROM cost"))
def usage_cost(spark, sf):
    return rounded(usage(spark, sf), *COST)
