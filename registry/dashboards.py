"""Serving queries over the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registry import stand_ins as s
from registry.base import query, r4, rounded, sql4, table
from registry.ctes import with_
from registry.models import hydro_driver, renewable_impact, usage
from tidewatt.functions.calendar import season
from tidewatt.functions.measures import correlation
from tidewatt.operators import aggregates as agg
from tidewatt.operators.dedup import newest_value_per_key
from tidewatt.operators.joins import only_keys
from tidewatt.operators.serve import top_n
from tidewatt.plans import core, marts, serving
from tidewatt.session import kept


def monthly(spark, sf):
    return marts.mart_generation_monthly(s.history(spark, sf))


def ratio(spark, sf):
    return marts.mart_renewable_ratio(s.history(spark, sf))


def seasonal(spark, sf):
    return marts.mart_seasonal_pattern(s.history(spark, sf))


def ranking(spark, sf):
    return marts.mart_plant_ranking(s.history(spark, sf), rank_step_kwh=50_000.0)


def price_daily(spark, sf):
    return marts.mart_price_daily(s.fct_price(spark, sf), s.dim_node(spark, sf))


def spikes(spark, sf):
    return marts.mart_price_spike_events(
        s.fct_price(spark, sf), core.int_generation_by_poc(s.stg_generation(spark, sf)), s.dim_node(spark, sf)
    )


def context_of_spikes(spark, sf, threshold=300):
    return s.price_context(spark, sf, s.fct_price(spark, sf).filter(F.col("price_nzd_mwh") > threshold))


def spike_context(spark, sf, limit=None):
    return serving.spike_context(context_of_spikes(spark, sf), s.dim_node(spark, sf), limit)


# ---- generation pages ------------------------------------------------------------------------


@query(
    "ranking_listing",
    with_("ranking", """SELECT year_month, site_code, total_generation_gwh, monthly_rank, primary_fuel_type,
          CAST(strptime(year_month || '01', '%Y%m%d') AS DATE) AS date FROM ranking ORDER BY year_month DESC, monthly_rank"""),
)
def ranking_listing(spark, sf):
    return serving.listing(ranking(spark, sf), "mart_plant_ranking")


@query(
    "price_listing",
    with_("price_daily", f"""SELECT trading_date, poc_code, island, region, zone, tp_count, {sql4('avg_price_all')},
          min_price, max_price, {sql4('stddev_price')}, spike_tp_count, negative_tp_count, pricing_regime
          FROM price_daily ORDER BY trading_date, poc_code"""),
)
def price_listing(spark, sf):
    return rounded(serving.listing(price_daily(spark, sf), "mart_price_daily"), "avg_price_all", "stddev_price")


TOTALS = ", totals AS (SELECT year_month, sum(total_generation_gwh) AS gwh FROM monthly GROUP BY year_month)"
YOY = f""", yoy AS (SELECT a.year_month, {sql4('a.gwh', 'total_generation_gwh')}, {sql4('b.gwh', 'prior_generation_gwh')},
       {sql4('CASE WHEN b.gwh <> 0 THEN (a.gwh - b.gwh)/b.gwh*100 END', 'yoy_pct')}
     FROM totals a LEFT JOIN totals b ON CAST(a.year_month AS INTEGER) = CAST(b.year_month AS INTEGER) + 100)"""
YOY_COLUMNS = ("total_generation_gwh", "prior_generation_gwh", "yoy_pct")


@query("yoy", with_("monthly", TOTALS + YOY + " SELECT * FROM yoy"))
def yoy(spark, sf):
    return rounded(serving.year_over_year(monthly(spark, sf)), *YOY_COLUMNS)


@query(
    "renewable_yoy",
    with_("ratio", f"""SELECT a.year_month, a.renewable_pct, b.renewable_pct AS prior_renewable_pct,
          {sql4('CASE WHEN b.renewable_pct <> 0 THEN (a.renewable_pct - b.renewable_pct)/b.renewable_pct*100 END', 'yoy_pct')}
          FROM ratio a LEFT JOIN ratio b ON CAST(a.year_month AS INTEGER) = CAST(b.year_month AS INTEGER) + 100"""),
)
def renewable_yoy(spark, sf):
    return rounded(serving.renewable_year_over_year(ratio(spark, sf)), "yoy_pct")


@query(
    "latest_mix",
    with_("monthly", f"""SELECT year_month, fuel_type, {sql4('total_generation_gwh')},
          {sql4('100*total_generation_gwh/sum(total_generation_gwh) OVER ()', 'share_pct')}
          FROM monthly WHERE year_month = (SELECT max(year_month) FROM monthly)"""),
)
def latest_mix(spark, sf):
    return rounded(serving.latest_mix(monthly(spark, sf)), "total_generation_gwh", "share_pct")


@query(
    "last_24_months",
    with_("monthly", TOTALS + f""" SELECT year_month, {sql4('gwh', 'total_generation_gwh')} FROM totals
          ORDER BY year_month DESC LIMIT 24"""),
)
def last_24_months(spark, sf):
    return rounded(serving.last_months(monthly(spark, sf), 24), "total_generation_gwh")


@query(
    "overview",
    with_("monthly ratio price_daily spikes", TOTALS + YOY + f"""
      , mix AS (SELECT fuel_type, total_generation_gwh*100/sum(total_generation_gwh) OVER () AS share FROM monthly
                WHERE year_month = (SELECT max(year_month) FROM monthly))
      SELECT y.*, (SELECT fuel_type FROM mix ORDER BY share DESC, fuel_type LIMIT 1) AS top_fuel,
        {sql4('(SELECT max(share) FROM mix)', 'top_fuel_share_pct')}, r.renewable_pct,
        {sql4('(SELECT avg(avg_price_all) FROM price_daily)', 'avg_price')},
        (SELECT max(max_price) FROM price_daily) AS peak_price, (SELECT count(*) FROM spikes) AS spike_events
      FROM yoy y LEFT JOIN ratio r USING (year_month) WHERE y.year_month = (SELECT max(year_month) FROM monthly)"""),
)
def overview(spark, sf):
    totals = kept(marts.generation_totals(s.history(spark, sf)), "generation-totals")  # a few rows a month, read five times
    head = serving.overview(
        marts.fuel_totals(totals), marts.mart_renewable_ratio(totals), price_daily(spark, sf), spikes(spark, sf)
    )
    return rounded(head, *YOY_COLUMNS, "top_fuel_share_pct", "avg_price")


@query(
    "share_of_total",
    with_("monthly", f"""SELECT year_month, fuel_type, total_generation_kwh,
          {sql4('100*total_generation_gwh/sum(total_generation_gwh) OVER (PARTITION BY year_month)', 'share_pct')}
          FROM monthly"""),
)
def fuel_share(spark, sf):
    view = serving.fuel_share(monthly(spark, sf), "999912", "000001")  # reversed: the slice swaps it
    return rounded(view, "share_pct").select("year_month", "fuel_type", "total_generation_kwh", "share_pct")


@query(
    "rolling_12_min3",
    with_("ratio", f"""SELECT year_month, renewable_pct,
          {sql4('CASE WHEN count(renewable_pct) OVER w >= 3 THEN avg(renewable_pct) OVER w END', 'rolling_pct')}
          FROM ratio WINDOW w AS (ORDER BY year_month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""),
)
def renewable_trend(spark, sf):
    return rounded(serving.renewable_trend(ratio(spark, sf)), "rolling_pct")


@query(
    "argmax_argmin",
    with_("ratio", f"""SELECT {sql4('avg(renewable_pct)', 'avg_pct')},
          (SELECT year_month FROM ratio ORDER BY renewable_pct DESC, year_month LIMIT 1) AS best_month,
          max(renewable_pct) AS best_pct,
          (SELECT year_month FROM ratio ORDER BY renewable_pct, year_month LIMIT 1) AS worst_month,
          min(renewable_pct) AS worst_pct, max(year_month) AS latest_month FROM ratio"""),
)
def renewable_extremes(spark, sf):
    return rounded(serving.renewable_extremes(ratio(spark, sf)), "avg_pct")


@query(
    "renewable_annual",
    with_("ratio", f"""SELECT CAST(left(year_month, 4) AS INTEGER) AS year, {sql4('avg(renewable_pct)', 'renewable_pct')},
          {sql4('sum(renewable_gwh)', 'renewable_gwh')}, {sql4('sum(total_gwh)', 'total_gwh')} FROM ratio GROUP BY 1"""),
)
def renewable_annual(spark, sf):
    return rounded(serving.renewable_annual(ratio(spark, sf)), "renewable_pct", "renewable_gwh", "total_gwh")


@query(
    "season_totals",
    with_("seasonal", f"""SELECT season, fuel_type, {sql4('sum(total_generation_gwh)', 'total_generation_gwh')},
          CAST(CASE season WHEN 'Summer' THEN 1 WHEN 'Autumn' THEN 2 WHEN 'Winter' THEN 3 ELSE 4 END AS BIGINT)
            AS season_order FROM seasonal GROUP BY season, fuel_type"""),
)
def season_totals(spark, sf):
    return rounded(serving.season_totals(seasonal(spark, sf), 0, 9999), "total_generation_gwh")


@query(
    "peak_season",
    with_("seasonal", f"""SELECT season, {sql4('sum(total_generation_gwh)', 'total_generation_gwh')} FROM seasonal
          GROUP BY season ORDER BY sum(total_generation_gwh) DESC, season LIMIT 1"""),
)
def peak_season(spark, sf):
    return rounded(serving.peak_season(seasonal(spark, sf)), "total_generation_gwh")


MONTH_CELLS = ", ".join(
    f"round(coalesce(avg(CASE WHEN substr(year_month, 5, 2) = '{i + 1:02d}' THEN total_generation_gwh END), 0) + 1e-9, 4)"
    f" AS {name}" for i, name in enumerate(serving.MONTHS)
)


@query("pivot_heatmap", with_("monthly", f"SELECT fuel_type, {MONTH_CELLS} FROM monthly GROUP BY fuel_type"))
def pivot_heatmap(spark, sf):
    return rounded(serving.month_heatmap(monthly(spark, sf)), *serving.MONTHS)


@query(
    "top_stations",
    with_("ranking", """SELECT * FROM ranking WHERE year_month = '199807' ORDER BY monthly_rank, site_code LIMIT 10"""),
)
def top_stations(spark, sf):
    return serving.top_stations(ranking(spark, sf), "199807")


@query(
    "topn_share",
    with_("ranking", f"""SELECT year_month, count(*) AS stations,
          {sql4('''100*sum(CASE WHEN monthly_rank <= 10 THEN total_generation_gwh ELSE 0 END)
                   / sum(total_generation_gwh)''', 'top_share_pct')} FROM ranking GROUP BY year_month"""),
)
def concentration(spark, sf):
    return rounded(serving.concentration(ranking(spark, sf)), "top_share_pct")


# ---- price pages -----------------------------------------------------------------------------

VIEW = """, v AS (SELECT * FROM price_daily WHERE island IN ('NI', 'SI')
       AND trading_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25')"""


def price_view(spark, sf):
    return serving.price_view(price_daily(spark, sf), ["NI", "SI"], date(2024, 1, 3), date(2024, 1, 25))


@query(
    "price_kpis",
    with_("price_daily", f"""SELECT count(*) AS node_days, {sql4('avg(avg_price_all)', 'avg_price')},
          max(max_price) AS peak_price, CAST(sum(spike_tp_count) AS BIGINT) AS spike_periods,
          {sql4('sum(spike_tp_count)::DOUBLE/sum(tp_count)::DOUBLE', 'spike_rate')},
          CAST(sum(negative_tp_count) AS BIGINT) AS negative_periods,
          {sql4('sum(negative_tp_count)::DOUBLE/sum(tp_count)::DOUBLE', 'negative_rate')} FROM price_daily"""),
)
def price_kpis(spark, sf):
    return rounded(serving.price_kpis(price_daily(spark, sf)), "avg_price", "spike_rate", "negative_rate")


@query(
    "price_by_island",
    with_("price_daily", f"""SELECT trading_date, island, {sql4('avg(avg_price_all)', 'avg_price_all')}
          FROM price_daily GROUP BY trading_date, island"""),
)
def price_by_island(spark, sf):
    return rounded(serving.price_by_island(price_daily(spark, sf)), "avg_price_all")


@query(
    "daily_outlier_counts",
    with_("price_daily", """SELECT trading_date, CAST(sum(spike_tp_count) AS BIGINT) AS spike_tp_count,
          CAST(sum(negative_tp_count) AS BIGINT) AS negative_tp_count FROM price_daily GROUP BY trading_date"""),
)
def daily_outlier_counts(spark, sf):
    return serving.daily_outlier_counts(price_daily(spark, sf))


@query(
    "price_slice",
    with_("price_daily", VIEW + """ SELECT trading_date, poc_code, island, tp_count, max_price FROM v"""),
)
def price_slice(spark, sf):
    """The page's filter: some islands and days."""
    return price_view(spark, sf).select("trading_date", "poc_code", "island", "tp_count", "max_price")


def bins(value, n):
    return f"""CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor(({value} - lo)/((hi - lo)/{n}::DOUBLE)) + 1, {n}) END
            AS INTEGER)"""


@query(
    "histogram",
    with_("price_daily", f""", l AS (SELECT min(avg_price_all) AS lo, max(avg_price_all) AS hi FROM price_daily)
          SELECT island, {bins('avg_price_all', 40)} AS bin, count(*) AS n FROM price_daily, l GROUP BY 1, 2"""),
)
def histogram(spark, sf):
    return serving.price_histogram(price_daily(spark, sf))


@query(
    "order_value_histogram",
    f"""SELECT {bins('o_totalprice', 30)} AS bin, count(*) AS n
        FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) GROUP BY 1""",
)
def order_value_histogram(spark, sf):
    return agg.histogram(table(spark, sf, "orders"), "o_totalprice", 30)


@query(
    "spike_kpis",
    with_("spikes", f"""SELECT count(*) AS spike_events, count(DISTINCT poc_code) AS nodes, max(price_nzd_mwh) AS peak_price,
          {sql4('100*avg(CASE WHEN unmatched_generation THEN 1.0::DOUBLE ELSE 0 END)', 'unmatched_pct')},
          (SELECT poc_code FROM spikes GROUP BY 1 ORDER BY count(*) DESC, poc_code LIMIT 1) AS top_node,
          (SELECT count(*) FROM spikes GROUP BY poc_code ORDER BY count(*) DESC LIMIT 1) AS top_node_events FROM spikes"""),
)
def spike_kpis(spark, sf):
    return rounded(serving.spike_kpis(spikes(spark, sf)), "unmatched_pct")


@query(
    "unmatched_flag",
    """SELECT c_custkey, o_orderkey IS NULL AS unmatched, count(*) AS n FROM customer
       LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON c_custkey = o_custkey GROUP BY ALL""",
)
def unmatched_flag(spark, sf):
    from tidewatt.operators.joins import with_matched_flag

    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    joined = with_matched_flag(table(spark, sf, "customer").select("c_custkey"), urgent, ["c_custkey"], "unmatched")
    return joined.groupBy("c_custkey", "unmatched").agg(F.count(F.lit(1)).alias("n"))


@query(
    "mode_value",
    """SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 1""",
)
def mode_value(spark, sf):
    return agg.mode(table(spark, sf, "lineitem"), "l_suppkey")


TP_CELLS = ", ".join(f"count(CASE WHEN tp_number = {i} THEN 1 END) AS tp{i}" for i in range(1, 51))


@query("spike_density", with_("spikes", f"SELECT trading_date, {TP_CELLS} FROM spikes GROUP BY trading_date"))
def spike_density(spark, sf):
    return serving.spike_density(spikes(spark, sf))


TOP_NODES = """SELECT poc_code, island, count(*) AS spike_events, max(price_nzd_mwh) AS peak_price FROM {0}
     GROUP BY poc_code, island ORDER BY spike_events DESC, peak_price DESC, poc_code LIMIT {1}"""


@query("top_spike_nodes", with_("spikes", TOP_NODES.format("spikes", 20)))
def top_spike_nodes(spark, sf):
    return serving.top_spike_nodes(spikes(spark, sf), 20)


@query(
    "melt_sum",
    with_("spikes", """SELECT trading_date, source, CAST(sum(kwh) AS BIGINT) AS kwh FROM (
          SELECT trading_date, 'renewable_kwh' AS source, coalesce(renewable_generation_kwh, 0) AS kwh FROM spikes
          WHERE NOT unmatched_generation UNION ALL
          SELECT trading_date, 'thermal_kwh', coalesce(thermal_generation_kwh, 0) FROM spikes
          WHERE NOT unmatched_generation) GROUP BY ALL"""),
)
def spike_mix(spark, sf):
    return serving.spike_mix(spikes(spark, sf))


SPREAD = """, sp AS (SELECT *, ni - si AS spread FROM (SELECT trading_date,
       avg(CASE WHEN island = 'NI' THEN avg_price_all END) AS ni,
       avg(CASE WHEN island = 'SI' THEN avg_price_all END) AS si
     FROM price_daily WHERE island IS NOT NULL GROUP BY trading_date))"""


@query(
    "island_spread",
    with_("price_daily", SPREAD + f" SELECT trading_date, {sql4('ni')}, {sql4('si')}, {sql4('spread')} FROM sp"),
)
def island_spread(spark, sf):
    return rounded(serving.island_spread(price_daily(spark, sf)), "ni", "si", "spread")


@query(
    "island_spread_summary",
    with_("price_daily", SPREAD + f""" SELECT {sql4('avg(ni)', 'avg_ni')}, {sql4('avg(si)', 'avg_si')},
          {sql4('avg(spread)', 'mean_spread')}, {sql4('max(abs(spread))', 'max_abs_spread')},
          CASE WHEN avg(spread) > 0 THEN 'North Island' WHEN avg(spread) < 0 THEN 'South Island'
            ELSE 'Neither island' END AS dearer FROM sp"""),
)
def island_spread_summary(spark, sf):
    summary = serving.spread_summary(serving.island_spread(price_daily(spark, sf)))
    return rounded(summary, "avg_ni", "avg_si", "mean_spread", "max_abs_spread")


BOTH = "WHERE renewable_pct IS NOT NULL AND price_nzd_mwh IS NOT NULL"


@query(
    "renewable_price_kpis",
    with_("impact", f"""SELECT count(*) AS periods, {sql4('avg(renewable_pct)', 'avg_renewable_pct')},
          {sql4('avg(price_nzd_mwh)', 'avg_price')}, {sql4('corr(renewable_pct, price_nzd_mwh)', 'correlation')}
          FROM impact {BOTH}"""),
)
def renewable_price_kpis(spark, sf):
    kpis = serving.renewable_price_kpis(renewable_impact(spark, sf))
    return rounded(kpis, "avg_renewable_pct", "avg_price", "correlation")


BAND = """CASE WHEN renewable_pct >= 100 THEN '100%' WHEN renewable_pct >= 75 THEN '75-99%'
     WHEN renewable_pct >= 50 THEN '50-74%' WHEN renewable_pct >= 25 THEN '25-49%'
     WHEN renewable_pct > 0 THEN '1-24%' ELSE '0%' END"""


@query(
    "share_bands",
    with_("impact", f"""SELECT band, CAST(list_position(['0%','1-24%','25-49%','50-74%','75-99%','100%'], band) AS BIGINT)
            AS band_order, n_tps, {sql4('avg_price')} FROM (
          SELECT {BAND} AS band, count(*) AS n_tps, avg(price_nzd_mwh) AS avg_price FROM impact {BOTH} GROUP BY 1)"""),
)
def share_bands(spark, sf):
    return rounded(serving.price_by_share_band(renewable_impact(spark, sf)), "avg_price")


@query(
    "seeded_sample",
    with_("impact", f"""SELECT poc_code, trading_date, tp_number, price_nzd_mwh, island FROM impact {BOTH}
          ORDER BY md5('42|' || poc_code || '|' || trading_date || '|' || tp_number) LIMIT 2000"""),
)
def sample(spark, sf):
    return serving.renewable_price_sample(renewable_impact(spark, sf), 2000).select(
        "poc_code", "trading_date", "tp_number", "price_nzd_mwh", "island"
    )


@query(
    "correlation",
    f"""SELECT l_suppkey, {sql4('corr(l_quantity, l_extendedprice)', 'r')} FROM lineitem GROUP BY l_suppkey""",
)
def corr(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(r4(correlation("l_quantity", "l_extendedprice")).alias("r"))


# ---- hydro, context, health, usage -----------------------------------------------------------


@query(
    "latest_per_group",
    """SELECT o_custkey, max(o_orderdate) AS o_orderdate, max_by(o_orderpriority, o_orderdate)
         FILTER (WHERE o_orderpriority IS NOT NULL) AS o_orderpriority, CAST(max(n) AS BIGINT) AS orders
       FROM (SELECT o_custkey, o_orderdate, max(nullif(o_orderpriority, '5-LOW')) AS o_orderpriority,
               sum(count(*)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS n FROM orders GROUP BY ALL)
       GROUP BY o_custkey""".replace("GROUP BY ALL", "GROUP BY o_custkey, o_orderdate"),
)
def latest_per_group(spark, sf):
    """Last known priority (5-LOW counts as unknown) and order count per customer."""
    o = table(spark, sf, "orders").withColumn("p", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    per_day = o.groupBy("o_custkey", "o_orderdate").agg(
        F.max("p").alias("o_orderpriority"), F.count(F.lit(1)).alias("_n")
    )
    last = newest_value_per_key(per_day, ["o_custkey"], "o_orderdate", ["o_orderpriority"])
    totals = per_day.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"), F.sum("_n").alias("orders"))
    return totals.join(last, "o_custkey")


@query(
    "latest_storage",
    with_("driver", f"""SELECT island, max(year_month) AS year_month,
          {sql4('max_by(avg_total_storage_mm3, year_month)', 'avg_total_storage_mm3')},
          max_by(storage_pct_of_max, year_month) AS storage_pct_of_max,
          {sql4('max_by(avg_price_nzd_mwh, year_month) FILTER (WHERE avg_price_nzd_mwh IS NOT NULL)', 'avg_price_nzd_mwh')}
          FROM driver GROUP BY island"""),
)
def latest_storage(spark, sf):
    return rounded(serving.latest_storage(hydro_driver(spark, sf)), "avg_total_storage_mm3", "avg_price_nzd_mwh")


@query(
    "storage_price_correlation",
    with_("driver", f"""SELECT island, {sql4('r', 'correlation')}, CASE WHEN r < -0.1 THEN 'expected inverse'
            WHEN r > 0.1 THEN 'positive' ELSE 'weak' END AS reading
          FROM (SELECT island, corr(avg_total_storage_mm3, avg_price_nzd_mwh) AS r FROM driver GROUP BY island)"""),
)
def storage_price_correlation(spark, sf):
    return rounded(serving.storage_price_correlation(hydro_driver(spark, sf)), "correlation")


CONTEXT = """, sc AS (SELECT c.*, n.island, n.region, n.zone FROM context c LEFT JOIN node n USING (poc_code)
       WHERE price_nzd_mwh > 300)"""
CONTEXT_COLUMNS = ("total_offered_mw", "cheap_offer_share_below_300", "offered_to_offtake_ratio")


@query(
    "spike_context",
    with_("context node", CONTEXT + f""" SELECT trading_date, poc_code, tp_number, price_nzd_mwh, offtake_mw,
          {', '.join(sql4(c) for c in CONTEXT_COLUMNS)}, island, region, zone FROM sc
          ORDER BY trading_date DESC, price_nzd_mwh DESC, tp_number, poc_code LIMIT 50"""),
)
def spike_context_query(spark, sf):
    return rounded(spike_context(spark, sf, 50), *CONTEXT_COLUMNS).select(
        "trading_date", "poc_code", "tp_number", "price_nzd_mwh", "offtake_mw", *CONTEXT_COLUMNS, "island",
        "region", "zone",
    )


WINDOW = ("cheap_offer_share_below_300", "offered_to_offtake_ratio", "weighted_avg_offer_price_nzd_mwh")


@query(
    "context_window",
    with_("context", f"""SELECT trading_date, poc_code, tp_number, price_nzd_mwh, injection_mw, offtake_mw, total_offered_mw,
          offered_mw_at_or_below_100, offered_mw_at_or_below_300, {', '.join(sql4(c) for c in WINDOW)}
          FROM context WHERE poc_code = 'N7' AND trading_date = DATE '2024-01-15' AND tp_number BETWEEN 38 AND 50"""),
)
def context_window(spark, sf):
    view = serving.context_window(s.price_context(spark, sf), "N7", date(2024, 1, 15), 38, 56)
    return rounded(view, *WINDOW)


@query(
    "event_windows",
    """WITH p AS (SELECT user_id AS u, CAST(ts AS DATE) AS d, CAST(hour(ts)*2 + floor(minute(ts)/30) + 1 AS INTEGER) AS tp,
         max({'t': ts, 'price': value*2 - 20}).price AS price FROM events GROUP BY 1, 2, 3),
       v AS (SELECT l_suppkey AS u, DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS d, CAST(l_partkey % 48 + 1 AS INTEGER) AS tp,
         sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity*100 ELSE 0 END)/500 AS offtake_mw FROM lineitem GROUP BY 1, 2, 3)
       SELECT 'N' || e.u AS poc_code, e.d AS trading_date, e.tp AS event_tp, c.tp AS tp_number, c.price AS price_nzd_mwh, v.offtake_mw
       FROM p e JOIN p c ON c.u = e.u AND c.d = e.d AND c.tp BETWEEN e.tp - 6 AND e.tp + 6
       LEFT JOIN v ON v.u = c.u AND v.d = c.d AND v.tp = c.tp WHERE e.price > 300""",
)
def event_windows(spark, sf):
    prices = s.fct_price(spark, sf)
    around = serving.windows_around(prices.filter(F.col("price_nzd_mwh") > 300))
    near = kept(only_keys(prices, around, core.TP_KEY), "near-events")
    events = near.filter(F.col("price_nzd_mwh") > 300)
    return serving.event_windows(s.price_context(spark, sf, near), events).select(
        "poc_code", "trading_date", "event_tp", "tp_number", "price_nzd_mwh", "offtake_mw"
    )


@query(
    "context_kpis",
    with_("context node", CONTEXT + f""" SELECT count(*) AS spike_events, max(price_nzd_mwh) AS peak_price,
          {sql4('100*avg(CASE WHEN total_offered_mw IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END)', 'offer_coverage_pct')},
          {sql4('100*avg(CASE WHEN offtake_mw IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END)', 'volume_coverage_pct')},
          {sql4('avg(cheap_offer_share_below_300)', 'cheap_offer_share')},
          {sql4('median(offtake_mw)', 'median_offtake_mw')} FROM sc"""),
)
def context_kpis(spark, sf):
    return rounded(
        serving.context_kpis(serving.located_spikes(context_of_spikes(spark, sf), s.dim_node(spark, sf))), "offer_coverage_pct", "volume_coverage_pct",
        "cheap_offer_share", "median_offtake_mw",
    )


@query(
    "spikes_by_day",
    with_("context node", CONTEXT + " SELECT trading_date, count(*) AS spike_events FROM sc GROUP BY trading_date"),
)
def spikes_by_day(spark, sf):
    return serving.spikes_by_day(spike_context(spark, sf))


@query(
    "event_labels",
    with_("context node", CONTEXT + """ SELECT trading_date, tp_number, poc_code, trading_date || ' TP' ||
          lpad(CAST(tp_number AS VARCHAR), 2, '0') || ' | ' || poc_code || ' | $' ||
          CAST(CAST(round_even(price_nzd_mwh, 0) AS INTEGER) AS VARCHAR) || '/MWh' AS event_label FROM sc"""),
)
def event_labels(spark, sf):
    return serving.event_list(spike_context(spark, sf))


NOW = "2024-01-31 00:00:00"


@query(
    "slo_status",
    with_("runs", """, m AS (SELECT date_diff('second', max(generated_at) FILTER (WHERE node_type = 'model' AND is_success),
            TIMESTAMP '2024-01-31') // 86400 AS freshness_days,
          avg(CASE WHEN is_success THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE node_type = 'model') AS model_success_rate,
          avg(CASE WHEN status = 'pass' THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE node_type = 'test') AS test_pass_rate,
          count(DISTINCT invocation_id) AS invocations FROM runs)
          SELECT freshness_days, CASE WHEN freshness_days <= 7 THEN 'On target' ELSE 'Needs attention' END AS freshness_status,
            round(model_success_rate + 1e-9, 4) AS model_success_rate,
            CASE WHEN model_success_rate >= 0.95 THEN 'On target' ELSE 'Needs attention' END AS model_status,
            round(test_pass_rate + 1e-9, 4) AS test_pass_rate,
            CASE WHEN test_pass_rate >= 0.99 THEN 'On target' ELSE 'Needs attention' END AS test_status, invocations FROM m"""),
)
def slo_status(spark, sf):
    return rounded(serving.slo_status(s.fct_run(spark, sf), NOW), "model_success_rate", "test_pass_rate")


@query(
    "success_rate",
    with_("runs", f"""SELECT generated_date AS date, node_type, count(*) AS n,
          CAST(sum(CASE WHEN is_success THEN 1 ELSE 0 END) AS BIGINT) AS success,
          {sql4('avg(CASE WHEN is_success THEN 1.0::DOUBLE ELSE 0 END)', 'success_rate')}
          FROM runs GROUP BY ALL"""),
)
def success_rate(spark, sf):
    return rounded(serving.daily_success(s.fct_run(spark, sf), NOW, 36500), "success_rate")


@query(
    "pass_rate",
    with_("runs", f"""SELECT {sql4('100*avg(CASE WHEN is_success THEN 1.0::DOUBLE ELSE 0 END)', 'pass_rate_pct')}
          FROM runs WHERE invocation_rank_desc = 1"""),
)
def pass_rate(spark, sf):
    return rounded(serving.pass_rate(s.fct_run(spark, sf)), "pass_rate_pct")


@query(
    "median_topn",
    with_("runs", f"""SELECT node_name, {sql4('median(execution_time_seconds)', 'execution_time_seconds')}
          FROM runs WHERE node_type = 'model' AND invocation_id IN (
            SELECT invocation_id FROM runs WHERE node_type = 'model' GROUP BY 1
            ORDER BY max(generated_at) DESC, invocation_id LIMIT 10)
          GROUP BY node_name ORDER BY median(execution_time_seconds) DESC, node_name LIMIT 10"""),
)
def slowest_models(spark, sf):
    return rounded(serving.slowest_models(s.fct_run(spark, sf)), "execution_time_seconds")


@query(
    "median_by_supplier",
    f"""SELECT l_suppkey, {sql4('median(l_extendedprice)', 'middle')} FROM lineitem GROUP BY l_suppkey""",
)
def median_by_supplier(spark, sf):
    return rounded(agg.median(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", "middle"), "middle")


@query("median_overall", f"SELECT {sql4('median(o_totalprice)', 'middle')} FROM orders")
def median_overall(spark, sf):
    return rounded(agg.median(table(spark, sf, "orders"), [], "o_totalprice", "middle"), "middle")


@query(
    "latest_problems",
    with_("runs", """SELECT generated_at, node_type, node_name, status, failures, execution_time_seconds FROM runs
          WHERE status IN ('fail', 'error', 'warn', 'skipped') AND invocation_rank_desc = 1"""),
)
def latest_problems(spark, sf):
    return serving.latest_problems(s.fct_run(spark, sf))


@query(
    "usage_totals",
    with_("cost", """SELECT sum(credits_used) AS credits_used, sum(usd_estimated) AS usd_estimated,
          CAST(sum(total_queries) AS BIGINT) AS total_queries, CAST(sum(failed_queries) AS BIGINT) AS failed_queries
          FROM cost WHERE usage_date >= DATE '2001-08-01' - 30"""),
)
def usage_totals(spark, sf):
    return serving.usage_totals(usage(spark, sf), date(2001, 8, 1))


@query(
    "usage_by_day",
    with_("cost", """SELECT usage_date, warehouse_name, credits_used FROM cost
          WHERE usage_date >= DATE '2001-08-01' - 30"""),
)
def usage_by_day(spark, sf):
    return serving.usage_by_day(usage(spark, sf), date(2001, 8, 1))


@query(
    "top_orders",
    """SELECT o_orderkey, o_totalprice, o_orderdate,
         CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Summer' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Autumn'
           WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END AS season
       FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
)
def top_orders(spark, sf):
    top = top_n(table(spark, sf, "orders"), 20, F.col("o_totalprice").desc(), F.col("o_orderkey"))
    return top.select("o_orderkey", "o_totalprice", "o_orderdate", season("o_orderdate").alias("season"))


