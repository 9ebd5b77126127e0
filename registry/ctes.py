"""The same derived tables as SQL common table expressions."""

from __future__ import annotations

PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    PARTS[name] = (needs, sql)


def with_(names: str, body: str) -> str:
    """Prefix body with the named expressions and what they need."""
    ordered: list[str] = []

    def visit(n):
        for need in PARTS[n][0]:
            visit(need)
        if n not in ordered:
            ordered.append(n)

    for n in names.split():
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in ordered) + "\n" + body


DATE_KEY = "CAST(year({0})*10000 + month({0})*100 + day({0}) AS INTEGER)"

cte(
    "raw_price",
    """SELECT 'N' || user_id AS poc_code, CAST(ts AS DATE) AS trading_date,
         CAST(hour(ts)*2 + floor(minute(ts)/30) + 1 AS INTEGER) AS tp_number, value*2 - 20 AS price_nzd_mwh,
         ts AS mtime FROM events""",
)
cte(
    "price",
    f"""SELECT {DATE_KEY.format('trading_date')} AS date_key, trading_date, poc_code, tp_number, price_nzd_mwh,
         false AS is_proxy,
         CASE WHEN trading_date < DATE '2022-11-01' THEN 'ex_post' ELSE 'real_time' END AS pricing_regime, mtime
       FROM (SELECT *, row_number() OVER (PARTITION BY poc_code, trading_date, tp_number
                                          ORDER BY mtime DESC, price_nzd_mwh DESC) AS rn FROM raw_price)
       WHERE rn = 1""",
    "raw_price",
)
FUEL_EVENT = """CASE event_type WHEN 'click' THEN 'HYD' WHEN 'view' THEN 'Gas' WHEN 'purchase' THEN 'Wind'
       WHEN 'signup' THEN 'Coal' WHEN 'error' THEN 'Gas&Oil' END"""
FUEL_TYPE = """CASE {0} WHEN 'HYD' THEN 'Hydro' WHEN 'Gas' THEN 'Gas' WHEN 'Wind' THEN 'Wind' WHEN 'Coal' THEN 'Coal'
       WHEN 'GEO' THEN 'Geothermal' WHEN 'ELE' THEN 'Battery' END"""
GREEN = "fuel_type IN ('Hydro', 'Wind', 'Geothermal')"
cte(
    "cells",
    f"""SELECT 'S' || user_id AS site_code, 'N' || user_id AS poc_code, event_type AS gen_code,
         {FUEL_EVENT} AS raw_fuel_code, CAST(ts AS DATE) AS trading_date,
         CAST(hour(ts)*2 + floor(minute(ts)/30) + 1 AS INTEGER) AS trading_period,
         event_id % 2 AS version, max(value*10) AS reading
       FROM events GROUP BY ALL""",
)
cte(
    "generation",
    f"""SELECT * EXCLUDE (rn, reading, version), {GREEN} AS is_renewable FROM (
         SELECT *, {FUEL_TYPE.format('raw_fuel_code')} AS fuel_type, CAST(round(reading) AS INTEGER) AS generation_kwh,
           row_number() OVER (PARTITION BY site_code, gen_code, trading_date, trading_period
                              ORDER BY version DESC) AS rn
         FROM cells WHERE raw_fuel_code <> 'Gas&Oil') WHERE rn = 1""",
    "cells",
)
cte(
    "by_poc",
    """SELECT poc_code, trading_date, trading_period AS tp_number, fuel_type, is_renewable,
         CAST(sum(generation_kwh) AS BIGINT) AS generation_kwh FROM generation GROUP BY ALL""",
    "generation",
)
cte(
    "share",
    """SELECT poc_code, trading_date, tp_number, CAST(sum(generation_kwh) AS BIGINT) AS total_generation_kwh,
         CAST(sum(CASE WHEN is_renewable THEN generation_kwh ELSE 0 END) AS BIGINT) AS renewable_generation_kwh,
         CAST(sum(CASE WHEN NOT is_renewable THEN generation_kwh ELSE 0 END) AS BIGINT) AS thermal_generation_kwh
       FROM by_poc GROUP BY ALL""",
    "by_poc",
)
cte(
    "slots",
    """SELECT *, 'N' || l_suppkey AS poc_code, DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS trading_date,
         CAST(l_partkey % 48 + 1 AS INTEGER) AS tp_number, 'P' || l_linenumber AS participant FROM lineitem""",
)
cte(
    "volume",
    f"""SELECT {DATE_KEY.format('trading_date')} AS date_key, *, injection_kwh - offtake_kwh AS net_injection_kwh FROM (
         SELECT poc_code, trading_date, tp_number, max('W' || l_linestatus) AS network,
           max(CASE WHEN l_linestatus = 'O' THEN 'NI' ELSE 'SI' END) AS island,
           count(DISTINCT participant) AS participant_count,
           sum(CASE WHEN l_returnflag = 'R' THEN l_quantity*100 ELSE 0 END) AS injection_kwh,
           sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity*100 ELSE 0 END) AS offtake_kwh
         FROM slots GROUP BY poc_code, trading_date, tp_number)""",
    "slots",
)
cte(
    "offers",
    """SELECT * EXCLUDE rn FROM (
         SELECT participant AS participant_code, poc_code, 'U' || l_returnflag AS unit, trading_date, tp_number,
           l_linenumber AS tranche, l_quantity AS offer_mw, l_extendedprice/100 - 50 AS offer_price_nzd_mwh,
           l_quantity*2 AS maximum_output_mw, CAST(round(l_discount*100) AS INTEGER) AS submission_order,
           row_number() OVER (PARTITION BY participant, poc_code, l_returnflag, trading_date, tp_number, l_linenumber
             ORDER BY round(l_discount*100) DESC, l_shipdate DESC, l_extendedprice DESC, l_quantity DESC) AS rn
         FROM slots WHERE l_discount < 0.085 AND l_tax < 0.065) WHERE rn = 1""",
    "slots",
)
cte(
    "stack",
    """SELECT *, sum(offer_mw) OVER (PARTITION BY poc_code, trading_date, tp_number
           ORDER BY offer_price_nzd_mwh, tranche, participant_code, unit
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_offered_mw FROM offers""",
    "offers",
)
cte(
    "curve",
    f"""SELECT {DATE_KEY.format('trading_date')} AS date_key, *,
         CASE WHEN total_offered_mw <> 0 THEN offered_mw_at_or_below_300 / total_offered_mw END
           AS cheap_offer_share_below_300
       FROM (SELECT poc_code, trading_date, tp_number, count(*) AS offer_tranche_count,
           count(DISTINCT participant_code) AS offer_participant_count, count(DISTINCT unit) AS offer_unit_count,
           sum(offer_mw) AS total_offered_mw,
           sum(CASE WHEN offer_price_nzd_mwh <= 0 THEN offer_mw ELSE 0 END) AS offered_mw_at_or_below_0,
           sum(CASE WHEN offer_price_nzd_mwh <= 100 THEN offer_mw ELSE 0 END) AS offered_mw_at_or_below_100,
           sum(CASE WHEN offer_price_nzd_mwh <= 300 THEN offer_mw ELSE 0 END) AS offered_mw_at_or_below_300,
           sum(CASE WHEN offer_price_nzd_mwh <= 500 THEN offer_mw ELSE 0 END) AS offered_mw_at_or_below_500,
           min(offer_price_nzd_mwh) AS min_offer_price_nzd_mwh, max(offer_price_nzd_mwh) AS max_offer_price_nzd_mwh,
           avg(offer_price_nzd_mwh) AS avg_offer_price_nzd_mwh,
           CASE WHEN sum(offer_mw) <> 0 THEN sum(offer_mw*offer_price_nzd_mwh)/sum(offer_mw) END
             AS weighted_avg_offer_price_nzd_mwh,
           max(cumulative_offered_mw) AS max_cumulative_offered_mw
         FROM stack GROUP BY poc_code, trading_date, tp_number)""",
    "stack",
)
cte(
    "context",
    """SELECT p.date_key, p.poc_code, p.trading_date, p.tp_number, p.price_nzd_mwh, p.pricing_regime, p.is_proxy,
         v.injection_kwh, v.offtake_kwh, v.net_injection_kwh, v.injection_kwh/500 AS injection_mw,
         v.offtake_kwh/500 AS offtake_mw, c.* EXCLUDE (date_key, poc_code, trading_date, tp_number,
           max_cumulative_offered_mw),
         CASE WHEN v.offtake_kwh <> 0 THEN c.total_offered_mw/(v.offtake_kwh/500) END AS offered_to_offtake_ratio
       FROM price p LEFT JOIN volume v USING (poc_code, trading_date, tp_number)
       LEFT JOIN curve c USING (poc_code, trading_date, tp_number)""",
    "price", "volume", "curve",
)
cte(
    "nsp",
    """SELECT c_name AS nsp_code, 'N' || (c_custkey // 15) AS poc_code, c_mktsegment AS network_participant,
         'GN' AS reconciliation_type, '' AS description, r_name AS region,
         CAST(n_regionkey AS VARCHAR) AS region_id, n_name AS zone,
         CASE WHEN n_regionkey % 2 = 0 THEN 'NI' ELSE 'SI' END AS island,
         CASE WHEN c_custkey % 3 <> 0 THEN CAST(round(c_acctbal*10) AS INTEGER) END AS nztm_easting,
         CAST(NULL AS INTEGER) AS nztm_northing,
         CASE WHEN c_custkey % 7 <> 0 THEN DATE '2000-01-01' + CAST(c_custkey % 1000 AS INTEGER) END AS start_date,
         CAST(NULL AS DATE) AS end_date
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       WHERE c_custkey % 5 <> 0""",
)
cte(
    "node",
    """SELECT md5(poc_code) AS node_id, poc_code, nsp_code, network_participant, reconciliation_type, region,
         region_id, zone, island, nztm_easting, nztm_northing FROM (
         SELECT *, row_number() OVER (PARTITION BY poc_code
           ORDER BY coalesce(start_date, DATE '1900-01-01') DESC, nsp_code) AS rn FROM nsp) WHERE rn = 1""",
    "nsp",
)
DAILY = f"""SELECT {DATE_KEY.format('trading_date')} AS date_key, trading_date, poc_code, n.island, n.region, n.zone,
         n.network_participant, a.* EXCLUDE (poc_code, trading_date) FROM (
         SELECT poc_code, trading_date, count(*) AS tp_count, avg(price_nzd_mwh) AS avg_price_all,
           avg(CASE WHEN NOT is_proxy THEN price_nzd_mwh END) AS avg_price_non_proxy,
           min(price_nzd_mwh) AS min_price, max(price_nzd_mwh) AS max_price,
           stddev_samp(price_nzd_mwh) AS stddev_price,
           CAST(sum(CASE WHEN price_nzd_mwh > 300 THEN 1 ELSE 0 END) AS BIGINT) AS spike_tp_count,
           CAST(sum(CASE WHEN price_nzd_mwh < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_tp_count,
           max(pricing_regime) AS pricing_regime
         FROM {{0}} GROUP BY poc_code, trading_date) a LEFT JOIN node n USING (poc_code)"""
cte("price_daily", DAILY.format("price"), "price", "node")
cte(
    "spikes",
    """SELECT p.poc_code, p.trading_date, p.tp_number, p.price_nzd_mwh, p.pricing_regime, p.is_proxy, n.island,
         n.region, g.total_generation_kwh, g.renewable_generation_kwh, g.thermal_generation_kwh,
         g.poc_code IS NULL AS unmatched_generation
       FROM price p LEFT JOIN share g ON p.poc_code = g.poc_code AND p.trading_date = g.trading_date
         AND p.tp_number = g.tp_number LEFT JOIN node n ON p.poc_code = n.poc_code
       WHERE p.price_nzd_mwh > 300""",
    "price", "share", "node",
)
cte(
    "impact",
    """SELECT p.poc_code, p.trading_date, p.tp_number, p.price_nzd_mwh, p.pricing_regime, g.total_generation_kwh,
         g.renewable_generation_kwh, CASE WHEN g.total_generation_kwh > 0
           THEN 100.0::DOUBLE*g.renewable_generation_kwh/g.total_generation_kwh END AS renewable_pct,
         n.island, n.region
       FROM price p JOIN share g USING (poc_code, trading_date, tp_number) LEFT JOIN node n USING (poc_code)""",
    "price", "share", "node",
)
FUEL_PART = """CASE p_type WHEN 'ECONOMY' THEN 'HYD' WHEN 'STANDARD' THEN 'Gas' WHEN 'PROMO' THEN 'GEO'
       WHEN 'LARGE' THEN 'Wind' WHEN 'MEDIUM' THEN 'ELE' WHEN 'SMALL' THEN 'Gas&Oil' END"""
cte(
    "history",
    f"""SELECT site_code, gen_code, fuel_type, {GREEN} AS is_renewable, trading_date,
         strftime(trading_date, '%Y%m') AS trading_month, trading_period, generation_kwh FROM (
         SELECT *, row_number() OVER (PARTITION BY trading_date, trading_period, site_code, gen_code
             ORDER BY generation_kwh DESC, raw_fuel_code DESC) AS rn FROM (
           SELECT 'S' || l_suppkey AS site_code, 'G' || l_suppkey || '-' || l_linenumber AS gen_code,
             {FUEL_PART} AS raw_fuel_code, {FUEL_TYPE.format(FUEL_PART)} AS fuel_type,
             CAST(l_shipdate AS DATE) AS trading_date, CAST(l_partkey % 48 + 1 AS INTEGER) AS trading_period,
             CAST(round(l_quantity*1000 + l_tax*100/2) AS INTEGER) AS generation_kwh
           FROM lineitem JOIN part ON l_partkey = p_partkey)
         WHERE fuel_type IS NOT NULL) WHERE rn = 1""",
)
cte(
    "monthly",
    """SELECT trading_month AS year_month, fuel_type, CAST(sum(generation_kwh) AS BIGINT) AS total_generation_kwh,
         CAST(sum(generation_kwh) AS DOUBLE)/1e6 AS total_generation_gwh,
         count(DISTINCT gen_code) AS generator_count, count(DISTINCT trading_date) AS active_days
       FROM history GROUP BY trading_month, fuel_type""",
    "history",
)
cte(
    "ratio",
    """SELECT trading_month AS year_month, CAST(sum(generation_kwh) AS BIGINT) AS total_kwh,
         CAST(sum(generation_kwh) AS DOUBLE)/1e6 AS total_gwh,
         CAST(sum(CASE WHEN is_renewable THEN generation_kwh ELSE 0 END) AS BIGINT) AS renewable_kwh,
         CAST(sum(CASE WHEN is_renewable THEN generation_kwh ELSE 0 END) AS DOUBLE)/1e6 AS renewable_gwh,
         round(CAST(sum(CASE WHEN is_renewable THEN generation_kwh ELSE 0 END) AS DOUBLE)*100
               / CAST(sum(generation_kwh) AS DOUBLE), 2) AS renewable_pct
       FROM history GROUP BY trading_month""",
    "history",
)
cte(
    "ranking",
    """SELECT year_month, site_code, total_generation_kwh, total_generation_kwh/1e6 AS total_generation_gwh,
         primary_fuel_type, rank() OVER (PARTITION BY year_month ORDER BY total_generation_kwh DESC) AS monthly_rank
       FROM (SELECT year_month, site_code, CAST(sum(kwh) AS BIGINT) AS total_generation_kwh,
               max(CASE WHEN rn = 1 THEN fuel_type END) AS primary_fuel_type
             FROM (SELECT *, row_number() OVER (PARTITION BY year_month, site_code ORDER BY kwh DESC, fuel_type) AS rn
                   FROM (SELECT trading_month AS year_month, site_code, fuel_type, sum(generation_kwh) AS kwh
                         FROM history GROUP BY ALL))
             GROUP BY year_month, site_code)""",
    "history",
)
SEASON = """CASE WHEN month({0}) IN (12, 1, 2) THEN 'Summer' WHEN month({0}) IN (3, 4, 5) THEN 'Autumn'
       WHEN month({0}) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END"""
SEASON_YEAR = "CAST(year({0}) + CASE WHEN month({0}) = 12 THEN 1 ELSE 0 END AS INTEGER)"
cte(
    "seasonal",
    f"""SELECT {SEASON_YEAR.format('trading_date')} AS season_year, {SEASON.format('trading_date')} AS season, fuel_type,
         CAST(sum(generation_kwh) AS DOUBLE)/1e6 AS total_generation_gwh, avg(generation_kwh)/1e6 AS avg_generation_gwh
       FROM history GROUP BY ALL""",
    "history",
)
cte(
    "price_h",
    """SELECT trading_date, poc_code, tp_number, price_nzd_mwh, false AS is_proxy, 'ex_post' AS pricing_regime FROM (
         SELECT CAST(l_shipdate AS DATE) AS trading_date, 'N' || l_suppkey AS poc_code, l_linenumber AS tp_number,
           l_extendedprice/l_quantity/10 AS price_nzd_mwh,
           row_number() OVER (PARTITION BY l_suppkey, l_shipdate, l_linenumber
             ORDER BY l_extendedprice/l_quantity/10 DESC) AS rn
         FROM lineitem) WHERE rn = 1""",
)
cte("price_daily_h", DAILY.format("price_h"), "price_h", "node")
cte(
    "hydro",
    f"""SELECT s.*, {DATE_KEY.format('trading_date')} AS date_key,
         CASE WHEN site_code = 'SI_XXX' THEN NULL ELSE left(site_code, 2) END AS island FROM (
         SELECT (['NI_TPO','NI_WKA','SI_TKA','SI_PKI','SI_OHA','SI_HWE','SI_WAN','SI_WPU','SI_MAN','SI_TAU','SI_XXX'])
             [CAST(o_custkey % 11 + 1 AS INTEGER)] AS site_code, CAST(o_orderdate AS DATE) AS trading_date,
           o_totalprice/1000 AS active_storage_mm3, CAST(left(o_orderpriority, 1) AS INTEGER) AS quality_code
         FROM orders WHERE NOT (o_orderstatus = 'P' AND o_custkey % 2 = 0)) s
       WHERE trading_date >= DATE '1996-01-01'""",
)
cte(
    "driver",
    """SELECT h.*, p.avg_price_nzd_mwh, p.avg_price_non_proxy, p.price_days, p.poc_count FROM (
         SELECT *, round(100.0::DOUBLE*avg_total_storage_mm3
                         / max(avg_total_storage_mm3) OVER (PARTITION BY island), 1) AS storage_pct_of_max FROM (
           SELECT island, strftime(trading_date, '%Y%m') AS year_month, avg(storage) AS avg_total_storage_mm3,
             min(storage) AS min_storage_mm3, max(storage) AS max_storage_mm3, count(*) AS observation_days,
             avg(sites) AS avg_sites_reporting
           FROM (SELECT island, trading_date, sum(active_storage_mm3) AS storage, count(DISTINCT site_code) AS sites
                 FROM hydro WHERE island IS NOT NULL GROUP BY island, trading_date)
           GROUP BY ALL)) h
       LEFT JOIN (SELECT island, strftime(trading_date, '%Y%m') AS year_month, avg(avg_price_all) AS avg_price_nzd_mwh,
             avg(avg_price_non_proxy) AS avg_price_non_proxy, count(DISTINCT trading_date) AS price_days,
             count(DISTINCT poc_code) AS poc_count
           FROM price_daily_h WHERE island IS NOT NULL GROUP BY ALL) p USING (island, year_month)""",
    "hydro", "price_daily_h",
)
cte(
    "runs",
    """SELECT *, CAST(generated_at AS DATE) AS generated_date, status IN ('pass', 'success') AS is_success,
         row_number() OVER (PARTITION BY node_unique_id ORDER BY generated_at DESC, invocation_id)
           AS invocation_rank_desc
       FROM (SELECT 'inv-' || strftime(ts, '%Y%m%d%H') AS invocation_id, ts AS generated_at, node_type,
           node_type || '.p.m' || user_id AS node_unique_id, 'm' || user_id AS node_name,
           CASE event_type WHEN 'click' THEN 'success' WHEN 'view' THEN 'success' WHEN 'purchase' THEN 'error'
             WHEN 'signup' THEN 'pass' ELSE 'fail' END AS status,
           value AS execution_time_seconds,
           CASE WHEN event_type = 'error' THEN CAST(event_id % 10 AS INTEGER) END AS failures, props AS adapter_message
         FROM (SELECT *, CASE WHEN event_type IN ('error', 'signup') THEN 'test' ELSE 'model' END AS node_type
               FROM events))""",
)
cte(
    "cost",
    """SELECT m.*, credits_used*2 AS usd_estimated, coalesce(q.total_queries, 0) AS total_queries,
         coalesce(q.failed_queries, 0) AS failed_queries, q.avg_query_seconds FROM (
         SELECT CAST(l_shipdate AS DATE) AS usage_date, l_returnflag AS warehouse_name, sum(l_quantity) AS credits_used,
           sum(l_discount) AS credits_used_compute, sum(l_tax) AS credits_used_cloud_services
         FROM lineitem WHERE l_shipdate >= DATE '2001-08-01' - 900 GROUP BY ALL) m
       LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS usage_date,
           CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' END AS warehouse_name, count(*) AS total_queries,
           CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS failed_queries,
           avg(o_totalprice)/1000 AS avg_query_seconds
         FROM orders WHERE o_orderdate >= DATE '2001-08-01' - 900 AND o_orderstatus <> 'P' GROUP BY ALL) q
       USING (usage_date, warehouse_name)""",
)
