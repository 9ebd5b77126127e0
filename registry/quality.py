"""Data checks over the given tables and the derived marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registry import stand_ins as s
from registry.base import query, rounded, sql4, table
from registry.ctes import with_
from tidewatt.functions.calendar import yyyymm
from tidewatt.operators.joins import compare
from tidewatt.plans import core, marts, staging
from tidewatt.plans import quality as q
from tidewatt.session import scratch_path
from tidewatt.sources import sinks


@query(
    "not_null",
    with_("price_daily", "SELECT trading_date, poc_code, tp_count FROM price_daily WHERE island IS NULL"),
)
def not_null(spark, sf):
    daily = marts.mart_price_daily(s.fct_price(spark, sf), s.dim_node(spark, sf))
    return q.null_rows(daily, "island").select("trading_date", "poc_code", "tp_count")


@query(
    "dup_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def dup_keys(spark, sf):
    return q.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "volume_dup_keys",
    with_("slots", """SELECT network, poc_code, participant, trading_date, trading_period, flow_direction, count(*) AS n
          FROM (SELECT 'W' || l_linestatus AS network, poc_code, participant, trading_date, tp_number AS trading_period,
                  CASE WHEN l_returnflag = 'R' THEN 'injection' ELSE 'offtake' END AS flow_direction FROM slots)
          GROUP BY ALL HAVING count(*) > 1"""),
)
def volume_dup_keys(spark, sf):
    keys = ["network", "poc_code", "participant", "trading_date", "trading_period", "flow_direction"]
    return q.duplicate_keys(staging.stg_market_volume(s.raw_market_volume(spark, sf)), keys)


@query(
    "fk_violations",
    """SELECT user_id, count(*) AS n FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
)
def fk_violations(spark, sf):
    return q.orphans(table(spark, sf, "events"), "user_id", table(spark, sf, "supplier"), "s_suppkey")


@query(
    "accepted_values",
    """SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')
       GROUP BY event_type""",
)
def accepted_values(spark, sf):
    return q.unexpected_values(table(spark, sf, "events"), "event_type", ["click", "view", "purchase"])


@query("range_violations", "SELECT event_id, value FROM events WHERE value < 1 OR value > 200")
def range_violations(spark, sf):
    return q.out_of_range(table(spark, sf, "events"), "value", 1, 200).select("event_id", "value")


@query(
    "count_recon",
    with_("raw_price price", """SELECT *, raw_rows - fct_rows AS diff_rows FROM (
          SELECT (SELECT count(*) FROM raw_price) AS raw_rows, (SELECT count(*) FROM price) AS fct_rows)
          WHERE raw_rows <> fct_rows"""),
)
def count_recon(spark, sf):
    """Raw rows against the fact: differs by the superseded rows."""
    return q.count_mismatch(s.raw_price(spark, sf), s.fct_price(spark, sf), [])


@query(
    "distinct_count_recon",
    with_("slots volume", """SELECT *, raw_rows - fct_rows AS diff_rows FROM (
          SELECT (SELECT count(*) FROM (SELECT DISTINCT poc_code, trading_date, tp_number, participant FROM slots)) AS raw_rows,
            (SELECT count(*) FROM volume) AS fct_rows) WHERE raw_rows <> fct_rows"""),
)
def distinct_count_recon(spark, sf):
    """A grain that is too fine by the participant must be reported."""
    stg = staging.stg_market_volume(s.raw_market_volume(spark, sf))
    keys = ["poc_code", "trading_date", "trading_period", "participant"]
    return q.count_mismatch(stg, core.fct_market_volume(stg), keys)


@query(
    "sum_recon",
    with_("history monthly", f"""SELECT year_month, {sql4('a', 'left_total')}, {sql4('b', 'right_total')},
          {sql4('abs(a - b)', 'diff')}
          FROM (SELECT trading_month AS year_month, sum(generation_kwh)::DOUBLE AS a FROM history
                WHERE fuel_type <> 'Battery' GROUP BY 1)
          JOIN (SELECT year_month, sum(total_generation_kwh)::DOUBLE AS b FROM monthly GROUP BY 1) USING (year_month)
          WHERE abs(a - b) > 1"""),
)
def sum_recon(spark, sf):
    """Facts without batteries against the mart: differs wherever batteries ran."""
    facts = s.history(spark, sf)
    part = facts.filter("fuel_type <> 'Battery'").select(
        F.col("trading_month").alias("year_month"), F.col("generation_kwh").cast("double")
    )
    monthly = marts.mart_generation_monthly(facts).withColumn(
        "total_generation_kwh", F.col("total_generation_kwh").cast("double")
    )
    recon = q.sum_mismatch(part, monthly, "generation_kwh", "total_generation_kwh", 1, ["year_month"])
    return rounded(recon, "left_total", "right_total", "diff")


@query(
    "sum_recon_total",
    """SELECT *, abs(left_total - right_total) AS diff FROM (SELECT sum(l_quantity) AS left_total,
         sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS right_total FROM lineitem)
       WHERE abs(left_total - right_total) > 1""",
)
def sum_recon_total(spark, sf):
    l = table(spark, sf, "lineitem")
    return q.sum_mismatch(l, l.filter("l_linestatus = 'O'"), "l_quantity", "l_quantity", 1)


@query(
    "match_rate",
    with_("price node", f"""SELECT count(n.poc_code) AS matched, count(*) AS total,
          {sql4('count(n.poc_code)::DOUBLE/count(*)', 'match_rate')}
          FROM (SELECT DISTINCT poc_code FROM price) p LEFT JOIN node n USING (poc_code)"""),
)
def match_rate(spark, sf):
    return rounded(q.match_rate(s.fct_price(spark, sf), s.dim_node(spark, sf), "poc_code"), "match_rate")


@query(
    "missing_periods",
    """SELECT strftime(m, '%Y%m') AS year_month FROM range(DATE '1994-06-01', DATE '2002-06-01', INTERVAL 1 MONTH) AS r(m)
       WHERE strftime(m, '%Y%m') NOT IN (SELECT strftime(o_orderdate, '%Y%m') FROM orders)""",
)
def missing_periods(spark, sf):
    loaded = table(spark, sf, "orders").select(yyyymm("o_orderdate").alias("year_month"))
    return q.missing_periods(spark, loaded, "year_month", "199406", "200205")


@query(
    "rows_per_period",
    """SELECT strftime(l_shipdate, '%Y%m') AS month, count(*) AS row_count FROM lineitem GROUP BY 1
       HAVING count(*) < 700 OR count(*) > 780""",
)
def rows_per_period(spark, sf):
    return q.rows_per_period(table(spark, sf, "lineitem").withColumn("month", yyyymm("l_shipdate")), "month", 700, 780)


@query(
    "null_ratio",
    with_("cells generation", """SELECT null_count, total_count, round(null_count*100.0::DOUBLE/total_count, 4) AS null_pct
          FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT site_code, gen_code, trading_date, version FROM cells))*46
                  - (SELECT count(*) FROM cells WHERE trading_period <= 46) AS null_count,
                (SELECT count(*) FROM generation) AS total_count)"""),
    null_count="BIGINT",
)
def null_ratio(spark, sf):
    return q.null_ratio(staging.stg_generation_null_audit(s.raw_generation(spark, sf)), s.stg_generation(spark, sf))


@query(
    "freshness",
    """SELECT max(o_orderdate) AS newest, CAST(DATE '2001-09-10' - CAST(max(o_orderdate) AS DATE) AS INTEGER) AS age_days,
         CASE WHEN DATE '2001-09-10' - CAST(max(o_orderdate) AS DATE) > 45 THEN 'error'
           WHEN DATE '2001-09-10' - CAST(max(o_orderdate) AS DATE) > 35 THEN 'warn' ELSE 'pass' END AS status FROM orders""",
)
def freshness(spark, sf):
    return q.freshness(table(spark, sf, "orders"), "o_orderdate", date(2001, 9, 10))


@query(
    "file_contract",
    with_("raw_price", """, bad AS (SELECT poc_code, trading_date, tp_number, price_nzd_mwh FROM raw_price)
          SELECT 'trading_period' AS rule, count(*) AS n FROM bad WHERE tp_number > 40 UNION ALL
          SELECT 'price', count(*) FROM bad WHERE price_nzd_mwh < -10"""),
)
def file_contract(spark, sf):
    """Price rows with late periods shifted out of range and very low prices spoilt."""
    raw = s.raw_price(spark, sf)
    low = F.col("dollars_per_mwh").cast("double") < -10
    spoilt = raw.select(
        F.lit("202401_FinalEnergyPrices.csv").alias("file_name"), F.lit("202401").alias("period"), "trading_date",
        F.when(F.col("trading_period").cast("int") > 40, F.concat(F.lit("1"), "trading_period"))
        .otherwise(F.col("trading_period")).alias("trading_period"),
        "point_of_connection",
        F.when(low, F.concat("dollars_per_mwh", F.lit("x"))).otherwise(F.col("dollars_per_mwh")).alias("dollars_per_mwh"),
    )
    return q.row_violations(spoilt, q.price_contract()).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(
    "volume_contract",
    with_("slots", """SELECT 'island' AS rule, count(*) AS n FROM slots WHERE l_linestatus = 'O' UNION ALL
          SELECT 'flow', count(*) FROM slots WHERE l_returnflag = 'R'"""),
)
def volume_contract(spark, sf):
    raw = s.raw_market_volume(spark, sf).withColumns({
        "file_name": F.lit("f"), "period": F.lit("202401"),
        "island": F.when(F.col("island") == "NI", "ni").otherwise("SI"),
        "flow_direction": F.when(F.col("flow_direction") == "Injection", "injection").otherwise("Offtake"),
    })
    return q.row_violations(raw, q.volume_contract()).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(
    "offers_contract",
    with_("slots", """SELECT 'trading_date' AS rule, count(*) AS n FROM slots WHERE trading_date <> DATE '2024-01-15' UNION ALL
          SELECT 'is_latest', count(*) FROM slots WHERE l_tax < 0.065 UNION ALL
          SELECT 'unit', count(*) FROM slots WHERE l_returnflag = 'N' AND l_discount < 0.085"""),
)
def offers_contract(spark, sf):
    raw = s.raw_offers(spark, sf).withColumns({
        "file_name": F.lit("f"), "period": F.lit("20240115"),
        "unit": F.when(F.col("unit") == "UN", "").otherwise(F.col("unit")),
    })
    return q.row_violations(raw, q.offers_contract()).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(
    "generation_contract",
    with_("cells", """, w AS (SELECT DISTINCT site_code, gen_code, trading_date, version FROM cells)
          SELECT 'month' AS rule, count(*) AS n FROM w WHERE trading_date >= DATE '2024-01-20' UNION ALL
          SELECT 'tp' || trading_period, count(*) FROM cells WHERE trading_period <= 3 GROUP BY trading_period"""),
)
def generation_contract(spark, sf):
    raw = s.raw_generation(spark, sf).withColumns({
        "file_name": F.lit("f"),
        "period": F.when(F.col("trading_date") >= "2024-01-20", "202402").otherwise("202401"),
        **{f"tp{i}": F.concat(f"tp{i}", F.lit("kWh")) for i in (1, 2, 3)},
    })
    return q.row_violations(raw, q.generation_contract()).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(
    "check_report",
    """SELECT 'lineitem.unique' AS "check", 'error' AS severity, (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber
         FROM lineitem GROUP BY ALL HAVING count(*) > 1)) AS violations, 'fail' AS status UNION ALL
       SELECT 'orders.unique', 'error', 0, 'pass' UNION ALL
       SELECT 'events.range_value', 'warn', (SELECT count(*) FROM events WHERE value < 1 OR value > 200), 'warn'""",
)
def check_report(spark, sf):
    unique = lambda name, *columns: q.TableRules(name, table(spark, sf, name), keys=[q.Key("unique", columns)])
    value = q.range_rule("value", 1, 200, "warn")
    return q.run_checks(spark, [
        unique("lineitem", "l_orderkey", "l_linenumber"), unique("orders", "o_orderkey"),
        q.TableRules("events", table(spark, sf, "events"), [value])])


_RULES_SQL = """SELECT unnest([
    {'check': 'orders.not_null', 'severity': 'error', 'violations': count(*) FILTER (WHERE o_clerk IS NULL OR o_orderkey IS NULL)},
    {'check': 'orders.accepted_o_orderstatus', 'severity': 'warn', 'violations': count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))},
    {'check': 'orders.range_o_totalprice', 'severity': 'error', 'violations': count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 300000)}
  ], recursive := true) FROM (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_clerk FROM orders)"""
_STATUS_SQL = "SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status"


def _order_rules(spark, sf, keys=()):
    orders = table(spark, sf, "orders").withColumn("o_clerk", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")))
    return q.TableRules("orders", orders, [
        q.not_null_rule(["o_clerk", "o_orderkey"]), q.accepted_rule("o_orderstatus", ["F", "O"], "warn"),
        q.range_rule("o_totalprice", 1000, 300_000)], keys)


@query(
    "rule_vector",
    f"""{_STATUS_SQL} FROM ({_RULES_SQL} UNION ALL
        SELECT 'orders.unique', 'error', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) UNION ALL
        SELECT 'orders.one_per_day', 'warn', (SELECT count(*) FROM (SELECT o_custkey, o_orderdate FROM orders GROUP BY ALL HAVING count(*) > 1)))""",
)
def rule_vector(spark, sf):
    """Row rules and two keys of a table by one scan."""
    keys = [q.Key("unique", ["o_orderkey"]), q.Key("one_per_day", ["o_custkey", "o_orderdate"], "warn")]
    return q.run_checks(spark, [_order_rules(spark, sf, keys)])


@query("rules_while_writing", f"{_STATUS_SQL} FROM ({_RULES_SQL})")
def rules_while_writing(spark, sf):
    """The rules counted by the write of the table itself."""
    path = scratch_path(spark, "ruled")
    return q.with_status(_order_rules(spark, sf).written(lambda df: sinks.replace_all(df, path)))


@query(
    "compare_results",
    """SELECT 'left' AS side, o_orderkey FROM orders WHERE o_orderstatus = 'P' UNION ALL
       SELECT 'right', o_orderkey FROM orders WHERE o_orderstatus = 'F'""",
)
def compare_results(spark, sf):
    o = table(spark, sf, "orders")
    return compare(
        o.filter("o_orderstatus <> 'F'").select("o_orderkey"), o.filter("o_orderstatus <> 'P'").select("o_orderkey")
    )


