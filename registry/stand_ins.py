"""Raw electricity tables derived from the given tables, as Spark plans over the whole tables.

events     half-hour prices, period matrices and run telemetry (node = user)
lineitem   volumes, offers and a long generation history (node = supplier)
customer   network supply points; orders: lake levels and query history
"""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import table
from tidewatt.functions.calendar import half_hour, yyyymm
from tidewatt.operators.joins import only_keys
from tidewatt.plans import core, marts, staging
from tidewatt.schemas import MTIME
from tidewatt.sources import seeds


def text(c):
    return c.cast("string")


def labelled(prefix, c):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


# ---- events ----------------------------------------------------------------------------------


def raw_price(spark, sf):
    e = table(spark, sf, "events")
    day = F.col("ts").cast("date")
    return e.select(
        text(day).alias("trading_date"),
        text(half_hour("ts")).alias("trading_period"),
        labelled("N", "user_id").alias("point_of_connection"),
        text(F.col("value") * 2 - 20).alias("dollars_per_mwh"),
        yyyymm(day).alias("trading_month"),
        F.col("ts").alias(MTIME),
    )


def fct_price(spark, sf):
    return core.fct_price(staging.stg_price(raw_price(spark, sf)))


FUEL_OF_EVENT = {"click": "HYD", "view": "Gas", "purchase": "Wind", "signup": "Coal", "error": "Gas&Oil"}


def mapped(column, mapping):
    c = F.lit(None).cast("string")
    for key, value in mapping.items():
        c = F.when(F.col(column) == key, value).otherwise(c)
    return c


def raw_generation(spark, sf):
    """Period matrix in two file versions; a cell is the largest reading of its half hour."""
    e = table(spark, sf, "events")
    cells = e.select(
        labelled("S", "user_id").alias("site_code"),
        labelled("N", "user_id").alias("poc_code"),
        F.lit("NW").alias("nwk_code"),
        F.col("event_type").alias("gen_code"),
        mapped("event_type", FUEL_OF_EVENT).alias("fuel_code"),
        F.lit("T").alias("tech_code"),
        text(F.col("ts").cast("date")).alias("trading_date"),
        yyyymm(F.col("ts").cast("date")).alias("trading_month"),
        F.timestamp_add("DAY", (F.col("event_id") % 2).cast("int"), F.lit("2024-02-01").cast("timestamp_ntz")).alias(MTIME),
        half_hour("ts").alias("_tp"),
        (F.col("value") * 10).alias("_kwh"),
    )
    ids = ["site_code", "poc_code", "nwk_code", "gen_code", "fuel_code", "tech_code", "trading_date",
           "trading_month", MTIME]
    wide = cells.groupBy(*ids).pivot("_tp", list(range(1, 51))).agg(F.max("_kwh"))
    return wide.select(*ids, *[text(F.col(f"`{i}`")).alias(f"tp{i}") for i in range(1, 51)])


def stg_generation(spark, sf):
    return staging.stg_generation(raw_generation(spark, sf), seeds.fuel_codes(spark))


def raw_run(spark, sf):
    e = table(spark, sf, "events")
    kind = F.when(F.col("event_type").isin("error", "signup"), "test").otherwise("model")
    status = mapped(
        "event_type",
        {"click": "success", "view": "success", "purchase": "error", "signup": "pass", "error": "fail"},
    )
    name = labelled("m", "user_id")
    return e.select(
        F.concat(F.lit("inv-"), F.date_format("ts", "yyyyMMddHH")).alias("invocation_id"),
        text(F.col("ts")).alias("generated_at"),
        F.lit("1.0").alias("dbt_version"),
        F.concat(kind, F.lit(".p."), name).alias("node_unique_id"),
        kind.alias("node_type"),
        name.alias("node_name"),
        status.alias("status"),
        text(F.col("value")).alias("execution_time_seconds"),
        F.when(F.col("event_type") == "error", text(F.col("event_id") % 10)).otherwise("").alias("failures"),
        F.lit("").alias("message"),
        F.lit("").alias("relation_name"),
        F.col("props").alias("adapter_message"),
    )


def fct_run(spark, sf):
    return core.fct_run(staging.stg_run(raw_run(spark, sf)))


# ---- lineitem --------------------------------------------------------------------------------


def _event_calendar(l):
    """Line items placed on the 30 days and 48 half hours of the events, node = supplier."""
    return l.select(
        "*",
        labelled("N", "l_suppkey").alias("_poc"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("l_orderkey") % 30).cast("int")).alias("_day"),
        (F.col("l_partkey") % 48 + 1).cast("int").alias("_tp"),
    )


def raw_market_volume(spark, sf):
    l = _event_calendar(table(spark, sf, "lineitem"))
    return l.select(
        F.col("_poc").alias("point_of_connection"),
        F.concat(F.lit("W"), "l_linestatus").alias("network"),
        F.when(F.col("l_linestatus") == "O", "NI").otherwise("SI").alias("island"),
        labelled("P", "l_linenumber").alias("participant"),
        text(F.col("_day")).alias("trading_date"),
        text(F.col("_tp")).alias("trading_period"),
        F.lit("").alias("trading_period_start_time"),
        F.when(F.col("l_returnflag") == "R", "Injection").otherwise("Offtake").alias("flow_direction"),
        text(F.col("l_quantity") * 100).alias("kilowatt_hours"),
        yyyymm("_day").alias("trading_month"),
        F.col("l_shipdate").alias(MTIME),
    )


def _of_keys(rows, keys):
    """Staged rows of the given nodes and half hours; None takes all."""
    if keys is None:
        return rows
    return only_keys(rows, keys.withColumnRenamed("tp_number", "trading_period"), ["poc_code", "trading_date", "trading_period"])


def fct_market_volume(spark, sf, keys=None):
    return core.fct_market_volume(_of_keys(staging.stg_market_volume(raw_market_volume(spark, sf)), keys))


def raw_offers(spark, sf):
    l = _event_calendar(table(spark, sf, "lineitem"))
    return l.select(
        text(F.col("_day")).alias("trading_date"),
        text(F.col("_tp")).alias("trading_period"),
        labelled("P", "l_linenumber").alias("participant_code"),
        F.col("_poc").alias("point_of_connection"),
        F.concat(F.lit("U"), "l_returnflag").alias("unit"),
        F.lit("Energy").alias("product_type"),
        F.when(F.col("l_discount") < 0.085, "Injection").otherwise("Reserve").alias("product_class"),
        F.lit("").alias("reserve_type"),
        F.lit("").alias("product_description"),
        F.lit("2024-01-01").alias("utc_submission_date"),
        F.lit("00:00:00").alias("utc_submission_time"),
        text(F.round(F.col("l_discount") * 100).cast("int")).alias("submission_order"),
        F.when(F.col("l_tax") < 0.065, "y").otherwise("N").alias("is_latest_yes_no"),
        text(F.col("l_linenumber")).alias("tranche"),
        F.lit("").alias("maximum_ramp_up_mw_per_hour"),
        F.lit("").alias("maximum_ramp_down_mw_per_hour"),
        F.lit("").alias("partially_loaded_spinning_reserve_percent"),
        text(F.col("l_quantity") * 2).alias("maximum_output_mw"),
        F.lit("").alias("forecast_generation_potential_mw"),
        text(F.col("l_quantity")).alias("megawatts"),
        text(F.col("l_extendedprice") / 100 - 50).alias("dollars_per_mwh"),
        yyyymm("_day").alias("trading_month"),
        F.col("l_shipdate").alias(MTIME),
    )


def fct_offer_stack(spark, sf, keys=None):
    return core.fct_offer_stack(staging.stg_energy_offer(raw_offers(spark, sf), keys))


def mart_offer_curve(spark, sf, keys=None):
    return marts.mart_offer_curve(fct_offer_stack(spark, sf, keys))


def price_context(spark, sf, prices=None):
    """The context of all prices, or of the given ones: volumes and offers of other half hours are left out before they are grouped."""
    if prices is None:
        prices, keys = fct_price(spark, sf), None
    else:
        keys = prices.select(*core.TP_KEY)
    return marts.mart_price_offer_context(prices, fct_market_volume(spark, sf, keys), mart_offer_curve(spark, sf, keys))


FUEL_OF_PART = {
    "ECONOMY": "HYD", "STANDARD": "Gas", "PROMO": "GEO", "LARGE": "Wind", "MEDIUM": "ELE", "SMALL": "Gas&Oil",
}


def history_cells(spark, sf):
    """Seven years of generator readings in long form."""
    l = table(spark, sf, "lineitem").join(
        table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey"
    )
    day = F.col("l_shipdate").cast("date")
    cells = l.select(
        labelled("S", "l_suppkey").alias("site_code"),
        labelled("N", "l_suppkey").alias("poc_code"),
        F.lit("NW").alias("nwk_code"),
        F.concat(labelled("G", "l_suppkey"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("gen_code"),
        mapped("p_type", FUEL_OF_PART).alias("raw_fuel_code"),
        F.lit("T").alias("tech_code"),
        text(day).alias("trading_date"),
        yyyymm(day).alias("trading_month"),
        F.col("l_shipdate").alias(MTIME),
        (F.col("l_partkey") % 48 + 1).cast("int").alias("trading_period"),
        text(F.col("l_quantity") * 1000 + F.col("l_tax") * 100 / 2).alias("cell"),
    )
    return cells.join(F.broadcast(seeds.fuel_codes(spark)), "raw_fuel_code")


def history(spark, sf):
    return core.fct_generation(staging.latest_generation(history_cells(spark, sf)))


def history_price(spark, sf):
    """Prices over the same seven years."""
    l = table(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date")
    raw = l.select(
        text(day).alias("trading_date"),
        text(F.col("l_linenumber")).alias("trading_period"),
        labelled("N", "l_suppkey").alias("point_of_connection"),
        text(F.col("l_extendedprice") / F.col("l_quantity") / 10).alias("dollars_per_mwh"),
        yyyymm(day).alias("trading_month"),
        F.col("l_shipdate").alias(MTIME),
    )
    return core.fct_price(staging.stg_price(raw))


# ---- customer and orders ---------------------------------------------------------------------


def raw_nsp(spark, sf):
    """Fifteen supply points per node."""
    c = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        .join(table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    )
    key = F.col("c_custkey")
    start = F.date_add(F.lit("2000-01-01").cast("date"), (key % 1000).cast("int"))
    filled = {
        "current_flag": F.when(key % 5 == 0, "0").otherwise(" 1"),
        "nsp": F.col("c_name"),
        "poc_code": F.concat(F.lit(" N"), F.floor(key / 15).cast("string"), F.lit(" ")),
        "network_participant": F.col("c_mktsegment"),
        "reconciliation_type": F.lit("GN"),
        "description": F.lit(""),
        "network_reporting_region": F.col("r_name"),
        "network_reporting_region_id": text(F.col("n_regionkey")),
        "zone": F.col("n_name"),
        "island": F.when(F.col("n_regionkey") % 2 == 0, "NI").otherwise("SI"),
        "nztm_easting": F.when(key % 3 == 0, "").otherwise(text(F.col("c_acctbal") * 10)),
        "nztm_northing": F.lit("x"),
        "start_date": F.when(key % 7 == 0, "").otherwise(text(start)),
        "end_date": F.lit(""),
    }
    return c.select(*[v.alias(k) for k, v in filled.items()], F.lit("2024-01-01").cast("timestamp_ntz").alias(MTIME))


def dim_node(spark, sf):
    return core.dim_node(staging.stg_nsp(raw_nsp(spark, sf)))


LAKES = ("NI_TPO", "NI_WKA", "SI_TKA", "SI_PKI", "SI_OHA", "SI_HWE", "SI_WAN", "SI_WPU", "SI_MAN", "SI_TAU")


def raw_hydro(spark, sf):
    o = table(spark, sf, "orders")
    site = F.element_at(F.array(*[F.lit(x) for x in LAKES], F.lit("SI_XXX")), (F.col("o_custkey") % 11 + 1).cast("int"))
    level = text(F.col("o_totalprice") / 1000)
    return o.select(
        site.alias("site_code"),
        text(F.col("o_orderdate").cast("date")).alias("date_str"),
        F.lit("23:59:59").alias("time_str"),
        level.alias("level_m"),
        F.when(F.col("o_orderstatus") == "P", F.when(F.col("o_custkey") % 2 == 0, "n/a").otherwise(level))
        .otherwise(level).alias("active_storage_mm3"),
        F.lit("").alias("contingent_storage_mm3"),
        F.substring("o_orderpriority", 1, 1).alias("quality_code"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias(MTIME),
    )


def fct_hydro(spark, sf, p):
    return core.fct_hydro(
        staging.stg_hydro_storage(raw_hydro(spark, sf), p), core.dim_catchment(seeds.hydro_catchments(spark))
    )


def metering(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.select(
        F.col("l_shipdate").alias("start_time"),
        F.col("l_returnflag").alias("warehouse_name"),
        F.col("l_quantity").alias("credits_used"),
        F.col("l_discount").alias("credits_used_compute"),
        F.col("l_tax").alias("credits_used_cloud_services"),
    )


def query_history(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderdate").alias("start_time"),
        mapped("o_orderstatus", {"F": "A", "O": "N"}).alias("warehouse_name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "FAILED").otherwise("SUCCESS").alias("execution_status"),
        F.col("o_totalprice").alias("total_elapsed_time"),
    )
