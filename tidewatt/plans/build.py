"""The whole model graph: raw tables in, facts and marts out as parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.functions.calendar import yyyymm
from tidewatt.params import Params
from tidewatt.plans import core, marts, staging
from tidewatt.schemas import RAW_TABLES
from tidewatt.session import configure
from tidewatt.sources import seeds, sinks
from tidewatt.streaming import incremental



def build_all(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    base: str,
    p: Params = Params(),
    incremental_run: bool = False,
    exact: bool = False,
) -> dict[str, DataFrame]:
    """Build every table under `base`; raw tables that are absent count as empty.

    Tables several models read are written once and read back, so each is computed once and
    later scans prune columns and months. A first or full run replaces every table; an
    incremental run refreshes the lookback window of the incremental ones.
    """
    configure(spark)
    empty = {n: spark.createDataFrame([], schema) for n, schema in RAW_TABLES.items() if n not in raw}
    raw = {**raw, **empty}
    tables: dict[str, DataFrame] = {}
    dated: dict[str, DataFrame] = {}  # saved facts with their period column, for pruned refreshes
    everything = incremental.months_from(None)

    def save(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/{name}"
        if "trading_date" in df.columns and not name.startswith("dim_"):
            df = df.withColumn(incremental.PERIOD, yyyymm("trading_date"))
            sinks.replace_all(df, path, [incremental.PERIOD])
        else:
            sinks.replace_all(df, path)
        dated[name] = spark.read.schema(df.schema).parquet(path)
        tables[name] = everything(dated[name].select(*df.columns))
        return tables[name]

    def refresh(name: str, source: DataFrame, build) -> DataFrame:
        """build(source, within): see incremental.refresh."""
        path = f"{base}/{name}"
        if incremental_run:
            incremental.refresh(spark, path, name, source, build, p.lookback_days, exact)
        else:
            spec = incremental.TABLES[name]
            sinks.replace_all(incremental.with_period(build(everything(source), everything), spec), path, [incremental.PERIOD])
        tables[name] = incremental.load(spark, path, build(everything(source), everything))
        dated[name] = incremental.with_folder(spark, path, tables[name])
        return tables[name]

    fuels = seeds.fuel_codes(spark)
    holidays = seeds.public_holidays(spark)

    stg_generation = save("stg_generation", staging.stg_generation(raw["raw_generation"], fuels))
    tables["stg_generation_null_audit"] = staging.stg_generation_null_audit(raw["raw_generation"])
    stg_price = save("stg_price", staging.stg_price(raw["raw_price"], p))
    tables["stg_price_outlier_audit"] = staging.stg_price_outlier_audit(stg_price, p)
    stg_volume = save("stg_market_volume", staging.stg_market_volume(raw["raw_market_volume"]))
    stg_offer = save("stg_energy_offer", staging.stg_energy_offer(raw["raw_offers"]))
    stg_nsp = save("stg_nsp", staging.stg_nsp(raw["raw_nsp"]))
    stg_hydro = save("stg_hydro_storage", staging.stg_hydro_storage(raw["raw_hydro_storage"], p))
    tables["stg_run"] = staging.stg_run(raw["raw_dbt_run"])

    dim_date = save("dim_date", core.dim_date(spark, holidays, p))
    save("dim_fuel", core.dim_fuel(fuels))
    save("dim_plant", core.dim_plant(stg_generation))
    node = save("dim_node", core.dim_node(stg_nsp))
    catchment = save("dim_catchment", core.dim_catchment(seeds.hydro_catchments(spark)))

    by_poc = save("int_generation_by_poc", core.int_generation_by_poc(stg_generation))
    generation = save("fct_generation", core.fct_generation(stg_generation))
    price = refresh("fct_price", dated["stg_price"], lambda s, _: core.fct_price(s))
    volume = refresh("fct_market_volume", dated["stg_market_volume"], lambda s, _: core.fct_market_volume(s))
    stack = save("fct_offer_stack", core.fct_offer_stack(stg_offer))
    hydro = save("fct_hydro", core.fct_hydro(stg_hydro, catchment))
    save("fct_run", core.fct_run(tables["stg_run"]))
    save("int_price_daily", core.int_price_daily(price))

    refresh("mart_generation_daily", dated["fct_generation"], lambda s, _: marts.mart_generation_daily(s))
    refresh("mart_generation_monthly", dated["fct_generation"], lambda s, _: marts.mart_generation_monthly(s))
    refresh("mart_plant_ranking", dated["fct_generation"], lambda s, _: marts.mart_plant_ranking(s))
    refresh("mart_renewable_ratio", dated["fct_generation"], lambda s, _: marts.mart_renewable_ratio(s))
    save("mart_seasonal_pattern", marts.mart_seasonal_pattern(generation))
    daily = refresh("mart_price_daily", dated["fct_price"], lambda s, _: marts.mart_price_daily(s, node, p))
    refresh(
        "mart_price_spike_events", dated["fct_price"],
        lambda s, within: marts.mart_price_spike_events(s, within(dated["int_generation_by_poc"]), node, p),
    )
    save("mart_price_anomaly_events", marts.mart_price_anomaly_events(price, volume, node, p))
    curve = save("mart_offer_curve", marts.mart_offer_curve(stack))
    save("mart_price_offer_context", marts.mart_price_offer_context(price, volume, curve))
    save(
        "mart_price_spike_features",
        marts.mart_price_spike_features(price, volume, curve, by_poc, node, dim_date, p),
    )
    refresh(
        "mart_renewable_price_impact", dated["fct_price"],
        lambda s, within: marts.mart_renewable_price_impact(s, within(dated["int_generation_by_poc"]), node),
    )
    save("mart_hydro_price_driver", marts.mart_hydro_price_driver(hydro, daily))
    if "metering" in raw and "query_history" in raw:
        save("mart_usage_cost", marts.mart_usage_cost(raw["metering"], raw["query_history"], p))
    return tables


def schema_checks(tables: dict[str, DataFrame]) -> list:
    """The checks of every built table: one vector of row rules and keys per table, then those between tables."""
    from tidewatt.plans import quality as q

    fuel_types = ["Gas", "Hydro", "Geothermal", "Wind", "Diesel", "Coal", "Wood", "Solar", "Battery"]
    rules: dict[str, list] = {table: [q.not_null_rule(columns)] for table, columns in NOT_NULL.items()}
    keys: dict[str, list] = {table: [q.Key("unique", columns)] for table, columns in UNIQUE.items()}
    keys["dim_plant"].append(q.Key("unique_gen_code", ["gen_code"], "warn"))
    for table, column, accepted, severity in [
        ("stg_generation", "fuel_type", fuel_types, "error"),
        ("stg_price", "pricing_regime", ["ex_post", "real_time"], "error"),
        ("stg_market_volume", "flow_direction", ["injection", "offtake"], "error"),
        ("stg_energy_offer", "product_type", ["energy"], "error"),
        ("stg_energy_offer", "product_class", ["injection"], "error"),
        ("stg_run", "status", ["pass", "fail", "error", "warn", "skipped", "success"], "error"),
        ("fct_run", "node_type", ["model", "test", "seed", "snapshot", "operation", "source"], "error"),
        ("stg_nsp", "island", ["NI", "SI"], "warn"),
        ("dim_date", "season", ["Summer", "Autumn", "Winter", "Spring"], "error"),
        ("mart_price_anomaly_events", "anomaly_type",
         ["positive_spike", "negative_price", "statistical_outlier"], "error"),
    ]:
        rules.setdefault(table, []).append(q.accepted_rule(column, accepted, severity))
    for table, column, low, high, severity in [
        ("stg_generation", "trading_period", 1, 50, "error"),
        ("stg_generation", "generation_kwh", 0, 1_000_000, "warn"),
        ("stg_price", "trading_period", 1, 50, "error"),
        ("stg_price", "price_nzd_mwh", -5000, 20000, "warn"),
        ("stg_market_volume", "trading_period", 1, 50, "error"),
        ("stg_market_volume", "volume_kwh", -100_000_000, 100_000_000, "warn"),
        ("stg_energy_offer", "trading_period", 1, 50, "error"),
        ("stg_hydro_storage", "active_storage_mm3", 0, 10000, "warn"),
        ("mart_generation_monthly", "active_days", 1, 31, "error"),
        ("mart_renewable_ratio", "renewable_pct", 0, 100, "error"),
        ("mart_price_spike_events", "price_nzd_mwh", 300, 20000, "error"),
        ("mart_renewable_price_impact", "renewable_pct", 0, 100, "error"),
        ("mart_hydro_price_driver", "storage_pct_of_max", 0, 100, "warn"),
    ]:
        rules.setdefault(table, []).append(q.range_rule(column, low, high, severity))
    checks: list = [q.TableRules(t, tables[t], rules.get(t, ()), keys.get(t, ())) for t in dict.fromkeys([*rules, *keys])]

    def add(table, kind, violations, severity="error"):
        checks.append(q.Check(f"{table}.{kind}", violations, severity))

    add("fct_generation", "plant_exists",
        q.orphans(tables["fct_generation"], "plant_id", tables["dim_plant"], "plant_id"))
    add("fct_price", "recon_rows",
        q.count_mismatch(tables["stg_price"], tables["fct_price"], ["poc_code", "trading_date", "trading_period"]))
    add("fct_market_volume", "recon_rows",
        q.count_mismatch(tables["stg_market_volume"], tables["fct_market_volume"],
                         ["poc_code", "trading_date", "trading_period"]))
    add("fct_offer_stack", "recon_rows",
        q.count_mismatch(tables["stg_energy_offer"], tables["fct_offer_stack"], [], "staging_rows", "fact_rows"))
    add("mart_generation_monthly", "recon_kwh",
        q.sum_mismatch(tables["fct_generation"], tables["mart_generation_monthly"],
                       "generation_kwh", "total_generation_kwh", 1))
    add("int_generation_by_poc", "recon_kwh",
        q.sum_mismatch(tables["stg_generation"].filter("poc_code IS NOT NULL"), tables["int_generation_by_poc"],
                       "generation_kwh", "generation_kwh"))
    add("mart_renewable_ratio", "recon_kwh",
        q.sum_mismatch(tables["mart_renewable_ratio"], tables["mart_generation_monthly"],
                       "total_kwh", "total_generation_kwh", 1, ["year_month"]))
    add("fct_price", "node_match_rate",
        q.low_match_rate(tables["fct_price"], tables["dim_node"], "poc_code"), "warn")
    add("stg_generation", "rows_per_month", q.rows_per_period(tables["stg_generation"], "trading_month"))
    add("stg_generation", "null_ratio",
        q.null_ratio(tables["stg_generation_null_audit"], tables["stg_generation"]), "warn")
    return checks


NOT_NULL = {
    "stg_generation": ["generation_id", "site_code", "gen_code", "fuel_type", "trading_date",
                       "trading_period", "generation_kwh"],
    "stg_price": ["price_id", "poc_code", "trading_date", "trading_period", "price_nzd_mwh",
                  "pricing_regime", "is_proxy"],
    "stg_market_volume": ["market_volume_id", "poc_code", "trading_date", "trading_period",
                          "flow_direction", "volume_kwh"],
    "stg_energy_offer": ["offer_id", "participant_code", "poc_code", "unit", "product_type",
                         "product_class", "trading_date", "trading_period", "is_latest", "tranche",
                         "offer_mw", "offer_price_nzd_mwh"],
    "stg_run": ["invocation_id", "node_unique_id", "status"],
    "stg_nsp": ["poc_code", "nsp_code"],
    "stg_hydro_storage": ["site_code", "trading_date", "active_storage_mm3"],
    "dim_plant": ["plant_id", "site_code", "gen_code", "fuel_type"],
    "dim_node": ["node_id", "poc_code"],
    "dim_date": ["date_key", "trading_date", "season"],
    "dim_fuel": ["fuel_id", "fuel_type"],
    "dim_catchment": ["catchment_key", "site_code"],
    "fct_generation": ["generation_id", "plant_id", "trading_date", "generation_kwh"],
    "fct_price": ["date_key", "trading_date", "poc_code", "tp_number", "price_nzd_mwh"],
    "fct_market_volume": ["poc_code", "trading_date", "tp_number", "injection_kwh", "offtake_kwh"],
    "fct_offer_stack": ["offer_id", "poc_code", "trading_date", "tp_number", "offer_mw",
                        "offer_price_nzd_mwh"],
    "fct_hydro": ["hydro_id", "trading_date", "site_code", "active_storage_mm3"],
    "fct_run": ["invocation_id", "node_unique_id"],
    "int_price_daily": ["poc_code", "trading_date", "tp_number", "avg_price_all"],
    "int_generation_by_poc": ["poc_code", "trading_date", "tp_number", "fuel_type", "generation_kwh"],
    "mart_generation_daily": ["trading_date", "fuel_type", "total_generation_kwh", "total_generation_gwh"],
    "mart_generation_monthly": ["year_month", "fuel_type", "total_generation_kwh"],
    "mart_renewable_ratio": ["year_month", "renewable_pct"],
    "mart_plant_ranking": ["year_month", "site_code", "monthly_rank"],
    "mart_seasonal_pattern": ["season_year", "season", "fuel_type"],
    "mart_price_daily": ["trading_date", "poc_code", "avg_price_all"],
    "mart_price_spike_events": ["trading_date", "poc_code", "tp_number", "price_nzd_mwh"],
    "mart_price_anomaly_events": ["trading_date", "poc_code", "tp_number", "anomaly_type", "price_nzd_mwh"],
    "mart_offer_curve": ["poc_code", "trading_date", "tp_number", "total_offered_mw", "offer_tranche_count"],
    "mart_price_offer_context": ["poc_code", "trading_date", "tp_number", "price_nzd_mwh"],
    "mart_price_spike_features": ["poc_code", "trading_date", "tp_number", "price_nzd_mwh", "is_price_spike"],
    "mart_renewable_price_impact": ["poc_code", "trading_date", "tp_number", "price_nzd_mwh"],
    "mart_hydro_price_driver": ["island", "year_month", "avg_total_storage_mm3"],
}
UNIQUE = {
    "stg_generation": ["generation_id"],
    "stg_price": ["price_id"],
    "stg_market_volume": ["market_volume_id"],
    "stg_energy_offer": ["offer_id"],
    "dim_plant": ["plant_id"],
    "dim_node": ["poc_code"],
    "dim_date": ["trading_date"],
    "dim_fuel": ["fuel_type"],
    "dim_catchment": ["site_code"],
    "fct_generation": ["generation_id"],
    "fct_price": ["poc_code", "trading_date", "tp_number"],
    "fct_market_volume": ["poc_code", "trading_date", "tp_number"],
    "fct_offer_stack": ["participant_code", "poc_code", "unit", "trading_date", "tp_number", "tranche"],
    "fct_hydro": ["site_code", "trading_date"],
    "fct_run": ["invocation_id", "node_unique_id"],
    "int_price_daily": ["poc_code", "trading_date", "tp_number"],
    "mart_renewable_ratio": ["year_month"],
    "mart_offer_curve": ["poc_code", "trading_date", "tp_number"],
    "mart_price_offer_context": ["poc_code", "trading_date", "tp_number"],
    "mart_price_daily": ["poc_code", "trading_date"],
    "mart_price_anomaly_events": ["poc_code", "trading_date", "tp_number", "anomaly_type"],
    "mart_price_spike_features": ["poc_code", "trading_date", "tp_number"],
    "mart_hydro_price_driver": ["island", "year_month"],
}
