"""The small market of tests/market.py through files, models, checks and refreshes, against hand-derived answers."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests import market
from tidewatt import schemas
from tidewatt.operators.joins import compare
from tidewatt.plans import build, core, marts, quality, serving, staging
from tidewatt.schemas import MTIME
from tidewatt.sources import files, sinks
from tidewatt.streaming import incremental


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("market"))
    market.publish(spark, path)
    return path


@pytest.fixture(scope="module")
def tables(spark, base, tmp_path_factory):
    return build.build_all(spark, market.scanned(spark, base), str(tmp_path_factory.mktemp("warehouse")))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_generation(tables):
    """Plants make 7,920 times their weight: 100, 40, and at one site 20 and 60."""
    assert tables["stg_generation"].count() == 4 * 30 * 48
    totals = {r.site_code: r.k for r in tables["fct_generation"].groupBy("site_code").agg(F.sum("generation_kwh").alias("k")).collect()}
    assert totals == {"Alpine": 792_000, "Bayside": 316_800, "Corner": 633_600}
    ratio = one(tables["mart_renewable_ratio"])
    assert (ratio.total_kwh, ratio.renewable_kwh, ratio.renewable_pct) == (1_742_400, 1_425_600, 81.82)  # 180 of 220 weights
    ranks = tables["mart_plant_ranking"].orderBy("monthly_rank").collect()
    assert [(r.monthly_rank, r.site_code, r.primary_fuel_type) for r in ranks] == [
        (1, "Alpine", "Hydro"), (2, "Corner", "Geothermal"), (3, "Bayside", "Coal")]


def test_prices(tables):
    assert tables["fct_price"].count() == 3 * 30 * 48
    assert {r.pricing_regime for r in tables["fct_price"].select("pricing_regime").distinct().collect()} == {"real_time"}
    audit = {(r.poc_code, r.trading_date.day, r.trading_period, r.outlier_type) for r in tables["stg_price_outlier_audit"].collect()}
    assert audit == {("COR0111", 17, 31, "positive_spike"), ("ALP0331", 9, 5, "negative_price")}
    spike = one(tables["mart_price_spike_events"])
    # (7 * 17 + 31) mod 10 + 1 = 1, so the wind and the steam of Corner make 20 and 60.
    assert (spike.total_generation_kwh, spike.renewable_generation_kwh, spike.thermal_generation_kwh) == (80, 80, 0)
    assert not spike.unmatched_generation and spike.island == "NI"


def test_volume_offers_context(tables):
    assert tables["fct_market_volume"].count() == 3 * 30 * 48
    assert tables["stg_energy_offer"].count() == 2 * 48 * 4
    assert tables["mart_offer_curve"].count() == 2 * 48
    at = "poc_code = 'COR0111' AND tp_number = 31 AND trading_date = '2023-06-17'"
    v = one(tables["fct_market_volume"].filter(at))
    assert (v.offtake_kwh, v.injection_kwh, v.net_injection_kwh) == (1310.0, 655.0, -655.0)
    c = one(tables["mart_offer_curve"].filter(at))
    got = [c.total_offered_mw, c.offered_mw_at_or_below_100, c.offered_mw_at_or_below_300, c.offered_mw_at_or_below_500]
    assert got == [250.0, 25.0, 75.0, 75.0]  # at 60, 240, 540 and 960
    assert round(c.cheap_offer_share_below_300, 6) == 0.3
    assert round(c.weighted_avg_offer_price_nzd_mwh, 6) == 600.0  # (1500 + 12000 + 40500 + 96000) / 250
    assert c.max_cumulative_offered_mw == 250.0
    x = one(tables["mart_price_offer_context"].filter(at))
    assert round(x.offered_to_offtake_ratio, 4) == 95.4198  # 250 / 2.62


def test_hydro_nodes_dates(tables):
    h = one(tables["mart_hydro_price_driver"])
    assert (h.island, h.year_month, h.observation_days) == ("SI", "202306", 30)
    assert [round(x, 6) for x in (h.avg_total_storage_mm3, h.min_storage_mm3, h.max_storage_mm3)] == [331.0, 302.0, 360.0]
    assert h.storage_pct_of_max == 100.0
    nodes = {r.poc_code: (r.island, r.nsp_code, r.nztm_easting) for r in tables["dim_node"].collect()}
    assert nodes == {"ALP0331": ("SI", "ALP_A", 1_500_001), "BAY0221": ("NI", "BAY_A", 1_500_001), "COR0111": ("NI", "COR_A", 1_500_001)}
    d = tables["dim_date"]
    assert d.count() == 5478
    assert d.agg(F.max("trading_date")).first()[0] == date(2030, 12, 30)
    assert d.filter("is_nz_holiday").count() == 159


def test_features_and_anomalies(tables):
    kinds = {(r.poc_code, r.trading_date.day, r.tp_number): r.anomaly_type for r in tables["mart_price_anomaly_events"].collect()}
    assert kinds[("COR0111", 17, 31)] == "positive_spike" and kinds[("ALP0331", 9, 5)] == "negative_price"
    f = tables["mart_price_spike_features"]
    assert f.count() == 3 * 30 * 48
    at = lambda day, tp: one(f.filter(f"poc_code = 'BAY0221' AND trading_date = '2023-06-{day:02}' AND tp_number = {tp}"))
    first = at(1, 1)
    assert first.previous_tp_price is None and first.rolling_7d_avg_price is None and not first.is_nz_holiday
    assert at(2, 1).previous_tp_price == 90.0  # the 48th half hour, which begins a cycle
    assert at(5, 1).is_nz_holiday


def test_schema_checks(spark, tables):
    report = {r.check: r for r in quality.run_checks(spark, build.schema_checks(tables)).collect()}
    failed = {n for n, r in report.items() if r.status == "fail"}
    assert failed == set()
    assert len(report) > 60


def test_checks_catch_planted_faults(spark, tables):
    price = tables["fct_price"]
    twice = price.unionByName(price.limit(1))
    assert quality.duplicate_keys(twice, ["poc_code", "trading_date", "tp_number"]).count() == 1
    assert quality.count_mismatch(tables["stg_price"], twice, []).first().diff_rows == -1
    assert quality.low_match_rate(price, tables["dim_node"].filter("poc_code = 'BAY0221'"), "poc_code").first().match_rate == pytest.approx(1 / 3)
    assert quality.rows_per_period(tables["stg_generation"], "trading_month", 1, 10).count() == 1
    assert [r.period for r in quality.missing_periods(
        spark, spark.createDataFrame([("202401",), ("202403",)], "period string"), "period", "202312", "202403"
    ).orderBy("period").collect()] == ["202312", "202402"]


def test_incremental_equals_full_rebuild(spark, base, tables, tmp_path):
    raw = market.scanned(spark, base)
    early = dict(raw)
    for name, col in (("raw_price", "trading_date"), ("raw_market_volume", "trading_date"), ("raw_generation", "trading_date")):
        early[name] = raw[name].filter(F.col(col) <= "2023-06-20")
    path = str(tmp_path)
    build.build_all(spark, early, path)
    got = build.build_all(spark, raw, path, incremental_run=True)
    for name in incremental.TABLES:
        drop = [c for c in (MTIME,) if c in got[name].columns]
        assert compare(got[name].drop(*drop), tables[name].drop(*drop)).count() == 0, name


def test_correction_below_threshold(spark, base, tmp_path):
    """A corrected spike stays after a keyed upsert and leaves with an exact window refresh."""
    prices = staging.stg_price(market.scanned(spark, base)["raw_price"])
    node = core.dim_node(staging.stg_nsp(market.scanned(spark, base)["raw_nsp"]))
    empty = core.int_generation_by_poc(staging.stg_generation(
        spark.createDataFrame([], schemas.RAW_TABLES["raw_generation"]),
        spark.createDataFrame([("x", "x", False)], "raw_fuel_code string, fuel_type string, is_renewable boolean"),
    ))
    build_spikes = lambda s, _=None: marts.mart_price_spike_events(s, empty, node)
    fact = core.fct_price(prices)
    fixed = fact.withColumn("price_nzd_mwh", F.least("price_nzd_mwh", F.lit(100.0)))
    path = str(tmp_path / "spikes")
    incremental.refresh(spark, path, "mart_price_spike_events", fact, build_spikes)
    assert incremental.load(spark, path, build_spikes(fact)).first().unmatched_generation
    incremental.refresh(spark, path, "mart_price_spike_events", fixed, build_spikes)
    assert incremental.load(spark, path, build_spikes(fact)).count() == 1
    incremental.refresh(spark, path, "mart_price_spike_events", fixed, build_spikes, exact=True)
    assert incremental.load(spark, path, build_spikes(fact)).count() == 0


def test_serving_pages(spark, tables):
    kpis = one(serving.overview(
        tables["mart_generation_monthly"], tables["mart_renewable_ratio"], tables["mart_price_daily"],
        tables["mart_price_spike_events"],
    ))
    assert (kpis.year_month, kpis.top_fuel, kpis.yoy_pct, kpis.spike_events) == ("202306", "Hydro", None, 1)
    labels = serving.event_list(serving.spike_context(tables["mart_price_offer_context"], tables["dim_node"]))
    assert [r.event_label for r in labels.collect()] == ["2023-06-17 TP31 | COR0111 | $780/MWh"]
    window = serving.context_window(tables["mart_price_offer_context"], "COR0111", date(2023, 6, 17), -3, 4)
    assert [r.tp_number for r in window.collect()] == [1, 2, 3, 4]
    spread = serving.island_spread(tables["mart_price_daily"])
    assert spread.count() == 30 and one(serving.spread_summary(spread)).dearer == "North Island"
    trend = serving.renewable_trend(tables["mart_renewable_ratio"]).collect()
    assert [r.rolling_pct for r in trend] == [81.82]  # one month: the minimum shrinks to one
    assert serving.top_stations(tables["mart_plant_ranking"], n=2).count() == 2


def test_telemetry(spark, tmp_path):
    doc = """{"metadata": {"invocation_id": "i1", "generated_at": "2024-01-30T10:00:00.5Z"}, "results": [
      {"unique_id": "model.p.a", "status": "success", "execution_time": 1.5, "failures": null,
       "message": "%s", "adapter_response": {"_message": "OK"}},
      {"unique_id": "test.p.b.c1", "status": "fail", "execution_time": 0.25, "failures": 3}]}""" % ("m" * 600)
    (tmp_path / "run_results.json").write_text(doc)
    from tidewatt.sources.runs import ingest_run_results

    raw = ingest_run_results(spark, str(tmp_path / "run_results.json"))
    assert {t for _, t in raw.dtypes} == {"string"}
    cut = ingest_run_results(spark, str(tmp_path / "run_results.json"), 500)
    assert {len(r.message) for r in cut.collect()} == {500, 0}
    runs = core.fct_run(staging.stg_run(raw))
    a, b = runs.orderBy("node_unique_id").collect()
    assert (a.node_type, a.node_name, len(a.message), a.execution_time_seconds, a.is_success) == ("model", "a", 600, 1.5, True)
    assert (b.node_name, b.failures, b.message, b.adapter_message, b.invocation_rank_desc) == ("c1", 3, None, None, 1)
    slo = serving.slo_status(runs, datetime(2024, 2, 1)).first()
    assert (slo.freshness_days, slo.freshness_status, slo.model_status, slo.test_status) == (1, "On target", "On target", "Needs attention")
    assert serving.slo_status(runs.filter("node_type = 'test'"), datetime(2024, 2, 1)).first().model_status == "No recent data"
    assert serving.latest_problems(runs).count() == 1


def test_load_counts(spark, base, tmp_path):
    raw = files.scan_price(spark, f"{base}/price")
    n = sinks.write_counted(raw, lambda d: sinks.replace_period(d, str(tmp_path / "p"), "trading_month"))
    assert n == 4320
    assert [tuple(r) for r in sinks.load_report(spark.read.parquet(str(tmp_path / "p")), "trading_month").collect()] == [("202306", 4320)]
