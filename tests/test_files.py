from __future__ import annotations

import csv
from datetime import date

import pytest

from tests import market
from tidewatt import schemas
from tidewatt.plans import quality
from tidewatt.schemas import FILE_NAMES, MTIME
from tidewatt.sources import files


def test_scans_tag_and_rename(spark, workdir):
    market.publish(spark, workdir)
    raw = market.scanned(spark, workdir)
    assert raw["raw_generation"].columns == [*schemas.GENERATION.values(), "trading_month", MTIME]
    assert raw["raw_market_volume"].select("trading_month").distinct().collect()[0][0] == "202306"
    assert raw["raw_market_volume"].count() == 2 * 3 * 30 * 48  # gzip
    assert raw["raw_offers"].select("trading_month").distinct().collect()[0][0] == "202306"
    hydro = raw["raw_hydro_storage"]
    assert hydro.columns == ["site_code", *schemas.HYDRO.values(), MTIME]
    assert hydro.first().site_code == "SI_TKA"
    assert "poc_code" in raw["raw_nsp"].columns


def test_other_files_are_left_out(spark, workdir):
    market.put(f"{workdir}/202306_FinalEnergyPrices.csv", schemas.PRICE, market.prices(spark, 1))
    market.put(f"{workdir}/notes.csv", schemas.PRICE, market.prices(spark, 1))
    assert files.scan_price(spark, workdir).count() == 3 * 48


def test_wrong_header_and_bad_rows_fail(spark, workdir):
    header = list(schemas.VOLUME)
    header[0], header[1] = header[1], header[0]
    market.put(f"{workdir}/202401_ReconciledInjectionAndOfftake.csv", header, market.volumes(spark, 1)[:3])
    with pytest.raises(Exception, match="header"):
        files.scan_volume(spark, workdir).collect()
    with pytest.raises(Exception, match="header"):
        files.scan_volume(spark, workdir).count()


def test_bad_row_modes(spark, workdir):
    path = f"{workdir}/202401_FinalEnergyPrices.csv"
    market.put(path, schemas.PRICE, [["2024-01-01", 1, "A", "1"], ["2024-01-01", 2, "A", "2", "extra"]])
    for use in (lambda d: d.collect(), lambda d: d.count(), lambda d: d.select("trading_date").collect()):
        with pytest.raises(Exception):
            use(files.scan_price(spark, workdir))
    skipped = files.scan_price(spark, workdir, on_bad_row="skip")
    assert [r.trading_period for r in skipped.select("trading_period").collect()] == ["1"] and skipped.count() == 1
    kept = files.scan_price(spark, workdir, on_bad_row="keep").collect()
    assert sum(r._bad_row is not None for r in kept) == 1


def test_null_tokens_and_nul_bytes(spark, workdir):
    market.put(f"{workdir}/202401_FinalEnergyPrices.csv", schemas.PRICE,
              [["2024-01-01", 1, "A", "NULL"], ["2024-01-01", 2, "A\x00B", ""], ["2024-01-01", 3, "A", "null"]])
    rows = files.scan_price(spark, workdir, tokens=("", "NULL", "null")).orderBy("trading_period").collect()
    assert [r.dollars_per_mwh for r in rows] == [None, None, None]
    assert rows[1].point_of_connection == "AB"


def test_latest_file_and_snapshot(spark, workdir):
    for name in ("R_202401_20240203.csv", "R_202401_20240310.csv", "R_202402_20240305.csv"):
        with open(f"{workdir}/{name}", "w") as f:
            csv.writer(f).writerows([["a"], [name]])
    listed = files.list_files(spark, workdir)
    latest = {r.period: r.name for r in files.latest_file_per_period(listed, r"^R_(\d{6})_").collect()}
    assert latest == {"202401": "R_202401_20240310.csv", "202402": "R_202402_20240305.csv"}
    rows = files.scan_latest(spark, listed, r"^R_(\d{6})_", lambda s, p: files.scan_csv(s, p, {"a": "a"}))
    assert {r.a for r in rows.collect()} == set(latest.values())
    newest = files.newest_snapshot(listed, r"_(\d{8})\.csv$", date(2024, 3, 12)).first()
    assert newest.name == "R_202401_20240310.csv"
    assert files.newest_snapshot(listed, r"_(\d{8})\.csv$", date(2024, 4, 12)).count() == 0


def test_read_or_empty(spark, workdir):
    schema = schemas.RAW_TABLES["raw_price"]
    assert files.read_or_empty(spark, f"{workdir}/none", schema).count() == 0
    spark.createDataFrame([("a",)], "x string").write.parquet(f"{workdir}/some")
    assert files.read_or_empty(spark, f"{workdir}/some", "x string").count() == 1


def violations(spark, path, contract, kind):
    found = quality.check_files(spark, path, contract, FILE_NAMES[kind])
    return {(r.rule, r.value) for r in found.collect()}


def test_clean_files_meet_their_contracts(spark, workdir):
    market.publish(spark, workdir)
    assert violations(spark, f"{workdir}/price", quality.price_contract(), "price") == set()
    assert violations(spark, f"{workdir}/volume", quality.volume_contract(), "volume") == set()
    assert violations(spark, f"{workdir}/offers", quality.offers_contract(), "offers") == set()
    assert violations(spark, f"{workdir}/generation", quality.generation_contract(), "generation") == set()


def test_price_contract_reports_each_fault(spark, workdir):
    rows = market.prices(spark, 1)
    rows[0][0], rows[1][1], rows[2][3], rows[3][3], rows[4] = "2024-02-01", "51", "abc", "null", rows[4][:3]
    rows[5][1] = "x"
    market.put(f"{workdir}/202306_FinalEnergyPrices.csv", schemas.PRICE, rows)
    found = violations(spark, workdir, quality.price_contract(), "price")
    assert {r for r, _ in found} == {"month", "trading_period", "price", "columns"}
    assert {v for r, v in found if r == "trading_period"} == {"51", "x"}


def test_header_size_and_name(spark, workdir):
    market.put(f"{workdir}/prices.csv", ["a", "b", "c", "d"], market.prices(spark, 1)[:5])
    rules = {r for r, _ in violations(spark, workdir, quality.price_contract(), "price")}
    assert {"header", "row_count", "file_name"} <= rules


def test_generation_contract(spark, workdir):
    rows = market.generation(spark)
    rows[0][4], rows[1][10], rows[2][11] = "Peat", "12x", "NULL"
    market.put(f"{workdir}/202306_Generation_MD.csv", schemas.GENERATION, rows)
    found = violations(spark, workdir, quality.generation_contract(), "generation")
    assert found == {("fuel_code", "Peat"), ("tp4", "12x")}


def test_offers_unit_only_needed_for_energy(spark, workdir):
    rows = market.offers(spark)
    rows[0][4], rows[1][4], rows[1][5] = "", "", "Reserve"
    rows[2][12] = "maybe"
    market.put(f"{workdir}/20230617_Offers.csv", schemas.OFFERS, rows)
    found = violations(spark, workdir, quality.offers_contract(), "offers")
    assert found == {("unit", None), ("is_latest", "maybe")}


def test_stitched(spark):
    monthly = spark.createDataFrame([("202401", 1)], "trading_month string, v int")
    daily = spark.createDataFrame([("202401", 2), ("202402", 3)], "trading_month string, v int")
    assert {r.v for r in files.stitched(monthly, daily).collect()} == {1, 3}


def test_plan_files(spark):
    names = ["m/202401_r1.csv", "m/202401_r2.csv", "m/202403_r1.csv", "d/20240105_r1.csv", "d/20240207_r1.csv", "d/20240207_r3.csv", "x/other.csv"]
    listed = spark.createDataFrame([(f"file:/{n}", n.split("/")[1]) for n in names], "file_path string, name string")
    plan = files.plan_files(listed, {"month": r"/m/(\d{6})_(r\d)", "day": r"/d/(\d{8})_(r\d)"})
    assert {(r.file_path[6:], r.kind, r.period) for r in plan.collect()} == {
        ("m/202401_r2.csv", "month", "202401"), ("m/202403_r1.csv", "month", "202403"), ("d/20240207_r3.csv", "day", "20240207")}


def test_headers_in_two_spellings(spark, workdir):
    from tidewatt.sources import lines

    market.put(f"{workdir}/NI_AA_Storage_x.csv", ["Date", "Active storage (Mm³)"], [["2024-01-01", "5"]])
    market.put(f"{workdir}/NI_BB_Storage_x.csv.gz", ["﻿Active storage (Mm3) ", "Date"], [["7", "2024-01-02"]])
    open(f"{workdir}/NI_CC_Storage_x.csv", "w").close()
    got = files.scan_lakes(spark, workdir, r"/(\w\w_\w\w)_Storage_").select("site_code", "date_str", "active_storage_mm3", "level_m").collect()
    assert {tuple(r) for r in got} == {("NI_AA", "2024-01-01", "5", None), ("NI_BB", "2024-01-02", "7", None)}
    heads = lines.headers(files.list_files(spark, workdir)).collect()
    assert {tuple(r.columns) for r in heads} == {("Date", "Active storage (Mm3)"), ("Active storage (Mm3)", "Date")}
    market.put(f"{workdir}/NI_DD_Storage_x.csv", ["Date", "Active storage (Mm³)"], [["2024-01-01", "5", "6"]])
    for use in (lambda d: d.count(), lambda d: d.select("date_str").collect()):
        with pytest.raises(Exception, match="wrong number of fields"):
            use(files.scan_lakes(spark, workdir))


def test_a_change_of_several_periods_is_seen_whole(spark, workdir):
    from pyspark.sql import functions as F

    from tidewatt.sources import sinks

    path, schema = f"{workdir}/t", "v long, m string"
    assert sinks.read_published(spark, path, schema).count() == 0
    rows = lambda v, months: spark.createDataFrame([(v, m) for m in months], schema)
    seen = lambda: {(r.m, r.v) for r in sinks.read_published(spark, path, schema).collect()}
    sinks.publish_periods(spark, rows(1, ["202401", "202402", "202403"]), path, "m")
    old = sinks.read_published(spark, path, schema)
    lost = rows(2, ["202401", "202402"]).withColumn("v", F.when(F.col("m") == "202402", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        sinks.publish_periods(spark, lost, path, "m")
    assert seen() == {("202401", 1), ("202402", 1), ("202403", 1)}
    sinks.publish_periods(spark, rows(2, ["202401", "202402"]), path, "m", gone=["202403"])
    assert seen() == {("202401", 2), ("202402", 2)}
    assert {(r.m, r.v) for r in old.collect()} == {("202401", 1), ("202402", 1), ("202403", 1)}  # a reader from before
    sinks.drop_unpublished(spark, path)
    assert seen() == {("202401", 2), ("202402", 2)}


def test_counted_by_period(spark):
    from tidewatt.sources import sinks

    df = spark.createDataFrame([("202401",)] * 3 + [("000012",), (None,)], "m string")
    got = sinks.counted_by_period(df, lambda d: d.write.format("noop").mode("overwrite").save(), "m")
    assert {tuple(r) for r in got.collect()} == {("202401", 3), ("000012", 1), (None, 1)}
    with pytest.raises(ValueError):
        sinks.counted_by_period(df.selectExpr("'x' as m"), lambda d: d.write.format("noop").mode("overwrite").save(), "m")
