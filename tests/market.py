"""A small market of three nodes in June 2023, with 48 half hours a day, as published CSV files.

Every table is an expression over days and half hours, chosen so that sums can be worked out by hand:
a plant makes weight x ((7 day + half hour) mod 10 + 1) kWh, which adds up to 7,920 weights in the month
(30 days of four full cycles of 55 and eight of the ten values of a fifth; what is missing goes through all values).
"""

from __future__ import annotations

import csv
import gzip
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt import schemas
from tidewatt.sources import files

MONTH, SPIKE_DAY = "202306", "2023-06-17"
# Node: (island, price at the start of each cycle of eight half hours).
NODES = "('ALP0331', 'SI', 60), ('BAY0221', 'NI', 90), ('COR0111', 'NI', 75)"
# Plant: (site, node, unit, fuel, weight).
PLANTS = ("('Alpine', 'ALP0331', 'alp1', 'Hydro', 100), ('Bayside', 'BAY0221', 'bay1', 'Coal', 40), "
          "('Corner', 'COR0111', 'cor1', 'Wind', 20), ('Corner', 'COR0111', 'cor2', 'Geo', 60)")


def half_hours(spark: SparkSession, days: int = 30) -> DataFrame:
    """(trading_date, day, tp) of the first days."""
    return spark.range(48 * days).selectExpr(
        "cast(date_add(date '2023-06-01', cast(id div 48 as int)) as string) as trading_date", "id div 48 + 1 as day", "id % 48 + 1 as tp")


def listed(df: DataFrame) -> list[list]:
    """Rows in order of their text, empty for null."""
    return sorted((["" if v is None else v for v in r] for r in df.collect()), key=lambda r: [str(v) for v in r])


def generation(spark: SparkSession) -> list[list]:
    made = half_hours(spark).crossJoin(spark.sql(f"SELECT * FROM VALUES {PLANTS} AS p(site, node, unit, fuel, weight)"))
    made = made.groupBy("site", "node", "unit", "fuel", "trading_date").pivot("tp", list(range(1, 51))).agg(
        F.sum(F.expr("weight * ((7 * day + tp) % 10 + 1)")))
    return listed(made.select("site", "node", F.lit("N1"), "unit", "fuel", F.lit("X"), "trading_date", *[f"`{i}`" for i in range(1, 51)]))


def prices(spark: SparkSession, days: int = 30) -> list[list]:
    """A spike of 780 at Corner and a price below zero at Alpine."""
    at = half_hours(spark, days).crossJoin(spark.sql(f"SELECT * FROM VALUES {NODES} AS n(node, island, start)"))
    price = F.expr(f"""CASE WHEN node = 'COR0111' AND trading_date = '{SPIKE_DAY}' AND tp = 31 THEN 780.00
        WHEN node = 'ALP0331' AND day = 9 AND tp = 5 THEN -3.25 ELSE start + 5 * (tp % 8) END""")
    return listed(at.select("trading_date", "tp", "node", price.cast("decimal(9,2)").cast("string")))


def volumes(spark: SparkSession, days: int = 30) -> list[list]:
    """Offtake of 1000 + 10 tp kWh, half of it injected."""
    at = half_hours(spark, days).crossJoin(spark.sql(
        f"SELECT * FROM VALUES {NODES} AS n(node, island, start), VALUES ('Offtake', 1.0), ('Injection', 0.5) AS f(flow, part)"))
    kwh = F.expr("cast((1000 + 10 * tp) * part as decimal(9,1))").cast("string")
    return listed(at.select("node", F.lit("N1"), "island", F.lit("trader"), "trading_date", "tp", F.lit("00:00"), "flow", kwh))


def offers(spark: SparkSession) -> list[list]:
    """On the day of the spike, four tranches of 25 k MW at 60 k squared, and an older version of the first."""
    at = half_hours(spark).filter(f"trading_date = '{SPIKE_DAY}'").crossJoin(spark.sql(
        """SELECT * FROM VALUES ('ALP0331'), ('COR0111') AS n(node),
           VALUES (1, 2, 'Y', 25), (2, 2, 'Y', 50), (3, 2, 'Y', 75), (4, 2, 'Y', 100), (1, 1, 'N', 999) AS t(k, version, newest, mw)"""))
    blank = F.lit("")
    return listed(at.select(
        "trading_date", "tp", F.lit("maker"), "node", F.lit("one"), F.lit("Energy"), F.lit("Injection"), blank, F.lit("text"),
        F.lit("2023-06-16"), F.lit("12:00:00"), "version", "newest", "k", F.lit("10"), F.lit("10"), blank, F.lit("500"), blank, "mw",
        F.expr("60 * k * k")))


def nodes() -> list[list]:
    """Alpine has an undated and an old version beside the one that counts; one row has no node."""
    def row(flag, nsp, node, island, start):
        named = {"Current flag": flag, "NSP": nsp, "POC code": node, "Island": island, "Zone": "zone", "Start date": start,
                 "NZTM easting": "1500000.5", "Network reporting region": f"region {island}"}
        return [named.get(c, "") for c in schemas.NSP]

    return [row("1", "ALP_A", "ALP0331", "SI", "2019-05-01"), row("1", "ALP_B", " ALP0331 ", "NI", ""), row("0", "ALP_C", "ALP0331", "NI", "2023-01-01"),
            row("1", "BAY_A", "BAY0221", "NI", "2018-01-01"), row("1", "COR_A", "COR0111", "NI", "2018-01-01"), row("1", "NONE", " ", "NI", "2018-01-01")]


def lake(spark: SparkSession) -> list[list]:
    """Storage of 300 + 2 day; one reading is too old, one has no date."""
    rows = spark.range(1, 31).selectExpr(
        "cast(date_add(date '2023-05-31', cast(id as int)) as string)", "'24:00:00'", "'700.5'", "cast(300 + 2 * id as string)", "'0'", "'200'")
    return listed(rows) + [["2014-06-01", "", "", "5", "", ""], ["no date", "", "", "5", "", ""]]


def put(path: str, header, rows) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with (gzip.open if path.endswith(".gz") else open)(path, "wt", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([list(header), *rows])


# Kind: (file below its folder, header, rows).
PUBLISHED = {
    "generation": (f"{MONTH}_Generation_MD.csv", schemas.GENERATION, generation),
    "price": (f"{MONTH}_FinalEnergyPrices.csv", schemas.PRICE, prices),
    "volume": (f"{MONTH}_ReconciledInjectionAndOfftake.csv.gz", schemas.VOLUME, volumes),
    "offers": (f"{SPIKE_DAY.replace('-', '')}_Offers.csv", schemas.OFFERS, offers),
    "nsp": ("NetworkSupplyPointsTable.csv", schemas.NSP, lambda spark: nodes()),
    "hydro": ("SI_TKA_Storage_Tekapo.csv", schemas.HYDRO, lake),
}
SCANS = {"raw_generation": ("generation", files.scan_generation), "raw_price": ("price", files.scan_price),
         "raw_market_volume": ("volume", files.scan_volume), "raw_offers": ("offers", files.scan_offers),
         "raw_nsp": ("nsp", files.scan_nsp), "raw_hydro_storage": ("hydro", files.scan_hydro)}


def publish(spark: SparkSession, base: str) -> None:
    for kind, (name, header, rows) in PUBLISHED.items():
        put(f"{base}/{kind}/{name}", header, rows(spark))


def scanned(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {table: scan(spark, f"{base}/{kind}") for table, (kind, scan) in SCANS.items()}
