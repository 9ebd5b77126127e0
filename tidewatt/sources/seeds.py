"""Reference data small enough to live with the code."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

# Raw fuel code, fuel type, renewable.
FUEL_CODES = """
Gas,Gas,false
Hydro,Hydro,true
HYD,Hydro,true
Geo,Geothermal,true
GEO,Geothermal,true
Wind,Wind,true
Diesel,Diesel,false
Coal,Coal,false
Wood,Wood,true
Solar,Solar,true
SOL,Solar,true
ELE,Battery,false
"""

# Lake site code, lake, island, plant group, scheme.
HYDRO_CATCHMENTS = """
NI_TPO,Lake Taupo,NI,Waikato river,Waikato
NI_WKA,Lake Waikaremoana,NI,Waikaremoana,Waikaremoana
SI_TKA,Lake Tekapo,SI,Waitaki river,Waitaki
SI_PKI,Lake Pukaki,SI,Waitaki river,Waitaki
SI_OHA,Lake Ohau,SI,Waitaki river,Waitaki
SI_HWE,Lake Hawea,SI,Clutha,Clutha
SI_WAN,Lake Wanaka,SI,Clutha,Clutha
SI_WPU,Lake Wakatipu,SI,Clutha,Clutha
SI_MAN,Lake Manapouri,SI,Manapouri,Manapouri
SI_TAU,Lake Te Anau,SI,Manapouri,Manapouri
"""

# National public holidays as observed.
PUBLIC_HOLIDAYS = """
2016-01-01,New Year's Day
2016-01-04,Day after New Year's Day
2016-02-08,Waitangi Day (Observed)
2016-03-25,Good Friday
2016-03-28,Easter Monday
2016-04-25,Anzac Day
2016-06-06,Queen's Birthday
2016-10-24,Labour Day
2016-12-26,Christmas Day (Observed)
2016-12-27,Boxing Day (Observed)
2017-01-02,New Year's Day (Observed)
2017-01-03,Day after New Year's Day (Observed)
2017-02-06,Waitangi Day
2017-04-14,Good Friday
2017-04-17,Easter Monday
2017-04-25,Anzac Day
2017-06-05,Queen's Birthday
2017-10-23,Labour Day
2017-12-25,Christmas Day
2017-12-26,Boxing Day
2018-01-01,New Year's Day
2018-01-02,Day after New Year's Day
2018-02-06,Waitangi Day
2018-03-30,Good Friday
2018-04-02,Easter Monday
2018-04-25,Anzac Day
2018-06-04,Queen's Birthday
2018-10-22,Labour Day
2018-12-25,Christmas Day
2018-12-26,Boxing Day
2019-01-01,New Year's Day
2019-01-02,Day after New Year's Day
2019-02-06,Waitangi Day
2019-04-19,Good Friday
2019-04-22,Easter Monday
2019-04-25,Anzac Day
2019-06-03,Queen's Birthday
2019-10-28,Labour Day
2019-12-25,Christmas Day
2019-12-26,Boxing Day
2020-01-01,New Year's Day
2020-01-02,Day after New Year's Day
2020-02-06,Waitangi Day
2020-04-10,Good Friday
2020-04-13,Easter Monday
2020-04-27,Anzac Day (Observed)
2020-06-01,Queen's Birthday
2020-10-26,Labour Day
2020-12-25,Christmas Day
2020-12-28,Boxing Day (Observed)
2021-01-01,New Year's Day
2021-01-04,Day after New Year's Day (Observed)
2021-02-06,Waitangi Day
2021-04-02,Good Friday
2021-04-05,Easter Monday
2021-04-26,Anzac Day (Observed)
2021-06-07,Queen's Birthday
2021-10-25,Labour Day
2021-12-27,Christmas Day (Observed)
2021-12-28,Boxing Day (Observed)
2022-01-03,New Year's Day (Observed)
2022-01-04,Day after New Year's Day (Observed)
2022-02-07,Waitangi Day (Observed)
2022-04-15,Good Friday
2022-04-18,Easter Monday
2022-04-25,Anzac Day
2022-06-06,Queen's Birthday
2022-06-24,Matariki
2022-10-24,Labour Day
2022-12-26,Christmas Day (Observed)
2022-12-27,Boxing Day (Observed)
2023-01-02,New Year's Day (Observed)
2023-01-03,Day after New Year's Day (Observed)
2023-02-06,Waitangi Day
2023-04-07,Good Friday
2023-04-10,Easter Monday
2023-04-25,Anzac Day
2023-06-05,King's Birthday
2023-07-14,Matariki
2023-10-23,Labour Day
2023-12-25,Christmas Day
2023-12-26,Boxing Day
2024-01-01,New Year's Day
2024-01-02,Day after New Year's Day
2024-02-06,Waitangi Day
2024-03-29,Good Friday
2024-04-01,Easter Monday
2024-04-25,Anzac Day
2024-06-03,King's Birthday
2024-06-28,Matariki
2024-10-28,Labour Day
2024-12-25,Christmas Day
2024-12-26,Boxing Day
2025-01-01,New Year's Day
2025-01-02,Day after New Year's Day
2025-02-06,Waitangi Day
2025-04-18,Good Friday
2025-04-21,Easter Monday
2025-04-25,Anzac Day
2025-06-02,King's Birthday
2025-06-20,Matariki
2025-10-27,Labour Day
2025-12-25,Christmas Day
2025-12-26,Boxing Day
2026-01-01,New Year's Day
2026-01-02,Day after New Year's Day
2026-02-06,Waitangi Day
2026-04-03,Good Friday
2026-04-06,Easter Monday
2026-04-27,Anzac Day (Observed)
2026-06-01,King's Birthday
2026-07-10,Matariki
2026-10-26,Labour Day
2026-12-25,Christmas Day
2026-12-28,Boxing Day (Observed)
2027-01-01,New Year's Day
2027-01-04,Day after New Year's Day (Observed)
2027-02-08,Waitangi Day (Observed)
2027-03-26,Good Friday
2027-03-29,Easter Monday
2027-04-26,Anzac Day (Observed)
2027-06-07,King's Birthday
2027-06-25,Matariki
2027-10-25,Labour Day
2027-12-27,Christmas Day (Observed)
2027-12-28,Boxing Day (Observed)
2028-01-03,New Year's Day (Observed)
2028-01-04,Day after New Year's Day (Observed)
2028-02-07,Waitangi Day (Observed)
2028-04-14,Good Friday
2028-04-17,Easter Monday
2028-04-25,Anzac Day
2028-06-05,King's Birthday
2028-07-14,Matariki
2028-10-23,Labour Day
2028-12-25,Christmas Day
2028-12-26,Boxing Day
2029-01-01,New Year's Day
2029-01-02,Day after New Year's Day
2029-02-06,Waitangi Day
2029-03-30,Good Friday
2029-04-02,Easter Monday
2029-04-25,Anzac Day
2029-06-04,King's Birthday
2029-07-06,Matariki
2029-10-22,Labour Day
2029-12-25,Christmas Day
2029-12-26,Boxing Day
2030-01-01,New Year's Day
2030-01-02,Day after New Year's Day
2030-02-06,Waitangi Day
2030-04-19,Good Friday
2030-04-22,Easter Monday
2030-04-25,Anzac Day
2030-06-03,King's Birthday
2030-06-21,Matariki
2030-10-28,Labour Day
2030-12-25,Christmas Day
2030-12-26,Boxing Day
"""

# Fuel codes the file check accepts; two of them have no fuel type above.
KNOWN_FUEL_CODES = (
    "Gas", "Gas&Oil", "Hydro", "HYD", "Geo", "GEO", "Wind", "WIN",
    "Diesel", "Coal", "Wood", "Solar", "SOL", "ELE",
)


def _rows(text: str) -> list[list[str]]:
    return [line.split(",") for line in text.strip().splitlines()]


def fuel_codes(spark: SparkSession) -> DataFrame:
    rows = [(code, fuel, flag == "true") for code, fuel, flag in _rows(FUEL_CODES)]
    return spark.createDataFrame(rows, "raw_fuel_code string, fuel_type string, is_renewable boolean")


def hydro_catchments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        _rows(HYDRO_CATCHMENTS),
        "site_code string, catchment_name string, island string, plant_group string, scheme string",
    )


def public_holidays(spark: SparkSession) -> DataFrame:
    rows = [(date.fromisoformat(day), name) for day, name in _rows(PUBLIC_HOLIDAYS)]
    return spark.createDataFrame(rows, "holiday_date date, holiday_name string")
