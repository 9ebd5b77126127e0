"""Raw file layouts. Every raw column is text; types are applied in staging."""

from __future__ import annotations

from pyspark.sql import types as T

MTIME = "_source_file_modified_at"
PERIODS = 50

# Header names of the source files, in file order, and the raw column names.
GENERATION_IDS = {
    "Site_Code": "site_code",
    "POC_Code": "poc_code",
    "Nwk_Code": "nwk_code",
    "Gen_Code": "gen_code",
    "Fuel_Code": "fuel_code",
    "Tech_Code": "tech_code",
    "Trading_Date": "trading_date",
}
GENERATION = {**GENERATION_IDS, **{f"TP{i}": f"tp{i}" for i in range(1, PERIODS + 1)}}
PRICE = {
    "TradingDate": "trading_date",
    "TradingPeriod": "trading_period",
    "PointOfConnection": "point_of_connection",
    "DollarsPerMegawattHour": "dollars_per_mwh",
}
VOLUME = {
    "PointOfConnection": "point_of_connection",
    "Network": "network",
    "Island": "island",
    "Participant": "participant",
    "TradingDate": "trading_date",
    "TradingPeriod": "trading_period",
    "TradingPeriodStartTime": "trading_period_start_time",
    "FlowDirection": "flow_direction",
    "KilowattHours": "kilowatt_hours",
}
OFFERS = {
    "TradingDate": "trading_date",
    "TradingPeriod": "trading_period",
    "ParticipantCode": "participant_code",
    "PointOfConnection": "point_of_connection",
    "Unit": "unit",
    "ProductType": "product_type",
    "ProductClass": "product_class",
    "ReserveType": "reserve_type",
    "ProductDescription": "product_description",
    "UTCSubmissionDate": "utc_submission_date",
    "UTCSubmissionTime": "utc_submission_time",
    "SubmissionOrder": "submission_order",
    "IsLatestYesNo": "is_latest_yes_no",
    "Tranche": "tranche",
    "MaximumRampUpMegawattsPerHour": "maximum_ramp_up_mw_per_hour",
    "MaximumRampDownMegawattsPerHour": "maximum_ramp_down_mw_per_hour",
    "PartiallyLoadedSpinningReservePercent": "partially_loaded_spinning_reserve_percent",
    "MaximumOutputMegawatts": "maximum_output_mw",
    "ForecastOfGenerationPotentialMegawatts": "forecast_generation_potential_mw",
    "Megawatts": "megawatts",
    "DollarsPerMegawattHour": "dollars_per_mwh",
}
NSP = {
    "Current flag": "current_flag",
    "NSP": "nsp",
    "NSP replaced by": "nsp_replaced_by",
    "POC code": "poc_code",
    "Network participant": "network_participant",
    "Embedded under POC code": "embedded_under_poc_code",
    "Embedded under network participant": "embedded_under_network_participant",
    "Reconciliation type": "reconciliation_type",
    "X flow": "x_flow",
    "I flow": "i_flow",
    "Description": "description",
    "NZTM easting": "nztm_easting",
    "NZTM northing": "nztm_northing",
    "Network reporting region ID": "network_reporting_region_id",
    "Network reporting region": "network_reporting_region",
    "Zone": "zone",
    "Island": "island",
    "Start date": "start_date",
    "Start TP": "start_tp",
    "End date": "end_date",
    "End TP": "end_tp",
    "SB ICP": "sb_icp",
    "Balancing code": "balancing_code",
    "MEP": "mep",
    "Responsible participant": "responsible_participant",
    "Certification expiry": "certification_expiry",
    "Metering information exemption expiry date": "metering_information_exemption_expiry_date",
}
HYDRO = {
    "Date": "date_str",
    "Time": "time_str",
    "Lake level (m)": "level_m",
    "Active storage (Mm³)": "active_storage_mm3",
    "Active contingent storage (Mm³)": "contingent_storage_mm3",
    "QualityCode": "quality_code",
}
RUN_COLUMNS = (
    "invocation_id",
    "generated_at",
    "dbt_version",
    "node_unique_id",
    "node_type",
    "node_name",
    "status",
    "execution_time_seconds",
    "failures",
    "message",
    "relation_name",
    "adapter_message",
)
# File names; the first group is the period (or site) tag.
FILE_NAMES = {
    "generation": r"^(\d{6})_Generation_MD\.csv$",
    "price": r"^(\d{6})_FinalEnergyPrices\.csv$",
    "volume": r"^(\d{6})_ReconciledInjectionAndOfftake\.csv(?:\.gz)?$",
    "offers": r"^(\d{8})_Offers\.csv$",
    "nsp": r"^(NetworkSupplyPointsTable)\.csv$",
    "hydro": r"^([A-Z]{2}_[A-Z]{2,4})_Storage_.*\.csv$",
}


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def raw_schema(columns, period: str | None = "trading_month", mtime: bool = True) -> T.StructType:
    """Schema of a raw table: text columns, the period tag and the file time."""
    fields = list(text_schema(columns).fields)
    if period:
        fields.append(T.StructField(period, T.StringType()))
    if mtime:
        fields.append(T.StructField(MTIME, T.TimestampNTZType()))
    return T.StructType(fields)


RAW_TABLES = {
    "raw_generation": raw_schema(GENERATION.values()),
    "raw_price": raw_schema(PRICE.values()),
    "raw_market_volume": raw_schema(VOLUME.values()),
    "raw_offers": raw_schema(OFFERS.values()),
    "raw_nsp": raw_schema(NSP.values(), period=None),
    "raw_hydro_storage": raw_schema(["site_code", *HYDRO.values()], period=None),
    "raw_dbt_run": raw_schema(RUN_COLUMNS, period=None, mtime=False),
}
