"""Listings of the marts in their stable order, and dimension rows with what depends on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import stand_ins as s
from registry.base import QUERIES, SQL, query
from registry.ctes import with_
from registry.models import HYDRO
from tidewatt.plans import core, serving
from tidewatt.sources import seeds

# Listing: (mart, the query that builds it, its SQL form if that is not the query's own).
_MARTS = {
    "monthly_listing": ("mart_generation_monthly", "monthly_two_distincts"),
    "renewable_listing": ("mart_renewable_ratio", "renewable_ratio"),
    "seasonal_listing": ("mart_seasonal_pattern", "seasonal_pattern"),
    "spike_listing": ("mart_price_spike_events", "spike_events"),
    "renewable_price_listing": ("mart_renewable_price_impact", "renewable_price_impact"),
    "hydro_driver_listing": ("mart_hydro_price_driver", "hydro_price_driver"),
    "usage_listing": ("mart_usage_cost", "usage_cost"),
}
_CATCHMENTS = "(VALUES " + ", ".join(
    "(" + ", ".join(f"'{x}'" for x in row) + ")" for row in seeds._rows(seeds.HYDRO_CATCHMENTS)
) + ") AS c(site_code, catchment_name, island, plant_group, scheme)"


def _columns(mart: str) -> str:
    columns = list(serving.LISTINGS[mart][0])
    dated = ["CAST(strptime(year_month || '01', '%Y%m%d') AS DATE) AS date"] if "year_month" in columns else []
    return ", ".join(columns + dated)


def _register(name: str, mart: str, model: str) -> None:
    @query(name, f"SELECT {_columns(mart)} FROM ({SQL[model]}) AS m")
    def listed(spark, sf):
        return serving.listing(QUERIES[model](spark, sf), mart)


for _name, (_mart, _model) in _MARTS.items():
    _register(_name, _mart, _model)


@query("run_listing", with_("runs", f"SELECT {_columns('fct_run').replace('dbt_version', '''1.0::VARCHAR AS dbt_version''')} FROM runs"))
def run_listing(spark, sf):
    return serving.listing(s.fct_run(spark, sf), "fct_run")


@query(
    "hydro_listing",
    with_("hydro", f"""SELECT h.site_code, c.catchment_name, h.island, c.scheme, h.trading_date, h.active_storage_mm3,
          h.active_storage_mm3 AS level_m, h.quality_code FROM hydro h LEFT JOIN {_CATCHMENTS} ON c.site_code = h.site_code"""),
)
def hydro_listing(spark, sf):
    return serving.listing(s.fct_hydro(spark, sf, HYDRO), "fct_hydro")


@query(
    "fct_hydro_wide",
    with_("hydro", f"""SELECT md5(h.site_code || '-' || trading_date) AS hydro_id, date_key, trading_date, h.site_code, c.catchment_name,
          h.island, c.plant_group, c.scheme, active_storage_mm3 AS level_m, active_storage_mm3,
          CAST(NULL AS DOUBLE) AS contingent_storage_mm3, quality_code FROM hydro h LEFT JOIN {_CATCHMENTS} ON c.site_code = h.site_code"""),
)
def fct_hydro_wide(spark, sf):
    """Every column, with what the catchment gives."""
    return s.fct_hydro(spark, sf, HYDRO)


@query(
    "dim_catchment",
    with_("hydro", f"""SELECT md5(c.site_code) AS catchment_key, c.*, count(h.site_code) AS readings, max(h.trading_date) AS last_reading
          FROM {_CATCHMENTS} LEFT JOIN hydro h ON h.site_code = c.site_code GROUP BY ALL"""),
)
def dim_catchment(spark, sf):
    """The dimension whole, with the readings of its lakes."""
    readings = s.fct_hydro(spark, sf, HYDRO).groupBy("site_code").agg(
        F.count(F.lit(1)).alias("readings"), F.max("trading_date").alias("last_reading"))
    found = core.dim_catchment(seeds.hydro_catchments(spark)).join(readings, "site_code", "left")
    return found.withColumn("readings", F.coalesce("readings", F.lit(0)))
