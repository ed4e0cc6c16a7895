"""Serving frames: the data behind each dashboard chart and card (§2.11).

Only the data is built; drawing is not.  ``as_of`` replaces the wall
clock, so "future" is reproducible.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import risk_rules as R
from tidewatch.functions import scalars as X
from tidewatch.operators.dedupe import earliest_per_group, latest_per_group, rows_at_global_max
from tidewatch.plans import build
from tidewatch.plans import ledger as L
from tidewatch.plans import views_integrated as VI
from tidewatch.plans import views_price as VP
from tidewatch.plans import views_rig as VR
from tidewatch.plans import views_weather as VW
from tidewatch.plans.views_weather import avg_exact
from tidewatch.sources.testtables import AS_OF, RUN_TIME

Tables = Mapping[str, DataFrame]
ASSET_COLUMNS = [
    "asset_id", "asset_name", "asset_type", "operator_name", "is_active", "max_wind_kmh", "max_gust_kmh",
    "max_wave_height_m", "minimum_visibility_m", "location_name", "country", "latitude", "longitude",
]
# Asset used by the parameterised forecast query in the registry.
EXAMPLE_ASSET_NAME = "Customer#000000003"


def _active_assets(t: Tables) -> DataFrame:
    a = t["dim_asset"].where(F.col("is_active"))
    loc = t["dim_location"].select("location_key", "location_name", "country", "latitude", "longitude")
    return a.join(loc, on="location_key", how="inner")


def serve_assets(t: Tables) -> DataFrame:
    """Active assets with their location, by name."""
    return _active_assets(t).select("asset_key", *ASSET_COLUMNS).orderBy("asset_name")


def asset_map(t: Tables, as_of: str) -> DataFrame:
    """Active assets with the earliest risk at or after ``as_of`` in the global
    latest run; UNKNOWN when there is none (J12, W08, J15)."""
    run = VW.latest_global_run(t).where(F.col("forecast_valid_time") >= F.lit(as_of).cast("timestamp_ntz"))
    current = earliest_per_group(
        run.select("asset_key", "forecast_valid_time", "forecast_reference_time", "overall_risk_level", "source"),
        ["asset_key"], ["forecast_valid_time", "source"],
    ).drop("source")
    assets = _active_assets(t)
    return assets.join(current, on="asset_key", how="left").select(
        "asset_key", "asset_id", "asset_name", "asset_type", "operator_name", "location_name", "country",
        "latitude", "longitude", "max_wind_kmh", "max_gust_kmh", "max_wave_height_m", "minimum_visibility_m",
        "forecast_reference_time", "forecast_valid_time",
        F.coalesce(F.col("overall_risk_level"), F.lit("UNKNOWN")).alias("overall_risk_level"),
    ).orderBy("asset_name")


def asset_map_center(t: Tables, as_of: str) -> DataFrame:
    """Map centre: mean latitude / longitude over assets with coordinates."""
    pts = asset_map(t, as_of).dropna(subset=["latitude", "longitude"])
    return pts.agg(
        avg_exact("latitude").alias("center_latitude"),
        avg_exact("longitude").alias("center_longitude"),
        F.count(F.lit(1)).alias("assets_on_map"),
    )


def risk_distribution_long(t: Tables, snapshot_time: str) -> DataFrame:
    """Executive KPI row -> one (risk, hours) row per level."""
    snap = VI.executive_energy_operations(t, snapshot_time)
    return snap.unpivot(
        [], ["green_hours", "amber_hours", "red_hours", "unknown_hours"], "level_column", "hours"
    ).select(F.upper(F.regexp_replace("level_column", "_hours$", "")).alias("risk"), "hours")


def register_views(spark: SparkSession, t: Tables, as_of: str) -> None:
    """Register the 18 analytical views as temporary views, in dependency order."""
    for name, frame in [
        ("vw_offshore_operational_forecast", VW.offshore_operational_forecast(t)),
        ("vw_latest_offshore_forecast", VW.latest_offshore_forecast(t)),
        ("vw_offshore_safe_windows", VW.offshore_safe_windows(t)),
        ("vw_offshore_risk_summary", VW.offshore_risk_summary(t)),
        ("vw_offshore_critical_periods", VW.offshore_critical_periods(t)),
        ("vw_asset_operational_kpis", VW.asset_operational_kpis(t)),
        ("vw_next_weather_critical_event", VW.next_weather_critical_event(t, as_of)),
        ("vw_executive_energy_operations", VI.executive_energy_operations(t, as_of)),
        ("vw_oil_price_history", VP.oil_price_history(t)),
        ("vw_daily_oil_price_summary", VP.daily_oil_price_summary(t)),
        ("vw_latest_oil_price", VP.latest_oil_price_by_product(t)),
        ("vw_daily_oil_price", VP.daily_oil_price(t)),
        ("vw_energy_price_summary", VP.energy_price_summary(t)),
        ("vw_rig_count_history", VR.rig_count_history(t)),
        ("vw_rig_count_country_monthly", VR.rig_count_country_monthly(t)),
        ("vw_rig_count_monthly_change", VR.rig_count_monthly_change(t)),
        ("vw_rig_count_region_monthly", VR.rig_count_region_monthly(t)),
        ("vw_latest_rig_count", VR.latest_rig_count(t)),
    ]:
        frame.createOrReplaceTempView(name)


def register_ledger_views(spark: SparkSession, ledger: Tables) -> None:
    """Register the four observability views over the run ledger's tables."""
    for name, frame in [
        ("vw_latest_pipeline_run", L.latest_pipeline_run(ledger)),
        ("vw_latest_quality_summary", L.latest_quality_summary(ledger)),
        ("vw_latest_quality_checks", L.latest_quality_checks(ledger)),
        ("vw_pipeline_run_history", L.pipeline_run_history(ledger)),
    ]:
        frame.createOrReplaceTempView(name)


def asset_forecast(spark: SparkSession, t: Tables, asset_name: str) -> DataFrame:
    """One asset's latest forecast, time ordered, via a parameterised query."""
    VW.latest_offshore_forecast(t).createOrReplaceTempView("vw_latest_offshore_forecast")
    return spark.sql(
        "SELECT * FROM vw_latest_offshore_forecast WHERE asset_name = :asset_name ORDER BY forecast_valid_time",
        args={"asset_name": asset_name},
    )


def current_conditions(t: Tables, as_of: str) -> DataFrame:
    """Per asset: the first hour at or after ``as_of``, else its first hour."""
    f = VW.latest_offshore_forecast(t).dropna(subset=["forecast_valid_time"])
    past = F.when(F.col("forecast_valid_time") >= F.lit(as_of).cast("timestamp_ntz"), 0).otherwise(1)
    cols = ["asset_id", "asset_name", "forecast_valid_time", "temperature_c", "wind_speed_kmh",
            "wind_gust_kmh", "wave_height_m", "visibility_m", "overall_risk_level", "limiting_parameter"]
    return earliest_per_group(f.select(*cols), ["asset_id"], [past, F.col("forecast_valid_time")])


def wind_long(t: Tables) -> DataFrame:
    """Wind speed and gust of each latest forecast hour in long form (R04); NULLs kept."""
    f = VW.latest_offshore_forecast(t).select("asset_id", "forecast_valid_time", "wind_speed_kmh", "wind_gust_kmh")
    return f.unpivot(["asset_id", "forecast_valid_time"], ["wind_speed_kmh", "wind_gust_kmh"], "variable", "km_h")


def risk_timeline(t: Tables) -> DataFrame:
    """Overall level per latest forecast hour, cleaned, with its numeric score."""
    f = VW.latest_offshore_forecast(t)
    level = X.clean_level("overall_risk_level")
    return f.select("asset_id", "forecast_valid_time", level.alias("overall_risk_level"),
                    R.risk_score(level).alias("risk_score"))


def rig_kpis(t: Tables) -> DataFrame:
    """Sum of the latest counts and number of countries reporting."""
    latest = VR.latest_rig_count(t)
    return latest.agg(
        F.sum("rig_count").alias("latest_rig_count"),
        F.count_distinct("country_name").alias("countries_reporting"),
    )


def region_snapshot(t: Tables) -> DataFrame:
    """Region-month rows at the latest month, largest first."""
    rows = rows_at_global_max(VR.rig_count_region_monthly(t), "date")
    return rows.orderBy(F.col("rig_count").desc(), "region", "drilling_target", "location_type", "rig_status")


def region_totals(t: Tables) -> DataFrame:
    """Rig totals per month and region, over every classification.

    The region-monthly view keeps the (target, location, status) grain; the
    regional chart needs one total per region and month, summed here, with
    the number of distinct countries reporting in that region and month.
    """
    star = VR._rig_star(t)
    return star.groupBy("date", "region").agg(
        F.sum("rig_count").alias("rig_count"),
        F.count_distinct("country_key").alias("country_count"),
    )


def price_kpis(t: Tables) -> DataFrame:
    """Latest daily average (with unit), and mean / min / max of the daily
    averages, as the cards show them (3 decimals) (T06, A15, X22).

    "Latest" is the last row of the date-sorted frame; rows of one date are
    ordered by product code and source to make that pick deterministic.
    """
    daily = VP.daily_oil_price(t)
    last = F.struct("date", "product_code", "unit", "source")
    kpis = daily.agg(
        F.max_by("average_price_usd", last).alias("latest"),
        F.max_by("unit", last).alias("latest_unit"),
        F.max("date").alias("latest_date"),
        F.avg("average_price_usd").alias("mean"),
        F.min("average_price_usd").alias("minimum"),
        F.max("average_price_usd").alias("maximum"),
    )
    return kpis.select(
        "latest_date",
        F.concat_ws(" ", X.format_number_or_dash("latest", 3), F.col("latest_unit")).alias("latest_price"),
        X.format_number_or_dash("mean", 3).alias("average_price"),
        X.format_number_or_dash("minimum", 3).alias("minimum_price"),
        X.format_number_or_dash("maximum", 3).alias("maximum_price"),
        F.col("minimum").alias("minimum_daily_average"),
        F.col("maximum").alias("maximum_daily_average"),
    )


def date_labels(t: Tables) -> DataFrame:
    """Labels for the region-monthly dates: day, month and file-stamp forms."""
    dates = VR.rig_count_region_monthly(t).select("date").distinct()
    return dates.select(
        "date",
        F.date_format("date", "yyyy-MM-dd").alias("day_label"),
        F.date_format("date", "yyyy-MM").alias("month_label"),
        F.date_format(F.col("date").cast("timestamp_ntz"), "yyyyMMdd_HHmmss").alias("stamp_label"),
    )


def _q(fn):
    return lambda spark, sf_dir: fn(spark, build.warehouse(spark, sf_dir))


QUERIES = {
    "serve_assets": _q(lambda s, t: serve_assets(t)),
    "asset_map": _q(lambda s, t: asset_map(t, AS_OF)),
    "asset_map_center": _q(lambda s, t: asset_map_center(t, AS_OF)),
    "serve_risk_distribution": _q(lambda s, t: risk_distribution_long(t, RUN_TIME)),
    "serve_param_query": _q(lambda s, t: asset_forecast(s, t, EXAMPLE_ASSET_NAME)),
    "serve_current_conditions": _q(lambda s, t: current_conditions(t, AS_OF)),
    "serve_wind_long": _q(lambda s, t: wind_long(t)),
    "serve_risk_timeline": _q(lambda s, t: risk_timeline(t)),
    "serve_rig_kpis": _q(lambda s, t: rig_kpis(t)),
    "serve_region_snapshot": _q(lambda s, t: region_snapshot(t)),
    "serve_region_totals": _q(lambda s, t: region_totals(t)),
    "serve_price_kpis": _q(lambda s, t: price_kpis(t)),
    "serve_date_labels": _q(lambda s, t: date_labels(t)),
}
