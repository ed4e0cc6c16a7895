"""Offshore weather views (§2.11): operational forecast, latest run, safe
windows, risk summary (flagship), critical periods, asset KPIs, next
critical event.  Each takes the warehouse tables as a dict of DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.dedupe import earliest_per_group
from tidewatch.schemas import MARINE_MEASURES

Tables = Mapping[str, DataFrame]
HOUR = ["asset_key", "forecast_reference_time", "forecast_valid_time"]
LEVEL_NAMES = ["GREEN", "AMBER", "RED", "UNKNOWN"]


def avg_exact(c: str | Column) -> Column:
    """AVG of a NUMERIC column as DOUBLE: exact decimal sum / count."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col).cast("double") / F.count(col)


def level_counts(level: str = "overall_risk_level") -> list[Column]:
    """COUNT(*) FILTER (WHERE level = ...) for the four levels."""
    return [F.count_if(F.col(level) == name).alias(f"{name.lower()}_hours") for name in LEVEL_NAMES]


def _operational(t: Tables, runs: DataFrame | None = None) -> DataFrame:
    """The operational forecast view, optionally limited to (asset_key, run) pairs.

    ``runs`` is a small frame (one row per asset); it is semi-joined into
    each fact *before* the hour joins, so only the selected runs are
    joined and shuffled.  Stored facts are partitioned by ``run_date``; the
    oldest of the latest runs prunes the fact scans to later partitions.
    """
    part = ["run_date"] if runs is not None and "run_date" in t["fact_weather_forecast"].columns else []
    w = t["fact_weather_forecast"].select(
        "asset_key", "forecast_reference_time", "forecast_valid_time", "forecast_horizon_hours",
        "temperature_c", "relative_humidity_pct", "pressure_hpa", "precipitation_mm",
        "wind_speed_kmh", "wind_direction_deg", "wind_gust_kmh", "visibility_m", "weather_code", *part,
    )
    m = t["fact_marine_forecast"].select(*HOUR, *[n for n, _ in MARINE_MEASURES], *part)
    r = t["fact_operational_weather_risk"].select(
        *HOUR, "wind_risk_level", "gust_risk_level", "wave_risk_level", "visibility_risk_level",
        "overall_risk_level", "operation_recommendation", "limiting_parameter", *part,
    )
    if runs is not None:
        keys = ["asset_key", "forecast_reference_time", *part]
        if part:
            runs = runs.withColumn("run_date", F.to_date("forecast_reference_time"))
            # a scalar subquery on the partition column: Spark evaluates it at
            # run time and lists only the partitions from the oldest latest run on
            oldest = runs.agg(F.min("run_date")).scalar()
            w, m, r = (f.where(F.col("run_date") >= oldest) for f in (w, m, r))
        w, m, r = (f.join(runs, on=keys, how="left_semi").drop(*part) for f in (w, m, r))
    a = t["dim_asset"].select("asset_key", "asset_id", "asset_name", "asset_type", "location_key")
    loc = t["dim_location"].select("location_key", "location_name", "country", "latitude", "longitude")
    # fact-to-fact hour joins first: the three facts are shuffled once on the
    # same keys and stay co-partitioned; the dimension joins come last
    joined = (
        w.join(m, on=HOUR, how="left")
        .join(r, on=HOUR, how="left")
        .join(a, on="asset_key", how="inner")
        .join(loc, on="location_key", how="inner")
    )
    return joined.select(
        "asset_id", "asset_name", "asset_type", "location_name", "country", "latitude", "longitude",
        "forecast_reference_time", "forecast_valid_time", "forecast_horizon_hours",
        "temperature_c", "relative_humidity_pct", "pressure_hpa", "precipitation_mm", "wind_speed_kmh",
        "wind_direction_deg", "wind_gust_kmh", "visibility_m", "weather_code",
        *[n for n, _ in MARINE_MEASURES],
        "wind_risk_level", "gust_risk_level", "wave_risk_level", "visibility_risk_level",
        "overall_risk_level", "operation_recommendation", "limiting_parameter",
    )


def offshore_operational_forecast(t: Tables) -> DataFrame:
    """Weather fact + asset + location, marine and risk left-joined by hour."""
    return _operational(t)


def latest_runs(t: Tables) -> DataFrame:
    """Each asset's latest forecast run (J11): one small row per asset.

    Restricted to assets that the view's inner joins keep, so it equals the
    maximum over the view rows. A stored warehouse keeps the runs in a table
    of its own, merged with each batch at load, so no fact history is read;
    otherwise they are computed on the weather fact (combined map-side).
    """
    a = t["dim_asset"].select("asset_key", "location_key")
    known = a.join(t["dim_location"].select("location_key"), on="location_key", how="left_semi").select("asset_key")
    if "agg_latest_run" in t:
        return t["agg_latest_run"].join(known, on="asset_key", how="left_semi").select("asset_key", "forecast_reference_time")
    return (
        t["fact_weather_forecast"]
        .join(known, on="asset_key", how="left_semi")
        .groupBy("asset_key")
        .agg(F.max("forecast_reference_time").alias("forecast_reference_time"))
    )


def latest_offshore_forecast(t: Tables) -> DataFrame:
    """Operational forecast rows of each asset's own latest run."""
    return _operational(t, latest_runs(t))


def offshore_safe_windows(t: Tables) -> DataFrame:
    return latest_offshore_forecast(t).where(F.col("overall_risk_level") == "GREEN").select(
        "asset_id", "asset_name", "asset_type", "location_name", "forecast_reference_time",
        "forecast_valid_time", "forecast_horizon_hours", "wind_speed_kmh", "wind_gust_kmh",
        "wave_height_m", "visibility_m", "overall_risk_level", "operation_recommendation",
    )


def offshore_risk_summary(t: Tables) -> DataFrame:
    """Per asset and day of its latest run: hours per level and extremes."""
    latest = latest_offshore_forecast(t)
    return latest.groupBy(
        "asset_id", "asset_name", "asset_type", F.to_date("forecast_valid_time").alias("forecast_date")
    ).agg(
        F.count(F.lit(1)).alias("forecast_hours"),
        *level_counts(),
        F.max("wind_speed_kmh").alias("maximum_wind_speed_kmh"),
        F.max("wind_gust_kmh").alias("maximum_wind_gust_kmh"),
        F.max("wave_height_m").alias("maximum_wave_height_m"),
        F.min("visibility_m").alias("minimum_visibility_m"),
    )


def offshore_critical_periods(t: Tables) -> DataFrame:
    return latest_offshore_forecast(t).where(F.col("overall_risk_level").isin("AMBER", "RED")).select(
        "asset_id", "asset_name", "asset_type", "location_name", "forecast_reference_time",
        "forecast_valid_time", "forecast_horizon_hours", "wind_speed_kmh", "wind_gust_kmh",
        "wave_height_m", "visibility_m", "overall_risk_level", "limiting_parameter",
        "operation_recommendation",
    )


def asset_operational_kpis(t: Tables) -> DataFrame:
    """Per asset, its latest run: window, hours per level, extremes, averages,
    first RED hour and first GREEN hour (A07)."""
    latest = latest_offshore_forecast(t)
    vt = F.col("forecast_valid_time")
    return latest.groupBy(
        "asset_id", "asset_name", "asset_type", "location_name", "country", "forecast_reference_time"
    ).agg(
        F.min(vt).alias("first_forecast_valid_time"),
        F.max(vt).alias("last_forecast_valid_time"),
        F.count(F.lit(1)).alias("forecast_hours"),
        *level_counts(),
        F.max("wind_speed_kmh").alias("maximum_wind_speed_kmh"),
        F.max("wind_gust_kmh").alias("maximum_wind_gust_kmh"),
        F.max("wave_height_m").alias("maximum_wave_height_m"),
        F.min("visibility_m").alias("minimum_visibility_m"),
        avg_exact("temperature_c").alias("average_temperature_c"),
        avg_exact("sea_surface_temperature_c").alias("average_sea_surface_temperature_c"),
        F.min(F.when(F.col("overall_risk_level") == "RED", vt)).alias("first_red_risk_time"),
        F.min(F.when(F.col("overall_risk_level") == "GREEN", vt)).alias("first_green_window_time"),
    )


NEXT_EVENT_COLUMNS = [
    "asset_id", "asset_name", "asset_type", "location_name", "forecast_reference_time",
    "forecast_valid_time", "forecast_horizon_hours", "wind_speed_kmh", "wind_gust_kmh",
    "wave_height_m", "visibility_m", "overall_risk_level", "limiting_parameter",
    "operation_recommendation",
]


def next_weather_critical_event(t: Tables, as_of: str) -> DataFrame:
    """First AMBER / RED hour at or after ``as_of`` per asset.

    ``as_of`` replaces the wall clock so results are reproducible.  The
    reference ranks by valid time only; ties on it (several sources) are
    broken by the remaining columns here so the pick is deterministic.
    """
    future = latest_offshore_forecast(t).where(
        F.col("overall_risk_level").isin("AMBER", "RED")
        & (F.col("forecast_valid_time") >= F.lit(as_of).cast("timestamp_ntz"))
    ).select(*NEXT_EVENT_COLUMNS)
    return earliest_per_group(future, ["asset_id"], ["forecast_valid_time", "forecast_reference_time"])


def latest_global_run(t: Tables) -> DataFrame:
    """Risk fact rows of the global latest run."""
    r = t["fact_operational_weather_risk"]
    if "run_date" in r.columns:  # stored fact: pruned to the newest partition at run time
        r = r.where(F.col("run_date") == r.agg(F.max("run_date")).scalar())
    # the latest run is a scalar subquery too: the condition reaches the rows that
    # the risk is rated from, so other runs are neither shuffled nor rated
    at = "forecast_reference_time"
    return r.where(F.col(at) == r.agg(F.max(at)).scalar()).select(at, *[c for c in r.columns if c != at])


def weather_run_summary(t: Tables) -> DataFrame:
    """Global latest run: hour range, assets, hours per level (A10)."""
    run = latest_global_run(t)
    return run.groupBy("forecast_reference_time").agg(
        F.min("forecast_valid_time").alias("first_forecast_valid_time"),
        F.max("forecast_valid_time").alias("last_forecast_valid_time"),
        F.count_distinct("asset_key").alias("monitored_assets"),
        F.count(F.lit(1)).alias("forecast_hours"),
        *level_counts(),
    )
