"""Executive snapshot (J12, J13, A08-A11): one row joining the latest rig
date, the latest price date and the global latest weather run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import percent_of
from tidewatch.plans.views_price import latest_price_summary
from tidewatch.plans.views_rig import latest_rig_summary
from tidewatch.plans.views_weather import weather_run_summary

Tables = Mapping[str, DataFrame]


def executive_energy_operations(t: Tables, snapshot_time: str) -> DataFrame:
    """Cross join of three one-row summaries; no row if any source is empty.

    Each side is an aggregate at a single latest date / run, so it has at
    most one row and the cross join is bounded by construction.
    ``snapshot_time`` replaces the wall clock.
    """
    rig = latest_rig_summary(t)
    price = latest_price_summary(t)
    weather = weather_run_summary(t).withColumnRenamed(
        "forecast_reference_time", "weather_forecast_reference_time"
    )
    joined = rig.crossJoin(price).crossJoin(weather)
    return joined.select(
        F.lit(snapshot_time).cast("timestamp_ntz").alias("snapshot_generated_at"),
        "rig_count_date", "total_rig_count", "countries_reporting",
        "energy_price_date", "average_energy_price_usd", "minimum_energy_price_usd",
        "maximum_energy_price_usd", "energy_price_observations",
        "weather_forecast_reference_time", "first_forecast_valid_time", "last_forecast_valid_time",
        "monitored_assets", "forecast_hours", "green_hours", "amber_hours", "red_hours", "unknown_hours",
        percent_of("green_hours", "forecast_hours").alias("green_hours_percent"),
        percent_of("amber_hours", "forecast_hours").alias("amber_hours_percent"),
        percent_of("red_hours", "forecast_hours").alias("red_hours_percent"),
    )
