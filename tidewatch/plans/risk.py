"""Operational weather risk per asset-hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import risk_rules as R
from tidewatch.operators.contracts import assert_unique
from tidewatch.operators.dedupe import keep_last

RISK_SOURCE = "Operational Risk Engine v1"  # fixed value, part of the grain
HOUR_KEYS = ["asset_id", "forecast_reference_time", "forecast_valid_time"]
LIMIT_COLUMNS = ["max_wind_kmh", "max_gust_kmh", "max_wave_height_m", "minimum_visibility_m"]


def operational_risk(
    atmospheric: DataFrame,
    marine: DataFrame,
    limits: DataFrame,
    source: str = RISK_SOURCE,
    validate: bool = False,
    unique_hours: bool = False,
) -> DataFrame:
    """Rate every atmospheric hour GREEN / AMBER / RED / UNKNOWN.

    Atmospheric hours left-join the marine wave height on (asset, run,
    hour) and the asset's limits on asset.  ``validate`` runs the join
    cardinality contracts first (marine one-to-one, limits many-to-one).
    The limits side is one row per asset; the planner broadcasts it when
    its measured size allows and shuffles otherwise.
    """
    wave = marine.select(*HOUR_KEYS, "wave_height_m")
    lim = limits.select("asset_id", *[F.col(c).cast("double").alias(c) for c in LIMIT_COLUMNS])
    if validate:
        assert_unique(atmospheric, HOUR_KEYS, "atmospheric hours")
        assert_unique(wave, HOUR_KEYS, "marine hours")
        assert_unique(lim, ["asset_id"], "asset limits")
    merged = atmospheric.select(*HOUR_KEYS, "wind_speed_kmh", "wind_gust_kmh", "visibility_m").join(
        wave, on=HOUR_KEYS, how="left"
    ).join(lim, on="asset_id", how="left")
    wind = R.classify_upper_limit("wind_speed_kmh", "max_wind_kmh")
    gust = R.classify_upper_limit("wind_gust_kmh", "max_gust_kmh")
    wave_level = R.classify_upper_limit("wave_height_m", "max_wave_height_m")
    vis = R.classify_minimum_limit("visibility_m", "minimum_visibility_m")
    levels = merged.select(
        "forecast_reference_time", "forecast_valid_time", "asset_id",
        wind.alias("wind_risk_level"), gust.alias("gust_risk_level"),
        wave_level.alias("wave_risk_level"), vis.alias("visibility_risk_level"),
    )
    lv = ["wind_risk_level", "gust_risk_level", "wave_risk_level", "visibility_risk_level"]
    rated = levels.select(
        "*",
        R.highest_risk(*lv).alias("overall_risk_level"),
        R.limiting_parameter(*lv).alias("limiting_parameter"),
    )
    out = rated.select(
        "forecast_reference_time", "forecast_valid_time", "asset_id", *lv, "overall_risk_level",
        R.recommendation("overall_risk_level", "limiting_parameter").alias("operation_recommendation"),
        "limiting_parameter",
        F.lit(source).alias("source"),
    )
    # One row per asset-hour.  ``unique_hours`` says the atmospheric input
    # is one Silver job's output (unique per asset, run, hour and a single
    # source label), where this keep-last cannot remove a row.
    if unique_hours:
        return out
    return keep_last(out, HOUR_KEYS, ["source"])


def risk_distribution(risk: DataFrame) -> DataFrame:
    """Hours per overall level, NULL level kept as its own group."""
    return risk.groupBy("overall_risk_level").agg(F.count(F.lit(1)).alias("hours"))
