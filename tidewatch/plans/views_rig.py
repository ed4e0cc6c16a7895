"""Rig-count views (§2.11): history, country-month, region-month, latest,
month-on-month change."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.scalars import change_percent
from tidewatch.operators.dedupe import latest_per_group
from tidewatch.plans.views_price import newest_slice

Tables = Mapping[str, DataFrame]


def _rig_star(t: Tables, newest: bool = False) -> DataFrame:
    """Rig fact, or its newest slice, joined to time, country and classification."""
    f = newest_slice(t["fact_rig_count"], "rig_month") if newest else t["fact_rig_count"]
    time = t["dim_time"].select("time_key", "timestamp", "date", "month", "season")
    country = t["dim_country"].select("country_key", "country_name", "region")
    cls = t["dim_rig_classification"].select("rig_classification_key", "drilling_target", "location_type", "rig_status")
    return (
        f.join(time, on="time_key", how="inner")
        .join(country, on="country_key", how="inner")
        .join(cls, on="rig_classification_key", how="inner")
    )


def rig_count_history(t: Tables) -> DataFrame:
    return _rig_star(t).select(
        "rig_count_key", "time_key", "timestamp", "date", "month", "season", "country_key", "country_name",
        "region", "rig_classification_key", "drilling_target", "location_type", "rig_status", "rig_count",
        "source", "source_file", "source_ingestion_time", "warehouse_loaded_at",
    )


def rig_count_country_monthly(t: Tables) -> DataFrame:
    """SUM per month, country, classification, source."""
    return _rig_star(t).groupBy(
        "date", "region", "country_name", "drilling_target", "location_type", "rig_status", "source"
    ).agg(F.sum("rig_count").alias("rig_count")).select(
        "date", "region", "country_name", "drilling_target", "location_type", "rig_status", "rig_count", "source"
    )


def rig_count_region_monthly(t: Tables) -> DataFrame:
    """SUM and distinct countries per month, region, classification."""
    return _rig_star(t).groupBy("date", "region", "drilling_target", "location_type", "rig_status").agg(
        F.sum("rig_count").alias("rig_count"),
        F.count_distinct("country_key").alias("country_count"),
    )


def latest_rig_count(t: Tables) -> DataFrame:
    """Latest row per (country, classification, source) by time then load time."""
    rows = rig_count_history(t).select(
        "rig_count_key", "timestamp", "date", "country_key", "country_name", "region",
        "rig_classification_key", "drilling_target", "location_type", "rig_status", "rig_count", "source",
        "source_file", "source_ingestion_time", "warehouse_loaded_at",
    )
    return latest_per_group(
        rows, ["country_key", "rig_classification_key", "source"], ["timestamp", "warehouse_loaded_at", "rig_count_key"]
    ).select(*rows.columns)


def rig_count_monthly_change(t: Tables) -> DataFrame:
    """Monthly count per country and classification with the previous
    available month's count, the change and the percent change (W05, W06).

    The window is partitioned by (country, classification); each partition
    is one series of monthly totals, which is small (one row per month).
    """
    monthly = _rig_star(t).groupBy(
        "date", "country_key", "country_name", "region", "rig_classification_key", "drilling_target",
        "location_type", "rig_status",
    ).agg(F.sum("rig_count").alias("rig_count"))
    w = Window.partitionBy("country_key", "rig_classification_key").orderBy("date")
    prev = F.lag("rig_count").over(w)
    with_prev = monthly.withColumn("previous_month_rig_count", prev)
    return with_prev.select(
        "date", "country_key", "country_name", "region", "rig_classification_key", "drilling_target",
        "location_type", "rig_status", "rig_count", "previous_month_rig_count",
        (F.col("rig_count") - F.col("previous_month_rig_count")).alias("monthly_change"),
        change_percent("rig_count", "previous_month_rig_count").alias("monthly_change_percent"),
    )


def latest_rig_summary(t: Tables) -> DataFrame:
    """Total rigs and countries reporting on the latest rig date (A09); only the
    newest month is read."""
    return _rig_star(t, newest=True).groupBy(
        F.col("date").alias("rig_count_date")
    ).agg(
        F.sum("rig_count").alias("total_rig_count"),
        F.count_distinct("country_key").alias("countries_reporting"),
    ).orderBy(F.desc("rig_count_date")).limit(1)
