"""Energy price views (§2.11): history, daily, daily summary, latest by
product, latest by series, product summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.dedupe import latest_per_group
from tidewatch.plans.views_weather import avg_exact

Tables = Mapping[str, DataFrame]


def round_avg(c: str, decimals: int) -> Column:
    """ROUND(AVG(numeric), d) exactly: the decimal sum is divided at a wide
    scale (12 digits here), so rounding the ratio is not a double rounding."""
    total = F.sum(c).cast("decimal(30,4)")
    n = F.count(c).cast("decimal(20,0)")
    return F.round(total / n, decimals)


def newest_slice(fact: DataFrame, part: str) -> DataFrame:
    """Rows of a stored fact's newest partition: its value is a scalar subquery on the
    partition column, so the scan lists that partition alone. Other frames stay whole."""
    if part not in fact.columns:
        return fact
    return fact.where(F.col(part) == fact.agg(F.max(part)).scalar())


def _price_star(t: Tables, newest: bool = False) -> DataFrame:
    """Price fact, or its newest slice, joined to time and product."""
    f = newest_slice(t["fact_oil_price"], "price_month") if newest else t["fact_oil_price"]
    time = t["dim_time"].select("time_key", "timestamp", "date", "hour", "month", "season")
    prod = t["dim_energy_product"].select(
        "product_key", "product_code", "product_name", "commodity_type", "default_unit"
    )
    return f.join(time, on="time_key", how="inner").join(prod, on="product_key", how="inner")


def oil_price_history(t: Tables) -> DataFrame:
    return _price_star(t).select(
        "oil_price_key", "time_key", "timestamp", "date", "hour", "month", "season", "product_key",
        "product_code", "product_name", "commodity_type", "default_unit", "price_usd", "unit", "source",
        "series", "source_timestamp", "ingestion_time",
    )


def daily_oil_price(t: Tables) -> DataFrame:
    """AVG / MIN / MAX / COUNT per day, product, unit and source."""
    return _price_star(t).groupBy(
        "date", "product_key", "product_code", F.col("product_name").alias("product"), "commodity_type",
        "unit", "source",
    ).agg(
        avg_exact("price_usd").alias("average_price_usd"),
        F.min("price_usd").alias("minimum_price_usd"),
        F.max("price_usd").alias("maximum_price_usd"),
        F.count(F.lit(1)).alias("observations"),
    )


def daily_oil_price_summary(t: Tables) -> DataFrame:
    """Daily summary per series, with first / last observation time."""
    return _price_star(t).groupBy(
        "date", "product_code", "product_name", "commodity_type", "unit", "source", "series"
    ).agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.min("price_usd").alias("minimum_price"),
        F.max("price_usd").alias("maximum_price"),
        avg_exact("price_usd").alias("average_price"),
        F.min("source_timestamp").alias("first_observation"),
        F.max("source_timestamp").alias("last_observation"),
    )


def latest_oil_price_by_product(t: Tables) -> DataFrame:
    """Latest row per product.

    The reference orders by date only, leaving ties arbitrary; here ties
    are broken by timestamp, series, price, unit, source (H7).
    """
    rows = _price_star(t).select(
        "date", "product_key", "product_code", F.col("product_name").alias("product"), "commodity_type",
        "price_usd", "unit", "source", "timestamp", "series",
    )
    latest = latest_per_group(rows, ["product_key"], ["date", "timestamp", "series", "price_usd", "unit", "source"])
    return latest.select(
        "date", "product_key", "product_code", "product", "commodity_type", "price_usd", "unit", "source"
    )


def latest_oil_price_by_series(t: Tables) -> DataFrame:
    """Latest row per (product, series) by timestamp then load time."""
    rows = _price_star(t).select(
        "oil_price_key", "timestamp", "date", "product_key", "product_code", "product_name", "commodity_type",
        "price_usd", "unit", "source", "series", "source_timestamp", "ingestion_time",
    )
    return latest_per_group(
        rows, ["product_key", "series"], ["timestamp", "ingestion_time", "source", "oil_price_key"]
    ).select(*rows.columns)


def energy_price_summary(t: Tables) -> DataFrame:
    """Per product: first / last date, count, rounded average, extremes."""
    return _price_star(t).groupBy(
        "product_key", "product_code", F.col("product_name").alias("product"), "commodity_type"
    ).agg(
        F.min("date").alias("first_observation_date"),
        F.max("date").alias("latest_observation_date"),
        F.count(F.lit(1)).alias("total_observations"),
        round_avg("price_usd", 4).alias("average_price_usd"),
        F.min("price_usd").alias("minimum_price_usd"),
        F.max("price_usd").alias("maximum_price_usd"),
        F.max("unit").alias("unit"),
        F.max("source").alias("source"),
    )


def latest_price_summary(t: Tables) -> DataFrame:
    """Prices on the latest price date: AVG / MIN / MAX / COUNT.

    The newest month is read alone, and its days are aggregated once: the latest
    of the (at most 31) rows is the result.
    """
    return _price_star(t, newest=True).groupBy(
        F.col("date").alias("energy_price_date")
    ).agg(
        avg_exact("price_usd").alias("average_energy_price_usd"),
        F.min("price_usd").alias("minimum_energy_price_usd"),
        F.max("price_usd").alias("maximum_energy_price_usd"),
        F.count(F.lit(1)).alias("energy_price_observations"),
    ).orderBy(F.desc("energy_price_date")).limit(1)
