"""Star-schema builders: dimensions and facts from Silver frames.

Each ``load_*`` takes the current table (empty on a first load) and the
Silver input, and returns the next state of the table via the ``upsert``
family.  Surrogate keys are ``xxhash64`` of the natural key, so a fact
gets its foreign keys without a lookup join; the key *contract* (every
natural key must exist in its dimension, J07) is a separate small probe
(``validate=True``) over the distinct keys only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions import scalars as X
from tidewatch.operators.contracts import Watch, assert_keys_resolve, watch_keys
from tidewatch.operators.dedupe import keep_first, keep_last, present
from tidewatch.operators.upsert import align_schema, empty_like, insert_ignore, surrogate_key, upsert


def _ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return empty_like(spark, S.TABLES[name][0])


def last_distinct(
    df: DataFrame, key: Sequence[str], values: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Distinct (key, values) rows, then the last of them per key (A13 + K08).

    The reference makes the projection distinct (first occurrence kept,
    input order) and upserts row by row, so per key the distinct row whose
    *first* occurrence is latest wins.
    """
    cols = [*key, *values]
    firsts = keep_first(df.select(*cols, F.struct(*[F.col(c) if isinstance(c, str) else c for c in order]).alias("__o")), cols, ["__o"])
    return keep_last(firsts, list(key), ["__o"]).drop("__o")


# ---------------------------------------------------------------- dimensions


def time_rows(timestamps: DataFrame, run_time: str, monthly: bool = False) -> DataFrame:
    """dim_time rows for distinct timestamps."""
    ts = F.col("timestamp")
    hour = F.lit(0) if monthly else F.hour(ts)
    return present(timestamps.select(ts), ["timestamp"]).distinct().select(
        surrogate_key("timestamp").alias("time_key"),
        ts,
        F.to_date(ts).alias("date"),
        hour.cast("int").alias("hour"),
        F.month(ts).cast("int").alias("month"),
        X.season(F.month(ts)).alias("season"),
        _ts(run_time).alias("created_at"),
    )


def load_dim_time(target: DataFrame, timestamps: DataFrame, run_time: str, monthly: bool = False) -> DataFrame:
    """Insert-ignore new timestamps."""
    return insert_ignore(target, time_rows(timestamps, run_time, monthly), ["timestamp"])


def load_dim_location(target: DataFrame, registry: DataFrame, run_time: str) -> DataFrame:
    """Locations of the asset registry; upsert never touches updated_at."""
    rows = last_distinct(
        registry.where(F.col("location_id").isNotNull()),
        ["location_id"],
        ["location_name", "country", "latitude", "longitude"],
        ["registry_row"],
    )
    rows = rows.select(
        surrogate_key("location_id").alias("location_key"),
        "*",
        _ts(run_time).alias("created_at"),
        _ts(run_time).alias("updated_at"),
    )
    return upsert(target, align_schema(rows, S.DIM_LOCATION), ["location_id"], S.UPDATE_COLUMNS["dim_location"])


def load_dim_asset(target: DataFrame, registry: DataFrame, locations: DataFrame, run_time: str) -> DataFrame:
    """Assets with their location key; unknown location -> asset skipped."""
    reg = keep_last(registry, ["asset_id"], ["registry_row"])
    found = reg.join(locations.select("location_id", "location_key"), on="location_id", how="inner")
    rows = found.select(
        surrogate_key("asset_id").alias("asset_key"),
        "asset_id", "asset_name", "asset_type", "operator_name", "location_key",
        F.lit(True).alias("is_active"),
        "max_wind_kmh", "max_gust_kmh", "max_wave_height_m", "minimum_visibility_m",
        _ts(run_time).alias("created_at"),
        _ts(run_time).alias("updated_at"),
    )
    return upsert(target, align_schema(rows, S.DIM_ASSET), ["asset_id"], S.UPDATE_COLUMNS["dim_asset"])


def product_dim_input(price: DataFrame) -> DataFrame:
    """Silver price, dimension flavour (S09): trimmed, product required."""
    return price.where(
        F.col("product").isNotNull() & F.col("product_code").isNotNull() & (F.col("price_usd") >= 0)
    )


def load_dim_energy_product(target: DataFrame, price: DataFrame, run_time: str) -> DataFrame:
    """Products of the price feed; the last distinct (code, name, unit) wins."""
    src = product_dim_input(price).select(
        F.upper(X.trim_all("product_code")).alias("product_code"),
        X.trim_all("product").alias("product_name"),
        X.trim_all("unit").alias("default_unit"),
        F.col("product_code").alias("raw_code"),
        "timestamp", "series",
    )
    rows = last_distinct(src, ["product_code"], ["raw_code", "product_name", "default_unit"], ["timestamp", "series"])
    rows = rows.select(
        surrogate_key("product_code").alias("product_key"),
        "product_code", "product_name",
        X.commodity_type("product_name").alias("commodity_type"),
        "default_unit",
        _ts(run_time).alias("created_at"),
        _ts(run_time).alias("updated_at"),
    )
    return upsert(target, rows, ["product_code"], S.UPDATE_COLUMNS["dim_energy_product"])


RIG_SILVER_ORDER = ["observation_date", "region", "country", "drilling_target", "location_type"]


def load_dim_country(target: DataFrame, rig: DataFrame, run_time: str) -> DataFrame:
    src = rig.select(
        F.upper(X.trim_all("country")).alias("country_name"),
        X.title_case(X.trim_all("region")).alias("region"),
        F.col("country").alias("raw_country"),
        F.col("region").alias("raw_region"),
        *[F.col(c).alias(f"o_{c}") for c in RIG_SILVER_ORDER],
    )
    rows = last_distinct(src, ["country_name"], ["raw_country", "raw_region", "region"], [f"o_{c}" for c in RIG_SILVER_ORDER])
    rows = rows.select(
        surrogate_key("country_name").alias("country_key"),
        "country_name", "region",
        _ts(run_time).alias("created_at"),
        _ts(run_time).alias("updated_at"),
    )
    return upsert(target, rows, ["country_name"], S.UPDATE_COLUMNS["dim_country"])


CLASS_COLUMNS = ["drilling_target", "location_type", "rig_status"]


def load_dim_rig_classification(target: DataFrame, rig: DataFrame, run_time: str) -> DataFrame:
    """Classifications; an existing one only gets its updated_at touched."""
    rows = rig.select(*[X.title_case(X.trim_all(c)).alias(c) for c in CLASS_COLUMNS]).distinct().select(
        surrogate_key(*CLASS_COLUMNS).alias("rig_classification_key"),
        *CLASS_COLUMNS,
        _ts(run_time).alias("created_at"),
        _ts(run_time).alias("updated_at"),
    )
    return upsert(target, rows, CLASS_COLUMNS, S.UPDATE_COLUMNS["dim_rig_classification"])


# --------------------------------------------------------------------- facts


def _measure_cols(measures) -> list[Column]:
    return [F.col(n).cast(t).alias(n) for n, t in measures]


def _resolved(df: DataFrame, dim: DataFrame | None, on, what: str, watches: list[Watch] | None, dim_on=None) -> DataFrame:
    """``df`` with its keys checked against ``dim`` (J07): by a probe now, or, with
    ``watches``, counted while the load runs."""
    if dim is None:
        return df
    if watches is None:
        return assert_keys_resolve(df, dim, on, what, dim_on)
    df, watch = watch_keys(df, dim, on, what, dim_on)
    watches.append(watch)
    return df


def forecast_fact_rows(silver: DataFrame, measures, key_name: str, run_time: str) -> DataFrame:
    """Silver forecast rows -> fact rows with surrogate keys."""
    rows = present(silver, ["asset_id", "forecast_reference_time", "forecast_valid_time"]).select(
        surrogate_key("asset_id", "forecast_reference_time", "forecast_valid_time", "source").alias(key_name),
        surrogate_key("forecast_valid_time").alias("time_key"),
        surrogate_key("asset_id").alias("asset_key"),
        "forecast_reference_time", "forecast_valid_time",
        *([F.col("forecast_horizon_hours").cast("int")] if "forecast_horizon_hours" in silver.columns else []),
        *_measure_cols(measures),
        "source",
        _ts(run_time).alias("ingestion_time"),
    )
    return rows


def load_forecast_fact(
    target: DataFrame,
    silver: DataFrame,
    table: str,
    run_time: str,
    assets: DataFrame | None = None,
    times: DataFrame | None = None,
    watches: list[Watch] | None = None,
) -> DataFrame:
    """Upsert weather / marine / risk fact rows by (asset, run, hour, source).

    With ``assets`` / ``times`` given, every asset id and hour must exist in
    the dimension or the load fails naming up to five of them (J07); with
    ``watches`` the contract is counted by the load itself.
    """
    schema = S.TABLES[table][0]
    measures = {
        "fact_weather_forecast": S.WEATHER_MEASURES,
        "fact_marine_forecast": S.MARINE_MEASURES,
        "fact_operational_weather_risk": S.RISK_COLUMNS,
    }[table]
    key_name = schema.fields[0].name
    silver = _resolved(silver, assets, "asset_id", "asset_key", watches)
    silver = _resolved(silver, times, "forecast_valid_time", "time_key", watches, ["timestamp"])
    rows = align_schema(forecast_fact_rows(silver, measures, key_name, run_time), schema)
    return upsert(target, rows, S.FORECAST_GRAIN, S.UPDATE_COLUMNS[table])


def price_fact_input(price: DataFrame, deduplicated: bool = False) -> DataFrame:
    """Silver price, fact flavour (S10): code upper-cased, product not required.

    Keep-last by (timestamp, code, source, series).  ``deduplicated`` says
    the input comes straight from ``silver_price``, which is unique on
    (timestamp, series) already, so the step cannot remove a row.
    """
    src = price.select(
        "timestamp",
        F.upper(X.trim_all("product_code")).alias("product_code"),
        "price_usd",
        X.trim_all("unit").alias("unit"),
        X.trim_all("source").alias("source"),
        X.trim_all("series").alias("series"),
    ).dropna(subset=["timestamp", "product_code", "price_usd", "unit", "source", "series"])
    src = src.where(F.col("price_usd") >= 0)
    if deduplicated:
        return src
    return keep_last(src, ["timestamp", "product_code", "source", "series"], ["timestamp", "series"])


def load_fact_oil_price(
    target: DataFrame, price: DataFrame, run_time: str,
    products: DataFrame | None = None, times: DataFrame | None = None, deduplicated: bool = False,
    watches: list[Watch] | None = None,
) -> DataFrame:
    src = price_fact_input(price, deduplicated)
    src = _resolved(src, products, "product_code", "product_key", watches)
    src = _resolved(src, times, "timestamp", "time_key", watches)
    rows = src.select(
        surrogate_key("timestamp", "product_code", "source", "series").alias("oil_price_key"),
        surrogate_key("timestamp").alias("time_key"),
        surrogate_key("product_code").alias("product_key"),
        F.col("price_usd").cast("decimal(12,4)").alias("price_usd"),
        "unit", "source", "series",
        F.col("timestamp").alias("source_timestamp"),
        _ts(run_time).alias("ingestion_time"),
    )
    return upsert(target, rows, S.TABLES["fact_oil_price"][1], S.UPDATE_COLUMNS["fact_oil_price"])


def rig_fact_input(rig: DataFrame, deduplicated: bool = False) -> DataFrame:
    """Silver rig, fact flavour (S12): count >= 0, keep-last by 5 columns + source.

    ``deduplicated``: the input comes straight from ``silver_rig`` (unique on
    the five columns, one source), so the keep-last cannot remove a row.
    """
    src = rig.select(
        "observation_date",
        F.upper(X.trim_all("country")).alias("country_name"),
        *[X.title_case(X.trim_all(c)).alias(c) for c in CLASS_COLUMNS],
        "rig_count", "source", "source_file", "ingestion_time",
        *[F.col(c).alias(f"o_{c}") for c in RIG_SILVER_ORDER],
    ).dropna(subset=["observation_date", "country_name", *CLASS_COLUMNS, "rig_count"])
    src = src.where(F.col("rig_count") >= 0)
    if not deduplicated:
        src = keep_last(src, ["observation_date", "country_name", *CLASS_COLUMNS, "source"], [f"o_{c}" for c in RIG_SILVER_ORDER])
    return src.drop(*[f"o_{c}" for c in RIG_SILVER_ORDER])


def load_fact_rig_count(
    target: DataFrame, rig: DataFrame, run_time: str,
    countries: DataFrame | None = None, classes: DataFrame | None = None, times: DataFrame | None = None,
    deduplicated: bool = False, watches: list[Watch] | None = None,
) -> DataFrame:
    src = rig_fact_input(rig, deduplicated)
    src = _resolved(src, countries, "country_name", "country_key", watches)
    src = _resolved(src, classes, CLASS_COLUMNS, "rig_classification_key", watches)
    src = _resolved(src, times, "observation_date", "time_key", watches, ["timestamp"])
    rows = src.select(
        surrogate_key("observation_date", "country_name", *CLASS_COLUMNS, "source").alias("rig_count_key"),
        surrogate_key("observation_date").alias("time_key"),
        surrogate_key("country_name").alias("country_key"),
        surrogate_key(*CLASS_COLUMNS).alias("rig_classification_key"),
        F.col("rig_count").cast("decimal(12,4)").alias("rig_count"),
        "source", "source_file",
        F.col("ingestion_time").alias("source_ingestion_time"),
        _ts(run_time).alias("warehouse_loaded_at"),
    )
    return upsert(target, rows, S.TABLES["fact_rig_count"][1], S.UPDATE_COLUMNS["fact_rig_count"])


def merge_latest_runs(current: DataFrame, silver: DataFrame) -> DataFrame:
    """Each asset's latest forecast run after a batch: the stored maximum and the
    batch's (J11). Loads never remove a run, so a maximum stays one."""
    batch = present(silver, ["asset_id", "forecast_reference_time", "forecast_valid_time"]).select(
        surrogate_key("asset_id").alias("asset_key"), "forecast_reference_time")
    return current.select(*batch.columns).unionByName(batch).groupBy("asset_key").agg(
        F.max("forecast_reference_time").alias("forecast_reference_time"))


def simple_weather_fact(clean: DataFrame, locations: DataFrame, times: DataFrame) -> DataFrame:
    """Older path: keys looked up with a left join, misses stay NULL."""
    return (
        clean.join(locations.select("location_id", "location_key"), on="location_id", how="left")
        .join(times.select("timestamp", "time_key"), on="timestamp", how="left")
        .select("location_key", "time_key", "temperature_c", "humidity", "wind_kmh", "ingestion_time")
    )
