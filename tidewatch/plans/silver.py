"""Silver jobs: landed rows -> typed, cleaned, deduplicated tables.

Each job takes the landed rows (from ``tidewatch.sources.bronze`` for real
files or ``tidewatch.sources.testtables`` for the test tables) and returns
the Silver DataFrame.  ``record_order`` carries input order for keep-last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import scalars as X
from tidewatch.operators.contracts import require_columns
from tidewatch.operators.dedupe import keep_last, present

# The source label each job writes. It is part of the facts'
# grain, so a re-delivery must carry the same label as the stored rows.
ATMOSPHERIC_SOURCE = "Open-Meteo"
MARINE_SOURCE = "Open-Meteo Marine"
PRICE_SOURCE = "EIA"
RIG_SOURCE = "Baker Hughes"

ATMOSPHERIC_FIELDS = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "relative_humidity_pct",
    "precipitation": "precipitation_mm",
    "pressure_msl": "pressure_hpa",
    "wind_speed_10m": "wind_speed_kmh",
    "wind_direction_10m": "wind_direction_deg",
    "wind_gusts_10m": "wind_gust_kmh",
    "visibility": "visibility_m",
    "weather_code": "weather_code",
}
MARINE_FIELDS = {
    "wave_height": "wave_height_m",
    "wave_direction": "wave_direction_deg",
    "wave_period": "wave_period_s",
    "wind_wave_height": "wind_wave_height_m",
    "swell_wave_height": "swell_wave_height_m",
    "swell_wave_direction": "swell_wave_direction_deg",
    "swell_wave_period": "swell_wave_period_s",
    "sea_surface_temperature": "sea_surface_temperature_c",
    "ocean_current_velocity": "ocean_current_velocity_kmh",
    "ocean_current_direction": "ocean_current_direction_deg",
}
# Marine measures that cannot be negative: a negative reading becomes NULL.
MARINE_NON_NEGATIVE = [
    "wave_height_m", "wave_period_s", "wind_wave_height_m",
    "swell_wave_height_m", "swell_wave_period_s", "ocean_current_velocity_kmh",
]
FORECAST_HOUR = ["asset_id", "forecast_reference_time", "forecast_valid_time"]
PRICE_REQUIRED = ["period", "product", "product-name", "value", "series"]
PRICE_OPTIONAL = {
    "duoarea": "area_code",
    "area-name": "area_name",
    "process": "process_code",
    "process-name": "process_name",
    "series-description": "series_description",
}
RIG_REQUIRED = ["Region", "Country", "DrillFor", "Location", "Rig Status", "Year", "Month", "Rig Count Value"]
RIG_GRAIN = ["observation_date", "country", "drilling_target", "location_type", "rig_status"]


def _as_timestamp(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dtype, T.TimestampType):
        return F.col(name).cast("timestamp_ntz")
    return X.to_utc_timestamp_ntz(name)


def _as_number(df: DataFrame, name: str) -> Column:
    numeric = isinstance(df.schema[name].dataType, T.NumericType)
    return X.to_number(F.col(f"`{name}`"), numeric_input=numeric)


def _forecast(df: DataFrame, fields: dict[str, str], source: str, marine: bool) -> DataFrame:
    require_columns(df, ["asset_id", "forecast_reference_time", "forecast_valid_time", *fields], "hourly forecast rows")
    ref = _as_timestamp(df, "forecast_reference_time")
    valid = _as_timestamp(df, "forecast_valid_time")
    measures = []
    for raw, name in fields.items():
        value = _as_number(df, raw)
        if name == "weather_code":
            value = value.cast("int")
        elif marine and name in MARINE_NON_NEGATIVE:
            value = F.when(value >= 0, value)  # negative -> NULL, row kept
        measures.append(value.alias(name))
    out = df.select(
        ref.alias("forecast_reference_time"),
        valid.alias("forecast_valid_time"),
        X.horizon_hours(valid, ref).alias("forecast_horizon_hours"),
        X.trim_all(F.col("asset_id").cast("string")).alias("asset_id"),
        X.trim_all(F.col("location_id").cast("string")).alias("location_id"),
        _as_number(df, "latitude").alias("latitude"),
        _as_number(df, "longitude").alias("longitude"),
        *measures,
        F.col("source_file").cast("string").alias("source_file"),
        F.col("record_order"),
    )
    # the horizon is there when both times are and never negative (X10): a
    # condition on it would only read both texts again
    out = present(out, ["forecast_reference_time", "forecast_valid_time", "asset_id"])
    # one source a job: its label is no key of the keep-last, so that Spark sees
    # where a use (distinct hours) needs no row per whole key
    last = keep_last(out, FORECAST_HOUR, ["record_order"])
    return last.select(*out.columns[:-2], F.lit(source).alias("source"), "source_file")


def silver_atmospheric(hourly: DataFrame, source: str = ATMOSPHERIC_SOURCE) -> DataFrame:
    """Hourly atmospheric rows -> Silver atmospheric (coerce, horizon, keep-last)."""
    return _forecast(hourly, ATMOSPHERIC_FIELDS, source, marine=False)


def silver_marine(hourly: DataFrame, source: str = MARINE_SOURCE) -> DataFrame:
    """Hourly marine rows -> Silver marine (same, plus negative scrub F04)."""
    return _forecast(hourly, MARINE_FIELDS, source, marine=True)


def silver_price_with_metrics(records: DataFrame, source: str = PRICE_SOURCE):
    """``silver_price`` plus observations of the rows in and out (F09): after
    the output is written, ``rows_removed(before, after)`` is the number of
    invalid or duplicate records dropped, with no second scan."""
    from tidewatch.operators.metrics import observe_rows

    src, before = observe_rows(records, "price_in")
    out, after = observe_rows(silver_price(src, source), "price_out")
    return out, before, after


def silver_price(records: DataFrame, source: str = PRICE_SOURCE) -> DataFrame:
    """Price records -> Silver price.

    ``units`` defaults to UNKNOWN only when the column is absent; a NULL
    inside an existing column drops the row.  Optional columns are carried
    only if present.  Keep-last by (timestamp, series) in record order, made
    first by the texts as landed: records that spell period and series alike
    have one key, so times and texts are read once for all of them.  What
    differs between such records (a missing text, a bad price) is decided
    before it.
    """
    require_columns(records, PRICE_REQUIRED, "price records")
    records = records.dropna(subset=[c for c in [*PRICE_REQUIRED, "units"] if c in records.columns])
    records = records.where(_as_number(records, "value") >= 0)
    used = {*PRICE_REQUIRED, "units", *PRICE_OPTIONAL, "record_order"}
    records = records.select(*[F.col(f"`{c}`") for c in records.columns if c in used])
    records = keep_last(records, ["period", "series"], ["record_order"], whole=True)
    units = X.trim_all(F.col("units").cast("string")) if "units" in records.columns else F.lit("UNKNOWN")
    optional = [
        X.trim_all(F.col(f"`{src}`").cast("string")).alias(dst)
        for src, dst in PRICE_OPTIONAL.items()
        if src in records.columns
    ]
    out = records.select(
        _as_timestamp(records, "period").alias("timestamp"),
        X.trim_all(F.col("product").cast("string")).alias("product_code"),
        X.trim_all(F.col("`product-name`").cast("string")).alias("product"),
        _as_number(records, "value").alias("price_usd"),
        units.alias("unit"),
        F.lit(source).alias("source"),
        X.trim_all(F.col("series").cast("string")).alias("series"),
        *optional,
        F.col("record_order"),
    )
    out = out.dropna(subset=["timestamp", "product_code", "product", "price_usd", "unit", "source", "series"])
    out = out.where(F.col("price_usd") >= 0)
    return keep_last(out, ["timestamp", "series"], ["record_order"], whole=True)


def silver_rig(rows: DataFrame, run_time: str, source: str = RIG_SOURCE) -> DataFrame:
    """Rig sheet text rows -> Silver rig counts.

    Trim, coerce, drop incomplete rows, month 1-12, year 1900-2100, count
    >= 0, first of the month, title / upper case, keep-last by
    (date, country, target, location, status) in record order.  Rows of
    a sheet's preamble and its header line fail the Year coercion and
    vanish here.
    """
    require_columns(rows, RIG_REQUIRED, "rig sheet")
    text = {c: X.trim_all(F.col(f"`{c}`").cast("string")) for c in ["Region", "Country", "DrillFor", "Location", "Rig Status"]}
    year = X.to_number(F.col("Year"))
    month = X.to_number(F.col("Month"))
    count = X.to_number(F.col("`Rig Count Value`"))
    df = rows.select(
        text["Region"].alias("region"),
        text["Country"].alias("country"),
        text["DrillFor"].alias("drilling_target"),
        text["Location"].alias("location_type"),
        text["Rig Status"].alias("rig_status"),
        year.alias("year"),
        month.alias("month"),
        count.alias("rig_count"),
        F.col("source_file").cast("string").alias("source_file"),
        F.col("record_order"),
    )
    df = df.dropna(subset=["region", "country", "drilling_target", "location_type", "rig_status", "year", "month", "rig_count"])
    df = df.where(F.col("month").between(1, 12) & F.col("year").between(1900, 2100) & (F.col("rig_count") >= 0))
    df = df.select(
        F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)).cast("timestamp_ntz").alias("observation_date"),
        X.title_case("region").alias("region"),
        F.upper("country").alias("country"),
        X.title_case("drilling_target").alias("drilling_target"),
        X.title_case("location_type").alias("location_type"),
        X.title_case("rig_status").alias("rig_status"),
        F.col("rig_count"),
        F.lit(source).alias("source"),
        F.col("source_file"),
        F.lit(run_time).cast("timestamp_ntz").alias("ingestion_time"),
        F.col("record_order"),
    ).dropna(subset=["observation_date"])
    return keep_last(df, RIG_GRAIN, ["record_order"], whole=True)


def simple_weather_clean(hours: DataFrame, location_id: str, run_time: str) -> DataFrame:
    """Older single-location path: coerce, drop rows without time, fill 0."""
    require_columns(hours, ["time", "temperature_2m", "relative_humidity_2m", "wind_speed_10m"], "single-location hours")
    out = hours.select(
        _as_number(hours, "latitude").alias("latitude"),
        _as_number(hours, "longitude").alias("longitude"),
        F.col("timezone").cast("string").alias("timezone"),
        _as_timestamp(hours, "time").alias("timestamp"),
        _as_number(hours, "temperature_2m").alias("temperature_c"),
        _as_number(hours, "relative_humidity_2m").alias("humidity"),
        _as_number(hours, "wind_speed_10m").alias("wind_kmh"),
    )
    out = out.dropna(subset=["timestamp"]).fillna(0.0, subset=["temperature_c", "humidity", "wind_kmh"])
    return out.select(
        "*",
        F.lit(run_time).cast("timestamp_ntz").alias("ingestion_time"),
        F.lit(location_id).alias("location_id"),
    )
