"""Warehouse table schemas, natural keys and update columns (§1.4, K04)."""

from __future__ import annotations

from pyspark.sql import types as T

TS = T.TimestampNTZType()
STR = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
BOOL = T.BooleanType()
DATE = T.DateType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DIM_LOCATION = _schema(
    ("location_key", LONG), ("location_id", STR), ("location_name", STR), ("country", STR),
    ("latitude", dec(9, 6)), ("longitude", dec(9, 6)), ("created_at", TS), ("updated_at", TS),
)
DIM_TIME = _schema(
    ("time_key", LONG), ("timestamp", TS), ("date", DATE), ("hour", INT), ("month", INT),
    ("season", STR), ("created_at", TS),
)
DIM_ASSET = _schema(
    ("asset_key", LONG), ("asset_id", STR), ("asset_name", STR), ("asset_type", STR),
    ("operator_name", STR), ("location_key", LONG), ("is_active", BOOL),
    ("max_wind_kmh", dec(8, 2)), ("max_gust_kmh", dec(8, 2)), ("max_wave_height_m", dec(8, 2)),
    ("minimum_visibility_m", dec(10, 2)), ("created_at", TS), ("updated_at", TS),
)
DIM_ENERGY_PRODUCT = _schema(
    ("product_key", LONG), ("product_code", STR), ("product_name", STR), ("commodity_type", STR),
    ("default_unit", STR), ("created_at", TS), ("updated_at", TS),
)
DIM_COUNTRY = _schema(
    ("country_key", LONG), ("country_name", STR), ("region", STR), ("created_at", TS), ("updated_at", TS),
)
DIM_RIG_CLASSIFICATION = _schema(
    ("rig_classification_key", LONG), ("drilling_target", STR), ("location_type", STR),
    ("rig_status", STR), ("created_at", TS), ("updated_at", TS),
)
WEATHER_MEASURES = [
    ("temperature_c", dec(8, 3)), ("relative_humidity_pct", dec(8, 3)), ("pressure_hpa", dec(10, 3)),
    ("precipitation_mm", dec(10, 3)), ("wind_speed_kmh", dec(10, 3)), ("wind_direction_deg", dec(8, 3)),
    ("wind_gust_kmh", dec(10, 3)), ("visibility_m", dec(12, 3)), ("weather_code", INT),
]
MARINE_MEASURES = [
    (name, dec(8, 3))
    for name in [
        "wave_height_m", "wave_direction_deg", "wave_period_s", "wind_wave_height_m",
        "swell_wave_height_m", "swell_wave_direction_deg", "swell_wave_period_s",
        "sea_surface_temperature_c", "ocean_current_velocity_kmh", "ocean_current_direction_deg",
    ]
]
RISK_COLUMNS = [
    ("wind_risk_level", STR), ("gust_risk_level", STR), ("wave_risk_level", STR),
    ("visibility_risk_level", STR), ("overall_risk_level", STR), ("operation_recommendation", STR),
    ("limiting_parameter", STR),
]
_FORECAST_HEAD = [
    ("time_key", LONG), ("asset_key", LONG), ("forecast_reference_time", TS), ("forecast_valid_time", TS),
]
FACT_WEATHER = _schema(
    ("weather_forecast_key", LONG), *_FORECAST_HEAD, ("forecast_horizon_hours", INT), *WEATHER_MEASURES,
    ("source", STR), ("ingestion_time", TS),
)
FACT_MARINE = _schema(
    ("marine_forecast_key", LONG), *_FORECAST_HEAD, ("forecast_horizon_hours", INT), *MARINE_MEASURES,
    ("source", STR), ("ingestion_time", TS),
)
FACT_RISK = _schema(
    ("operational_risk_key", LONG), *_FORECAST_HEAD, *RISK_COLUMNS, ("source", STR), ("ingestion_time", TS),
)
FACT_OIL_PRICE = _schema(
    ("oil_price_key", LONG), ("time_key", LONG), ("product_key", LONG), ("price_usd", dec(12, 4)),
    ("unit", STR), ("source", STR), ("series", STR), ("source_timestamp", TS), ("ingestion_time", TS),
)
FACT_RIG_COUNT = _schema(
    ("rig_count_key", LONG), ("time_key", LONG), ("country_key", LONG), ("rig_classification_key", LONG),
    ("rig_count", dec(12, 4)), ("source", STR), ("source_file", STR), ("source_ingestion_time", TS),
    ("warehouse_loaded_at", TS),
)
FACT_PIPELINE_RUN = _schema(
    ("pipeline_run_key", LONG), ("pipeline_name", STR), ("started_at", TS), ("finished_at", TS),
    ("duration_seconds", dec(12, 3)), ("status", STR), ("error_message", STR),
)
FACT_DATA_QUALITY_CHECK = _schema(
    ("quality_check_key", LONG), ("pipeline_run_key", LONG), ("check_name", STR), ("passed", BOOL),
    ("check_value", STR), ("expectation", STR), ("details", STR), ("checked_at", TS),
)

# Natural keys (the grain) of every table, and the columns an upsert updates.
FORECAST_GRAIN = ["asset_key", "forecast_reference_time", "forecast_valid_time", "source"]
TABLES = {
    "dim_location": (DIM_LOCATION, ["location_id"]),
    "dim_time": (DIM_TIME, ["timestamp"]),
    "dim_asset": (DIM_ASSET, ["asset_id"]),
    "dim_energy_product": (DIM_ENERGY_PRODUCT, ["product_code"]),
    "dim_country": (DIM_COUNTRY, ["country_name"]),
    "dim_rig_classification": (DIM_RIG_CLASSIFICATION, ["drilling_target", "location_type", "rig_status"]),
    "fact_weather_forecast": (FACT_WEATHER, FORECAST_GRAIN),
    "fact_marine_forecast": (FACT_MARINE, FORECAST_GRAIN),
    "fact_operational_weather_risk": (FACT_RISK, FORECAST_GRAIN),
    "fact_oil_price": (FACT_OIL_PRICE, ["time_key", "product_key", "source", "series"]),
    "fact_rig_count": (FACT_RIG_COUNT, ["time_key", "country_key", "rig_classification_key", "source"]),
    "fact_pipeline_run": (FACT_PIPELINE_RUN, ["pipeline_run_key"]),
    "fact_data_quality_check": (FACT_DATA_QUALITY_CHECK, ["quality_check_key"]),
}
# Tables that loads maintain beside the star schema, to spare views a scan of a whole fact.
DERIVED = {
    "agg_latest_run": (_schema(("asset_key", LONG), ("forecast_reference_time", TS)), ["asset_key"]),
    # counters of every stored partition of a fact; the checks add them up
    "agg_fact_partition": (_schema(
        ("table_name", STR), ("part", STR), ("n", LONG), ("duplicates", LONG), ("latest_run", TS), ("latest_n", LONG),
        ("humidity", LONG), ("visibility", LONG), ("wave", LONG), ("levels", LONG)), ["table_name", "part"]),
}
REQUIRED_TABLES = [
    "dim_location", "dim_time", "dim_asset", "dim_energy_product", "dim_country",
    "dim_rig_classification", "fact_weather_forecast", "fact_marine_forecast",
    "fact_operational_weather_risk", "fact_oil_price", "fact_rig_count",
]
REQUIRED_VIEWS = [
    "vw_offshore_operational_forecast", "vw_latest_offshore_forecast", "vw_offshore_safe_windows",
    "vw_offshore_risk_summary", "vw_executive_energy_operations", "vw_asset_operational_kpis",
    "vw_next_weather_critical_event",
]
UPDATE_COLUMNS = {
    "dim_location": ["location_name", "country", "latitude", "longitude"],
    "dim_asset": [
        "asset_name", "asset_type", "operator_name", "location_key", "is_active", "max_wind_kmh",
        "max_gust_kmh", "max_wave_height_m", "minimum_visibility_m", "updated_at",
    ],
    "dim_energy_product": ["product_name", "commodity_type", "default_unit", "updated_at"],
    "dim_country": ["region", "updated_at"],
    "dim_rig_classification": ["updated_at"],
    "fact_weather_forecast": ["time_key", "forecast_horizon_hours", *[n for n, _ in WEATHER_MEASURES], "ingestion_time"],
    "fact_marine_forecast": ["time_key", "forecast_horizon_hours", *[n for n, _ in MARINE_MEASURES], "ingestion_time"],
    "fact_operational_weather_risk": ["time_key", *[n for n, _ in RISK_COLUMNS], "ingestion_time"],
    "fact_oil_price": ["price_usd", "unit", "source_timestamp", "ingestion_time"],
    "fact_rig_count": ["rig_count", "source_file", "source_ingestion_time", "warehouse_loaded_at"],
}
