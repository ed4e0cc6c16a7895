"""Declared constraints of the warehouse tables, enforced while a table is written.

``watched`` counts the rows that break each constraint as a side effect of the write
that stages a table's next state (``Observation``), so enforcement needs no second scan.
A load publishes only if every count is zero. Foreign keys are watched where the load
joins its dimensions (``operators.contracts.watch_keys``); the unique grain is what the
upsert keys on.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.functions.risk_rules import LEVELS
from tidewatch.operators.contracts import ContractError

_FORECAST = ["time_key", "asset_key", "forecast_reference_time", "forecast_valid_time"]
_LEVELS = ["wind_risk_level", "gust_risk_level", "wave_risk_level", "visibility_risk_level", "overall_risk_level"]

# The declared NOT NULL columns and VARCHAR lengths of each table.
NOT_NULL = {
    "dim_location": ["location_id", "location_name", "created_at", "updated_at"],
    "dim_time": ["timestamp", "date", "hour", "month", "created_at"],
    "dim_asset": ["asset_id", "asset_name", "asset_type", "location_key", "is_active", "created_at", "updated_at"],
    "dim_energy_product": ["product_code", "product_name", "commodity_type", "created_at", "updated_at"],
    "dim_country": ["country_name", "region", "created_at", "updated_at"],
    "dim_rig_classification": ["drilling_target", "location_type", "rig_status", "created_at", "updated_at"],
    "fact_weather_forecast": [*_FORECAST, "forecast_horizon_hours", "source", "ingestion_time"],
    "fact_marine_forecast": [*_FORECAST, "forecast_horizon_hours", "source", "ingestion_time"],
    "fact_operational_weather_risk": [*_FORECAST, *_LEVELS, "operation_recommendation", "source", "ingestion_time"],
    "fact_oil_price": ["time_key", "product_key", "price_usd", "unit", "source", "series", "source_timestamp", "ingestion_time"],
    "fact_rig_count": ["time_key", "country_key", "rig_classification_key", "rig_count", "source", "source_file",
                       "source_ingestion_time", "warehouse_loaded_at"],
    "fact_pipeline_run": ["pipeline_name", "started_at", "status"],
    "fact_data_quality_check": ["pipeline_run_key", "check_name", "passed", "checked_at"],
}
LENGTHS = {
    "dim_location": {"location_id": 50, "location_name": 150, "country": 100},
    "dim_time": {"season": 20},
    "dim_asset": {"asset_id": 50, "asset_name": 150, "asset_type": 50, "operator_name": 150},
    "dim_energy_product": {"product_code": 50, "product_name": 150, "commodity_type": 50, "default_unit": 50},
    "dim_country": {"country_name": 150, "region": 100},
    "dim_rig_classification": {"drilling_target": 50, "location_type": 50, "rig_status": 50},
    "fact_weather_forecast": {"source": 100},
    "fact_marine_forecast": {"source": 100},
    "fact_operational_weather_risk": {**dict.fromkeys(_LEVELS, 20), "operation_recommendation": 255,
                                      "limiting_parameter": 100, "source": 100},
    "fact_oil_price": {"unit": 50, "source": 100, "series": 150},
    "fact_rig_count": {"source": 100, "source_file": 255},
    "fact_pipeline_run": {"pipeline_name": 100, "status": 20},
    "fact_data_quality_check": {"check_name": 200},
}
RUN_STATES = ["RUNNING", "SUCCESS", "FAILED"]


def _rules(table: str) -> dict[str, tuple[str, Column]]:
    """Declared CHECKs: the column and the condition that breaks them (null: not broken)."""
    def rule(name: str, column: str, condition) -> dict[str, tuple[str, Column]]:
        return {name: (column, condition(F.col(column)))}

    horizon = rule("horizon_not_negative", "forecast_horizon_hours", lambda c: c < 0)
    return {
        "dim_time": {**rule("hour_range", "hour", lambda c: ~c.between(0, 23)), **rule("month_range", "month", lambda c: ~c.between(1, 12))},
        "fact_weather_forecast": {**horizon, **rule("humidity_range", "relative_humidity_pct", lambda c: ~c.between(0, 100))},
        "fact_marine_forecast": {**horizon, **rule("wave_not_negative", "wave_height_m", lambda c: c < 0)},
        "fact_operational_weather_risk": rule("overall_risk_level_domain", "overall_risk_level", lambda c: ~c.isin(*LEVELS)),
        "fact_oil_price": rule("price_not_negative", "price_usd", lambda c: c < 0),
        "fact_rig_count": rule("rig_count_not_negative", "rig_count", lambda c: c < 0),
        "fact_pipeline_run": rule("status_domain", "status", lambda c: ~c.isin(*RUN_STATES)),
    }.get(table, {})


def broken(df: DataFrame, table: str) -> dict[str, Column]:
    """Every row constraint on the columns of ``df`` by name, as the condition that breaks it."""
    declared = {
        **{f"{c}_not_null": (c, F.col(c).isNull()) for c in NOT_NULL.get(table, [])},
        **{f"{c}_length": (c, F.length(c) > n) for c, n in LENGTHS.get(table, {}).items()},
        **_rules(table),
    }
    return {name: condition for name, (column, condition) in declared.items() if column in df.columns}


def watched(df: DataFrame, table: str) -> tuple[DataFrame, Observation | None]:
    """``df`` with its constraint violations counted by whatever consumes it."""
    conditions = broken(df, table)
    if not conditions:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.count_if(cond).alias(name) for name, cond in conditions.items()]), seen


def require_kept(table: str, counts: Mapping[str, int]) -> None:
    failed = {name: n for name, n in counts.items() if n}
    if failed:
        raise ContractError(f"{table}: constraints broken: " + ", ".join(f"{name} ({n} rows)" for name, n in sorted(failed.items())))


def row_violations(df: DataFrame, table: str) -> DataFrame:
    """(table_name, constraint_name, violations) of every row constraint, from one scan."""
    conditions = broken(df, table)
    one = df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("constraint_name"), F.col(name).alias("violations"))
        for name in conditions])))
