"""Named queries over the test tables: one per operator / view / job.

Every query reads the driver's test tables, derives the stand-in inputs,
runs the library's jobs on them and returns a DataFrame.  The compared
form drops the hash surrogate keys (engine-specific) and returns NUMERIC
measures as DOUBLE.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import scalars as X
from tidewatch.operators.contracts import assert_hourly_arrays, hourly_array_violations
from tidewatch.operators.upsert import insert_ignore
from tidewatch.plans import build
from tidewatch.plans import ledger as L
from tidewatch.plans import silver as SIL
from tidewatch.plans import warehouse as W
from tidewatch.sources import bronze
from tidewatch.sources import testtables as TT
from tidewatch.plans import views_integrated as VI
from tidewatch.plans import views_price as VP
from tidewatch.plans import views_rig as VR
from tidewatch.plans import views_weather as VW
from tidewatch.plans import serving as SV
from tidewatch.plans import quality as Q
from tidewatch.plans.risk import risk_distribution
from tidewatch.session import checkpoint_dir, shuffles_dropped
from tidewatch.sources.testtables import AS_OF, RUN_TIME

HASH_KEYS = {
    "time_key", "asset_key", "location_key", "product_key", "country_key", "rig_classification_key",
    "oil_price_key", "rig_count_key", "weather_forecast_key", "marine_forecast_key", "operational_risk_key",
}

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Drop hash keys and ordinals; NUMERIC -> DOUBLE; DATE -> TIMESTAMP at
    midnight (a date then reads back as the same datetime value from Spark
    and from DuckDB, whichever way the results are converted)."""
    cols = []
    for f in df.schema.fields:
        if f.name in HASH_KEYS or f.name == "record_order":
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz").alias(f.name)
        cols.append(c)
    return df.select(*cols)


def _wh(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return build.warehouse(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return build.silver_frames(spark, sf_dir)


def _view(fn) -> Query:
    return lambda spark, sf_dir: fn(_wh(spark, sf_dir))


def _with_asset_id(t: dict[str, DataFrame], df: DataFrame) -> DataFrame:
    return df.join(t["dim_asset"].select("asset_key", "asset_id"), on="asset_key", how="inner")


def _fact_rows(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = _silver(spark, sf_dir)
        t = build.warehouse_from_silver(spark, silver, validate=True)
        return _with_asset_id(t, t[table])
    return run


def _price_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = build.warehouse_from_silver(spark, _silver(spark, sf_dir), validate=True)
    f = t["fact_oil_price"].join(t["dim_energy_product"].select("product_key", "product_code"), on="product_key")
    return f.select("product_code", "price_usd", "unit", "source", "series", "source_timestamp", "ingestion_time")


def _rig_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = build.warehouse_from_silver(spark, _silver(spark, sf_dir), validate=True)
    return VR.rig_count_history(t).select(
        F.col("timestamp").alias("observation_date"), "country_name", "drilling_target", "location_type",
        "rig_status", "rig_count", "source", "source_file", "source_ingestion_time", "warehouse_loaded_at",
    )


def _dim_asset_rows(t) -> DataFrame:
    return t["dim_asset"].join(t["dim_location"].select("location_key", "location_id"), on="location_key").select(
        "asset_id", "asset_name", "asset_type", "operator_name", "location_id", "is_active", "max_wind_kmh",
        "max_gust_kmh", "max_wave_height_m", "minimum_visibility_m")


def _latest_global_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _wh(spark, sf_dir)
    run = _with_asset_id(t, VW.latest_global_run(t))
    return run.select(
        "forecast_reference_time", "forecast_valid_time", "asset_id", "wind_risk_level", "gust_risk_level",
        "wave_risk_level", "visibility_risk_level", "overall_risk_level", "operation_recommendation",
        "limiting_parameter", "source", "ingestion_time",
    )


def _src_silver_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver read contract (S08) on a Silver table kept as text: padded and
    missing asset ids, hours that are no time."""
    hour = F.hour("forecast_valid_time")
    stored = _silver(spark, sf_dir)["atmospheric"].select(
        F.when(hour % 7 != 3, F.concat(F.lit("  "), "asset_id", F.lit("\t"))).alias("asset_id"),
        F.col("forecast_reference_time").cast("string").alias("forecast_reference_time"),
        F.when(hour == 5, "no time").otherwise(F.col("forecast_valid_time").cast("string")).alias("forecast_valid_time"),
        "forecast_horizon_hours", "temperature_c", "source",
    )
    return bronze.silver_contract(stored, bronze.SILVER_CONTRACTS["atmospheric"], "atmospheric Silver")


QUERIES: dict[str, Query] = {
    # flagship first
    "offshore_risk_summary": _view(VW.offshore_risk_summary),
    # silver jobs and the rules engine
    "silver_atmospheric": lambda s, d: _silver(s, d)["atmospheric"],
    "src_silver_contract": _src_silver_contract,
    "silver_marine": lambda s, d: _silver(s, d)["marine"],
    "operational_risk": lambda s, d: _silver(s, d)["risk"],
    "risk_distribution": lambda s, d: risk_distribution(_silver(s, d)["risk"]),
    "silver_price": lambda s, d: _silver(s, d)["price"],
    "silver_rig": lambda s, d: _silver(s, d)["rig"],
    # dimensions and facts
    "dim_time_rows": lambda s, d: _wh(s, d)["dim_time"],
    "dim_location_rows": lambda s, d: _wh(s, d)["dim_location"].select(
        "location_id", "location_name", "country", "latitude", "longitude"),
    "dim_asset_rows": lambda s, d: _dim_asset_rows(_wh(s, d)),
    "dim_product_rows": lambda s, d: _wh(s, d)["dim_energy_product"].select(
        "product_code", "product_name", "commodity_type", "default_unit"),
    "dim_country_rows": lambda s, d: _wh(s, d)["dim_country"].select("country_name", "region"),
    "dim_rig_classification_rows": lambda s, d: _wh(s, d)["dim_rig_classification"].select(
        "drilling_target", "location_type", "rig_status"),
    "fact_forecast_rows": _fact_rows("fact_weather_forecast"),
    "fact_marine_rows": _fact_rows("fact_marine_forecast"),
    "fact_risk_rows": _fact_rows("fact_operational_weather_risk"),
    "fact_price_rows": _price_fact_rows,
    "fact_rig_rows": _rig_fact_rows,
    # weather views
    "offshore_operational_forecast": _view(VW.offshore_operational_forecast),
    "latest_offshore_forecast": _view(VW.latest_offshore_forecast),
    "offshore_safe_windows": _view(VW.offshore_safe_windows),
    "offshore_critical_periods": _view(VW.offshore_critical_periods),
    "asset_kpis": _view(VW.asset_operational_kpis),
    "next_critical_event": _view(lambda t: VW.next_weather_critical_event(t, AS_OF)),
    "weather_run_summary": _view(VW.weather_run_summary),
    "latest_global_run": _latest_global_run,
    # price views
    "price_history": _view(VP.oil_price_history),
    "daily_price": _view(VP.daily_oil_price),
    "daily_price_summary": _view(VP.daily_oil_price_summary),
    "latest_price_by_product": _view(VP.latest_oil_price_by_product),
    "latest_price_by_series": _view(VP.latest_oil_price_by_series),
    "price_summary": _view(VP.energy_price_summary),
    "latest_price_summary": _view(VP.latest_price_summary),
    # rig views
    "rig_count_history": _view(VR.rig_count_history),
    "rig_country_monthly": _view(VR.rig_count_country_monthly),
    "rig_region_monthly": _view(VR.rig_count_region_monthly),
    "latest_rig_count": _view(VR.latest_rig_count),
    "rig_monthly_change": _view(VR.rig_count_monthly_change),
    "latest_rig_summary": _view(VR.latest_rig_summary),
    # integrated
    "executive_snapshot": _view(lambda t: VI.executive_energy_operations(t, RUN_TIME)),
    # observability
    "latest_pipeline_run": _view(L.latest_pipeline_run),
    "quality_summary": _view(L.latest_quality_summary),
    "quality_summary_total": _view(L.latest_quality_summary_total),
    "latest_quality_checks": _view(L.latest_quality_checks),
    "run_history": _view(L.pipeline_run_history),
}
QUERIES.update(SV.QUERIES)
QUERIES.update(Q.QUERIES)


# ------------------------------------------------- second deliveries


def _reload_dim_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset registry delivered twice: the second delivery raises every wind
    limit by 5 km/h.  Limits and updated_at take the new values; created_at
    stays (K08 + K10)."""
    s = _silver(spark, sf_dir)
    t = build.warehouse_from_silver(spark, s)
    second = s["registry"].withColumn("max_wind_kmh", F.col("max_wind_kmh") + 5)
    nxt = W.load_dim_asset(t["dim_asset"], second, t["dim_location"], TT.RUN_TIME_2)
    return nxt.select("asset_id", "asset_name", "max_wind_kmh", "max_gust_kmh", "created_at", "updated_at")


def _reload_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rig classifications delivered twice: only updated_at moves."""
    s = _silver(spark, sf_dir)
    t = build.warehouse_from_silver(spark, s)
    nxt = W.load_dim_rig_classification(t["dim_rig_classification"], s["rig"], TT.RUN_TIME_2)
    return nxt.select("drilling_target", "location_type", "rig_status", "created_at", "updated_at")


def _redelivery_weather_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same forecast delivered twice: same rows, new ingestion time."""
    s = _silver(spark, sf_dir)
    t = build.warehouse_from_silver(spark, s)
    nxt = W.load_forecast_fact(t["fact_weather_forecast"], s["atmospheric"], "fact_weather_forecast", TT.RUN_TIME_2)
    return _with_asset_id(t, nxt).select(
        "asset_id", "forecast_reference_time", "forecast_valid_time", "wind_speed_kmh", "source", "ingestion_time")


def _dim_time_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_time loaded from the weather hours first, then insert-ignore of
    every hour, price day and rig month: existing rows keep their
    created_at (K07, U01)."""
    s = _silver(spark, sf_dir)
    weather = (s["atmospheric"].select(F.col("forecast_valid_time").alias("timestamp"))
               .unionByName(s["marine"].select(F.col("forecast_valid_time").alias("timestamp")))
               .unionByName(s["risk"].select(F.col("forecast_valid_time").alias("timestamp"))))
    first = W.load_dim_time(W.empty_table(spark, "dim_time"), weather, TT.RUN_TIME)
    others = (W.price_fact_input(s["price"], True).select("timestamp")
              .unionByName(s["rig"].select(F.col("observation_date").alias("timestamp"))))
    return insert_ignore(first, W.time_rows(weather.unionByName(others), TT.RUN_TIME_2), ["timestamp"])


def _assets_without_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered assets with no weather forecast at all (U02 set difference, J10 anti-join)."""
    t = _wh(spark, sf_dir)
    return t["dim_asset"].join(t["fact_weather_forecast"].select("asset_key"), on="asset_key", how="left_anti") \
        .select("asset_id", "asset_name")


def _products_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of the dimension that the price batch refers to (J09 semi-join)."""
    s = _silver(spark, sf_dir)
    t = build.warehouse_from_silver(spark, s)
    batch = W.price_fact_input(s["price"], True).select("product_code")
    return t["dim_energy_product"].join(batch, on="product_code", how="left_semi").select("product_code", "product_name")


def _simple_weather_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SIL.simple_weather_clean(TT.single_location_hours(spark, sf_dir), "LOC-0", TT.RUN_TIME)


def _fact_simple_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older fact path: location and hour keys looked up with left joins; a
    reading whose hour is not in dim_time keeps a NULL key (J08)."""
    t = _wh(spark, sf_dir)
    clean = _simple_weather_clean(spark, sf_dir)
    fact = W.simple_weather_fact(clean, t["dim_location"], t["dim_time"])
    return fact.select(
        F.col("location_key").isNotNull().alias("location_resolved"),
        F.col("time_key").isNotNull().alias("time_resolved"),
        "temperature_c", "humidity", "wind_kmh", "ingestion_time")


QUERIES.update({
    "reload_dim_asset": _reload_dim_asset,
    "reload_dim_rig_classification": _reload_classification,
    "redelivery_weather_fact": _redelivery_weather_fact,
    "dim_time_incremental": _dim_time_incremental,
    "assets_without_forecast": _assets_without_forecast,
    "products_in_batch": _products_in_batch,
    "simple_weather_clean": _simple_weather_clean,
    "fact_simple_weather": _fact_simple_weather,
})


# ------------------------------------------------------- landed documents


def _landed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly arrays of text -> array contract (F07) -> rows (R01) -> Silver
    atmospheric: offsets folded, text that is no number missing (X01, X02, X24)."""
    assets = assert_hourly_arrays(TT.landed_forecast_assets(spark, sf_dir), ["time", *bronze.ATMOSPHERIC_ARRAYS])
    return SIL.silver_atmospheric(bronze.explode_hourly(assets, bronze.ATMOSPHERIC_ARRAYS))


def _explode_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays shorter than ``time`` are padded with null at their end."""
    rows = bronze.explode_hourly(TT.short_forecast_assets(spark, sf_dir), ["wind_speed_10m"])
    return rows.select(
        F.trim("asset_id").alias("asset_id"), F.col("record_order.asset_pos").cast("bigint").alias("document"),
        X.to_utc_timestamp_ntz("forecast_reference_time").alias("forecast_reference_time"),
        F.col("record_order.hour_pos").cast("bigint").alias("position"),
        X.to_utc_timestamp_ntz("forecast_valid_time").alias("forecast_valid_time"),
        X.to_number("wind_speed_10m").alias("wind_speed"))


def _array_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets whose arrays break the contract, with the fields at fault."""
    bad = hourly_array_violations(TT.short_forecast_assets(spark, sf_dir), ["time", *bronze.ATMOSPHERIC_ARRAYS])
    return bad.select(F.trim("asset_id").alias("asset_id"), F.array_join("problems", "; ").alias("problems"))


def _positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses joined to the requested assets by position, counts equal."""
    assets = TT.asset_registry(spark, sf_dir).withColumnRenamed("registry_row", "request_index")
    return bronze.attach_by_position(TT.feed_responses(spark, sf_dir), assets).select(
        "request_index", "asset_id", "asset_name", "response")


QUERIES.update({
    "silver_atmospheric_landed": _landed_silver,
    "explode_hourly_padded": _explode_padded,
    "contract_hourly_arrays": _array_contract,
    "attach_by_position": _positional_join,
})


# ---------------------------------------------------------- landed files
# The stand-in inputs written as a feed's files in the shared folder, then read back.


def _landing(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}"


def _rig_sheet_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _landing(spark)
    TT.rig_sheet_rows(spark, sf_dir).select(*bronze.RIG_HEADER).write.option("header", True).csv(folder)
    return bronze.read_rig_sheet(spark, folder)


def _silver_rig_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet as CSV, header found by its cells (S06) -> Silver; header lines fail the Year coercion."""
    return SIL.silver_rig(_rig_sheet_file(spark, sf_dir), RUN_TIME).drop("source_file")


def _bronze_rig_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet rows kept as text in Bronze under their ingest date (K02), read back."""
    root = _landing(spark)
    bronze.write_bronze_rows(TT.rig_sheet_rows(spark, sf_dir).drop("source_file"), root, RUN_TIME, "rig_count_monthly.csv")
    rows = spark.read.parquet(root)
    return rows.select(*[F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in bronze.RIG_HEADER],
                       "source_file", "ingestion_time", F.col("ingest_date").cast("timestamp_ntz").alias("ingest_date"))


def _order_texts() -> list[Column]:
    """Landing order of a price record as texts that sort like its values; numbers above 0
    are padded without a formatter."""
    texts = []
    for name, form, width in zip(TT.PRICE_RECORD_ORDER, ("%012d", "%09d", "%012d", "%012d", "%020.4f"), (12, 9, 12, 12, 20)):
        price = form.endswith("f")
        value = F.col(f"record_order.{name}").cast("double" if price else "bigint")
        digits = (value.try_cast("decimal(20,4)") if price else value).cast("string")
        padded = F.concat(F.repeat(F.lit("0"), F.lit(width) - F.length(digits)), digits)
        texts.append(F.when((value > 0) & (value < 10**15), padded).otherwise(F.format_string(form, value)))
    return [*texts, *[F.coalesce(F.col(f"record_order.{c}").cast("string"), F.lit("null")) for c in TT.PRICE_RECORD_ORDER[5:7]]]


def _silver_price_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price records landed as raw JSON, a record to a line under the ingest date (K01),
    parsed by the fields that the feed holds (S04, R03, P04, P05) -> Silver."""
    root = _landing(spark)
    with shuffles_dropped(spark):
        for records in TT.price_record_parts(spark, sf_dir):
            fields = [c for c in records.columns if c != "record_order"]
            bronze.write_bronze_json(records.select(
                F.lit("prices").alias("dataset"), F.lit(RUN_TIME).alias("ingestion_time"),
                F.concat_ws("-", *_order_texts(), "period").alias("source_file"),
                F.lit(RUN_TIME).cast("timestamp").alias("file_time"), F.lit(0).alias("pos"),
                F.to_json(F.struct(*[f"`{c}`" for c in fields])).alias("entry"),
            ), root, lines_per_file=bronze.PRICE_LINES_PER_FILE)
    return SIL.silver_price(bronze.landed_price_records(bronze.read_landed(spark, root)))


def _silver_atmospheric_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast documents landed an asset to a line under their ingest date (K01, S03),
    arrays checked and opened (F07, R01) -> Silver."""
    root = _landing(spark)
    bronze.write_bronze_json(TT.landed_forecast_assets(spark, sf_dir).select(
        F.lit("atmospheric").alias("dataset"), "ingestion_time", "source_file",
        F.lit(RUN_TIME).cast("timestamp").alias("file_time"), F.col("asset_pos").alias("pos"),
        F.to_json(F.struct(F.col("asset").withField("asset_id", F.col("asset_id")).alias("asset"),
                           F.struct("hourly").alias("api_response"))).alias("entry")), root)
    hours, _ = bronze.landed_forecast_hours(bronze.read_landed(spark, root), "atmospheric", bronze.ATMOSPHERIC_ARRAYS)
    return SIL.silver_atmospheric(hours)


QUERIES.update({
    "silver_rig_files": _silver_rig_files,
    "bronze_rig_rows": _bronze_rig_rows,
    "silver_price_landed": _silver_price_landed,
    "silver_atmospheric_files": _silver_atmospheric_files,
})


def queries() -> dict[str, Query]:
    return {name: (lambda fn: (lambda spark, sf_dir: comparable(fn(spark, sf_dir))))(fn) for name, fn in QUERIES.items()}
