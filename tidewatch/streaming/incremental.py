"""Incremental load of landed forecast files with Structured Streaming.

The reference picks "the newest landed file" and reloads it.  The
Spark-native form is a file-source stream over the landing folder: each
new file is read exactly once (the stream's checkpoint remembers which),
``availableNow`` processes whatever has landed and stops, and every
micro-batch is upserted into the fact table by its grain.  Because the
upsert is idempotent, a micro-batch replayed after a failure leaves the
same table, so the sink is effectively exactly-once.

This is a convenience around the batch jobs, not a separate engine: the
micro-batch runs the same Silver job and the same fact load.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewatch.operators.contracts import Watch
from tidewatch.plans import warehouse as W
from tidewatch.plans.runs import WarehouseStore
from tidewatch.plans.silver import silver_atmospheric, silver_marine
from tidewatch.session import checkpoint_dir
from tidewatch.sources import bronze, files

DATASETS = {
    "atmospheric_forecast": ("fact_weather_forecast", bronze.ATMOSPHERIC_ARRAYS, silver_atmospheric),
    "marine_forecast": ("fact_marine_forecast", bronze.MARINE_ARRAYS, silver_marine),
}


def forecast_stream(spark: SparkSession, landing_dir: str, dataset: str, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of landed forecast documents (one row per file)."""
    arrays = DATASETS[dataset][1]
    reader = (
        spark.readStream.schema(bronze.forecast_schema(arrays))
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(landing_dir).selectExpr(
        "*", "_metadata.file_name AS source_file", "_metadata.file_modification_time AS file_time"
    )


def load_batch(
    spark: SparkSession, docs: DataFrame, store: WarehouseStore, dataset: str, run_time: str,
) -> None:
    """One micro-batch: the Silver job is written once, counting the document
    contracts; the hours it brings enter ``dim_time``, then the touched runs are
    upserted. In a warehouse that has its assets, an unknown one stops the batch (J07)."""
    table, arrays, silver_job = DATASETS[dataset]
    hours, contracts = bronze.watched_forecast_hours(docs, dataset, arrays)
    stored = store.path(f"incoming-{uuid.uuid4().hex}")
    try:
        bronze.write_silver(silver_job(hours), stored, ["asset_id", "forecast_valid_time"])
        for contract in contracts:
            contract.check()
        _load_stored(spark.read.parquet(stored), store, table, run_time)
    finally:
        files.delete(spark, stored)


def _load_stored(silver: DataFrame, store: WarehouseStore, table: str, run_time: str) -> None:
    store.recover()
    stamps = silver.select(W.F.col("forecast_valid_time").alias("timestamp"))
    store.replace_all({"dim_time": W.load_dim_time(store.read("dim_time"), stamps, run_time)})
    measures = W.S.WEATHER_MEASURES if table == "fact_weather_forecast" else W.S.MARINE_MEASURES
    key = W.S.TABLES[table][0].fields[0].name
    runs = W.forecast_fact_rows(silver, measures, key, run_time).selectExpr("to_date(forecast_reference_time) AS run_date")
    current = store.touched_slice(table, runs)
    assets = store.read("dim_asset") if store.exists("dim_asset") else None
    watches: list[Watch] = []
    frames = {table: W.load_forecast_fact(current, silver, table, run_time, assets, store.read("dim_time"), watches)}
    if table == "fact_weather_forecast":
        frames["agg_latest_run"] = W.merge_latest_runs(store.latest_runs(), silver)
    store.replace_all(frames, watches)


def run_available(
    spark: SparkSession,
    landing_dir: str,
    warehouse_root: str,
    dataset: str,
    run_time: str,
    checkpoint: str | None = None,
    max_files: int | None = None,
) -> None:
    """Process every file landed since the last run, then stop (``availableNow``)."""
    store = WarehouseStore(spark, warehouse_root)
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), f"stream-{dataset}")

    def each(batch: DataFrame, epoch_id: int) -> None:
        load_batch(spark, batch, store, dataset, run_time)

    query = (
        forecast_stream(spark, landing_dir, dataset, max_files)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
