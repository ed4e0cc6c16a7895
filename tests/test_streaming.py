import json
import os

from tidewatch.plans.runs import WarehouseStore
from tidewatch.streaming.incremental import run_available
from tests.test_sources import asset, doc, write


def test_available_now_stream_upserts_each_new_file_once(spark, tmp):
    land, wh, ck = f"{tmp}/landing", f"{tmp}/wh", f"{tmp}/ckpt"
    times = ["2024-01-01T08:00", "2024-01-01T09:00"]
    write(f"{land}/d1/a.json", doc([asset(0, times), asset(1, times)]))
    write(f"{land}/d1/b.json", doc([asset(2, times)], ingestion="2024-01-02T00:00:00Z"))
    run_available(spark, land, wh, "atmospheric_forecast", "2024-02-01 00:00:00", checkpoint=ck)
    store = WarehouseStore(spark, wh)
    fact = store.read("fact_weather_forecast")
    assert fact.count() == 6
    # a re-delivery of asset 0's run with a new temperature: same grain, value updated, no new rows
    again = asset(0, times)
    again["api_response"]["hourly"]["temperature_2m"] = [99.0, 98.0]
    write(f"{land}/d2/c.json", doc([again]))
    run_available(spark, land, wh, "atmospheric_forecast", "2024-02-02 00:00:00", checkpoint=ck)
    fact = store.read("fact_weather_forecast")
    assert fact.count() == 6
    temps = sorted(float(r.temperature_c) for r in fact.collect())
    assert 99.0 in temps and 98.0 in temps
    # nothing new landed: the stream does nothing and the table is unchanged
    run_available(spark, land, wh, "atmospheric_forecast", "2024-02-03 00:00:00", checkpoint=ck)
    assert store.read("fact_weather_forecast").where("ingestion_time = '2024-02-03'").count() == 0


def test_stream_fills_dim_time_and_stops_at_unknown_assets(spark, tmp):
    import pytest
    from pyspark.sql import functions as F
    from pyspark.sql.utils import StreamingQueryException

    from tidewatch.operators.upsert import align_schema, surrogate_key
    from tidewatch import schemas as S

    land, store = f"{tmp}/landing", WarehouseStore(spark, f"{tmp}/wh")
    times = ["2024-01-01T08:00", "2024-01-01T09:00"]
    known = spark.createDataFrame([("A0",)], "asset_id string").select(
        surrogate_key("asset_id").alias("asset_key"), "asset_id", F.lit("n").alias("asset_name"), F.lit("t").alias("asset_type"),
        F.lit(1).alias("location_key"), F.lit(True).alias("is_active"), F.lit("2024-01-01").alias("created_at"),
        F.lit("2024-01-01").alias("updated_at"))
    store.replace_all({"dim_asset": align_schema(known, S.DIM_ASSET)})
    write(f"{land}/a.json", doc([asset(0, times)]))
    run_available(spark, land, store.root, "atmospheric_forecast", "2024-02-01 00:00:00", checkpoint=f"{tmp}/ck")
    assert store.read("fact_weather_forecast").count() == 2 and store.read("dim_time").count() == 2
    assert store.read("agg_latest_run").count() == 1
    write(f"{land}/b.json", doc([asset(1, ["2024-01-05T00:00"])], ingestion="2024-01-02T00:00:00Z"))
    with pytest.raises(StreamingQueryException, match="asset_key not found for: A1"):
        run_available(spark, land, store.root, "atmospheric_forecast", "2024-02-01 00:00:00", checkpoint=f"{tmp}/ck")
    assert store.read("fact_weather_forecast").count() == 2
    short = asset(0, times)
    short["api_response"]["hourly"]["visibility"] = [1.0]
    write(f"{land}/c.json", doc([short], ingestion="2024-01-03T00:00:00Z"))
    with pytest.raises(StreamingQueryException, match="visibility: length differs from time"):
        run_available(spark, land, store.root, "atmospheric_forecast", "2024-02-01 00:00:00", checkpoint=f"{tmp}/ck2")
