import datetime as dt
import json
import os
import time

import pytest

from tidewatch.operators.contracts import ContractError
from tidewatch.plans.build import asset_limits
from tidewatch.plans.silver import silver_atmospheric, silver_marine, silver_price, silver_price_with_metrics, silver_rig, simple_weather_clean
from tidewatch.sources import bronze

ATM = bronze.ATMOSPHERIC_ARRAYS


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def asset(i, times, arrays=None, short=None):
    hourly = {"time": times}
    for a in arrays or ATM:
        vals = [float(10 * i + k) for k in range(len(times))]
        hourly[a] = vals[:-1] if a == short else vals
    return {"request_index": i, "asset": {"asset_id": f" A{i} ", "asset_name": f"Asset {i}", "asset_type": "Platform",
            "location_id": f"L{i}", "latitude": 25.5, "longitude": 54.5}, "api_response": {"hourly": hourly}}


def doc(assets, dataset="atmospheric_forecast", ingestion="2024-01-01T10:30:00.000000+02:00"):
    return json.dumps({"dataset": dataset, "source": "api", "ingestion_time": ingestion,
                       "asset_count": len(assets), "assets": assets}, indent=1)


def test_forecast_json_to_silver(spark, tmp):
    times = ["2024-01-01T08:00", "2024-01-01T09:00", "bad", "2024-01-01T09:00"]
    a0 = asset(0, times)
    a0["api_response"]["hourly"]["wind_speed_10m"] = [5, None, "x", "7"]
    path = write(f"{tmp}/atm/f1.json", doc([a0, asset(1, times[:2])]))
    hours = bronze.read_forecast_hours(spark, path, "atmospheric_forecast", ATM)
    out = silver_atmospheric(hours).orderBy("asset_id", "forecast_valid_time").collect()
    assert [(r.asset_id, r.forecast_valid_time.hour) for r in out] == [("A0", 8), ("A0", 9), ("A1", 8), ("A1", 9)]
    ref = dt.datetime(2024, 1, 1, 8, 30)  # +02:00 folded into UTC
    assert all(r.forecast_reference_time == ref for r in out)
    assert [r.forecast_horizon_hours for r in out] == [0, 0, 0, 0]  # before the run -> 0
    a0_9 = out[1]
    assert a0_9.wind_speed_kmh == 7.0  # same hour twice: the later array position wins
    assert out[0].wind_speed_kmh == 5.0 and a0_9.temperature_c == 3.0
    assert a0_9.source_file == "f1.json"


def test_forecast_contracts(spark, tmp):
    times = ["2024-01-01T08:00", "2024-01-01T09:00"]
    with pytest.raises(ContractError, match="expected dataset"):
        bronze.read_forecast_hours(spark, write(f"{tmp}/a/x.json", doc([asset(0, times)], "marine_forecast")),
                                   "atmospheric_forecast", ATM)
    with pytest.raises(ContractError, match="non-empty"):
        bronze.read_forecast_hours(spark, write(f"{tmp}/b/x.json", doc([])), "atmospheric_forecast", ATM)
    with pytest.raises(ContractError, match="asset A1: visibility: length differs"):
        bronze.read_forecast_hours(spark, write(f"{tmp}/c/x.json", doc([asset(1, times, short="visibility")])),
                                   "atmospheric_forecast", ATM)


def test_marine_negative_scrub(spark, tmp):
    m = asset(0, ["2024-01-01T08:00"], bronze.MARINE_ARRAYS)
    for a in bronze.MARINE_ARRAYS:
        m["api_response"]["hourly"][a] = [-1.0]
    path = write(f"{tmp}/m/m.json", doc([m], "marine_forecast"))
    r = silver_marine(bronze.read_forecast_hours(spark, path, "marine_forecast", bronze.MARINE_ARRAYS)).collect()[0]
    assert r.wave_height_m is None and r.ocean_current_velocity_kmh is None and r.swell_wave_period_s is None
    assert r.wave_direction_deg == -1.0 and r.sea_surface_temperature_c == -1.0  # kept


def test_price_json(spark, tmp):
    recs = [
        {"period": "2024-01-02", "product": " epd2d ", "product-name": "Diesel", "value": "10.5", "series": "S1", "units": "$/GAL", "duoarea": "NUS"},
        {"period": "2024-01-02", "product": "EPD2D", "product-name": "Diesel", "value": 11, "series": "S1", "units": "$/GAL"},
        {"period": "bad", "product": "X", "product-name": "X", "value": "1", "series": "S2", "units": "u"},
        {"period": "2024-01-03", "product": "X", "product-name": "X", "value": "12d", "series": "S3", "units": "u"},
        {"period": "2024-01-03", "product": "X", "product-name": "X", "value": "-1", "series": "S4", "units": "u"},
        {"period": "2024-01-03", "product": "X", "product-name": "X", "value": "2", "series": "S5", "units": None},
        {"period": "2024-01-03", "product": "", "product-name": "Blank", "value": "3", "series": "S6", "units": "u"},
    ]
    path = write(f"{tmp}/p/p.json", json.dumps({"response": {"data": recs}}))
    out = silver_price(bronze.read_price_records(spark, path)).orderBy("series").collect()
    assert [(r.series, r.price_usd, r.product_code) for r in out] == [("S1", 11.0, "EPD2D"), ("S6", 3.0, "")]
    assert "area_code" in silver_price(bronze.read_price_records(spark, path)).columns
    no_units = [{k: v for k, v in r.items() if k not in ("units", "duoarea")} for r in recs[:1]]
    path2 = write(f"{tmp}/p2/p.json", json.dumps({"response": {"data": no_units}}))
    got = silver_price(bronze.read_price_records(spark, path2))
    assert got.collect()[0].unit == "UNKNOWN" and "area_code" not in got.columns


def test_rig_sheet_csv(spark, tmp):
    pre = "\n".join(f"Preamble line {i},,," for i in range(11))
    head = "Region,Country,DrillFor,Location,Rig Status,Year,Month,Rig Count Value"
    body = [
        "middle east, saudi arabia ,oil,LAND,non-opec,2024,1,5",
        "Middle East,Saudi Arabia,Oil,Land,Non-Opec,2024,1,7",  # duplicate key: last wins
        "Europe,Norway,gas,offshore,o'neil 3rd,2024,1.5,2",
        "Europe,Norway,gas,offshore,x,2024,0,2", "Europe,Norway,gas,offshore,x,2024,13,2",
        "Europe,Norway,gas,offshore,x,1899,1,2", "Europe,Norway,gas,offshore,x,2024,2,-1",
        "Europe,Norway,gas,offshore,x,2024,2,", "Europe,Norway,gas,offshore,x,2024,2,abc",
    ]
    path = write(f"{tmp}/rig/sheet.csv", pre + "\n" + head + "\n" + "\n".join(body) + "\n")
    out = silver_rig(bronze.read_rig_sheet(spark, path), "2024-02-01 00:00:00").orderBy("country").collect()
    assert [(r.region, r.country, r.drilling_target, r.location_type, r.rig_status, r.rig_count,
             r.observation_date.month) for r in out] == [
        ("Europe", "NORWAY", "Gas", "Offshore", "O'Neil 3Rd", 2.0, 1),
        ("Middle East", "SAUDI ARABIA", "Oil", "Land", "Non-Opec", 7.0, 1)]


def test_rig_sheet_of_forty_columns(spark, tmp):
    extra = [f"X{i}" for i in range(32)]
    head = ",".join([*extra, "Region", "Country", "DrillFor", "Location", "Rig Status", "Year", "Month", "Rig Count Value"])
    body = ",".join([*["x"] * 32, "Europe", "Norway", "gas", "offshore", "active", "2024", "3", "4"])
    path = write(f"{tmp}/rig/wide.csv", "Preamble\n" + head + "\n" + body + "\n")
    out = silver_rig(bronze.read_rig_sheet(spark, path), "2024-02-01 00:00:00").collect()
    assert [(r.country, r.rig_count, r.observation_date.month) for r in out] == [("NORWAY", 4.0, 3)]


def test_asset_registry_lenient(spark, tmp):
    text = "\n".join([
        ",".join(bronze.REGISTRY_COLUMNS),
        "A1,Alpha,P,Op,L1,Loc 1,UAE,25.6,54.8,35,50,2.5,2000",
        "A2,Bravo,P,Op,L2,Loc 2,UAE,91,54.8,35,50,2.5,2000",
        "A3,Charlie,P,Op,L3,Loc 3,UAE,25,east,35,50,2.5,2000",
        ",Nobody,P,Op,L4,Loc 4,UAE,25,54,35,50,2.5,2000",
        "A1,Alpha2,P,Op,L1,Loc 1,UAE,25.6,54.8,40,,3.0,1500",
    ])
    reg = bronze.read_asset_registry(spark, write(f"{tmp}/reg.csv", text))
    out = asset_limits(reg).collect()
    assert [(r.asset_id, r.asset_name, r.max_wind_kmh, r.max_gust_kmh) for r in out] == [("A1", "Alpha2", 40.0, None)]
    with pytest.raises(ContractError, match="latitude, longitude"):
        bronze.clean_asset_registry(reg.drop("latitude", "longitude"))


def test_latest_file_skips_empty(spark, tmp):
    old = write(f"{tmp}/land/a/old.json", "{}")
    new = write(f"{tmp}/land/b/new.json", "{}")
    empty = write(f"{tmp}/land/b/empty.json", "")
    now = time.time()
    os.utime(old, (now - 100, now - 100))
    os.utime(new, (now - 50, now - 50))
    os.utime(empty, (now, now))
    assert bronze.latest_file(spark, [f"{tmp}/land"], "*.json").endswith("b/new.json")
    with pytest.raises(FileNotFoundError):
        bronze.latest_file(spark, [f"{tmp}/land"], "*.parquet")


def test_simple_weather_pads_and_fills(spark, tmp):
    d = {"latitude": 25.0, "longitude": 55.0, "timezone": "GMT",
         "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "x"], "temperature_2m": [20.0],
                    "relative_humidity_2m": [50.0, 51.0, 52.0], "wind_speed_10m": [3.0, None, 1.0]}}
    hours = bronze.read_simple_weather(spark, write(f"{tmp}/w/w.json", json.dumps(d)))
    out = simple_weather_clean(hours, "L1", "2024-02-01 00:00:00").orderBy("timestamp").collect()
    assert [(r.temperature_c, r.humidity, r.wind_kmh) for r in out] == [(20.0, 50.0, 3.0), (0.0, 51.0, 0.0)]


def test_sinks_metrics_and_helpers(spark, tmp):
    from tidewatch.operators.contracts import first_existing_column
    from tidewatch.operators.dedupe import preview
    from tidewatch.operators.metrics import rows_removed

    recs = [{"period": "2024-01-02", "product": "A", "product-name": "A", "value": "1", "series": "S", "units": "u"},
            {"period": "2024-01-02", "product": "A", "product-name": "A", "value": "2", "series": "S", "units": "u"},
            {"period": "bad", "product": "A", "product-name": "A", "value": "2", "series": "T", "units": "u"}]
    path = write(f"{tmp}/p/p.json", json.dumps({"response": {"data": recs}}))
    out, before, after = silver_price_with_metrics(bronze.read_price_records(spark, path))
    out.write.mode("overwrite").parquet(f"{tmp}/silver_price")
    assert rows_removed(before, after) == 2
    df = spark.read.parquet(f"{tmp}/silver_price")
    assert first_existing_column(df, ["rig_count", "price_usd", "unit"]) == "price_usd"
    assert first_existing_column(df, ["nope"]) is None
    assert preview(df, 1).count() == 1
    bronze.write_bronze_rows(df, f"{tmp}/bronze_rows", "2024-02-01 10:00:00", "sheet.csv")
    landed = spark.read.parquet(f"{tmp}/bronze_rows")
    assert landed.select("ingest_date").distinct().collect()[0][0] == dt.date(2024, 2, 1)
    docs = spark.createDataFrame([("x", "2024-02-01T10:00:00+00:00")], "payload string, ingestion_time string")
    bronze.write_bronze_json(docs, f"{tmp}/bronze_json")
    assert os.path.isdir(f"{tmp}/bronze_json/ingest_date=2024-02-01")
    assets = spark.createDataFrame([(0, "A0"), (1, "A1")], "request_index int, asset_id string")
    resp = spark.createDataFrame([(1, "r1"), (0, "r0")], "request_index int, body string")
    assert sorted((r.asset_id, r.body) for r in bronze.attach_by_position(resp, assets).collect()) == [("A0", "r0"), ("A1", "r1")]
    with pytest.raises(ContractError, match="1 responses for 2 assets"):
        bronze.attach_by_position(resp.limit(1), assets)
