"""A complete run from landed files (registry CSV, forecast JSON, price JSON,
rig sheet CSV) through Silver, risk, the star schema, views and the gate."""

import json

import pytest

from tidewatch.operators.contracts import ContractError
from tidewatch.plans import runs
from tidewatch.plans import views_weather as VW
from tidewatch.plans import views_price as VP
from tidewatch.plans import views_rig as VR
from tidewatch.sources import bronze
from tests.test_sources import asset, doc, write

REGISTRY = "\n".join([
    ",".join(bronze.REGISTRY_COLUMNS),
    "A0,Alpha,Platform,Op,L0,Loc 0,UAE,25.6,54.8,35,50,2.5,2000",
    "A1,Bravo,Platform,Op,L1,Loc 1,UAE,25.2,53.9,40,55,3.0,1500",
])


def test_repeated_asset_stops_the_run(spark, tmp):
    from pyspark.sql import functions as F

    from tidewatch.plans import build

    silver = build.silver_frames(spark, "/root/testdata/sf0.001")
    reg = silver["registry"]
    for registry, message in ((reg.unionByName(reg.limit(1)), "not unique"),
                              (reg.withColumn("latitude", F.lit(99.0)), "No valid assets")):
        frames = build.Lazy({**{n: (lambda n: (lambda: silver[n]))(n) for n in ("atmospheric", "marine", "price", "rig")},
                             "registry": lambda registry=registry: registry})
        with pytest.raises(ContractError, match=message):
            runs.write_silver_frames(spark, frames, f"{tmp}/{message[:3]}")


def land(tmp):
    """Landing folders with one delivery of every source."""
    times = ["2024-01-01T08:00", "2024-01-01T09:00", "2024-01-01T10:00"]
    atm = [asset(0, times), asset(1, times)]
    # asset 0: 08:00 calm, 09:00 wind 30 (>= 0.8 * 35 -> AMBER), 10:00 wind 40 (> 35 -> RED)
    atm[0]["api_response"]["hourly"]["wind_speed_10m"] = [10.0, 30.0, 40.0]
    atm[0]["api_response"]["hourly"]["wind_gusts_10m"] = [10.0, 10.0, 10.0]
    atm[0]["api_response"]["hourly"]["visibility"] = [9000.0, 9000.0, 9000.0]
    mar = [asset(0, times, bronze.MARINE_ARRAYS), asset(1, times, bronze.MARINE_ARRAYS)]
    mar[0]["api_response"]["hourly"]["wave_height"] = [0.5, 0.5, 0.5]
    write(f"{tmp}/land/registry.csv", REGISTRY)
    write(f"{tmp}/land/atm/2024-01-01/f.json", doc(atm, ingestion="2024-01-01T07:30:00Z"))
    write(f"{tmp}/land/mar/2024-01-01/f.json", doc(mar, "marine_forecast", ingestion="2024-01-01T07:30:00Z"))
    write(f"{tmp}/land/price/p.json", json.dumps({"response": {"data": [
        {"period": "2024-01-02", "product": "EPCBRENT", "product-name": "Brent Crude", "value": "80.5",
         "series": "RBRTE", "units": "$/BBL"}]}}))
    pre = "\n".join(f"line {i}" for i in range(11))
    write(f"{tmp}/land/rig/sheet.csv", pre + "\nRegion,Country,DrillFor,Location,Rig Status,Year,Month,Rig Count Value\n"
          "Middle East,UAE,Oil,Offshore,Active,2024,1,12\n")
    return {"registry_csv": f"{tmp}/land/registry.csv", "atmospheric_dir": f"{tmp}/land/atm",
               "marine_dir": f"{tmp}/land/mar", "price_dir": f"{tmp}/land/price", "rig_dir": f"{tmp}/land/rig"}


def test_run_from_landed_files(spark, tmp):
    landing = land(tmp)
    checks = runs.run_landed(spark, landing, f"{tmp}/out", "2024-01-01 12:00:00", gate=True)
    assert checks.where("NOT passed").count() == 0
    t = runs.WarehouseStore(spark, f"{tmp}/out/warehouse").tables(keep_partition=True)
    summary = {r.asset_id: r for r in VW.offshore_risk_summary(t).collect()}
    a0 = summary["A0"]
    assert (a0.forecast_hours, a0.green_hours, a0.amber_hours, a0.red_hours) == (3, 1, 1, 1)
    assert float(a0.maximum_wind_speed_kmh) == 40.0
    price = VP.energy_price_summary(t).collect()[0]
    assert price.commodity_type == "CRUDE_OIL" and float(price.average_price_usd) == 80.5
    rig = VR.latest_rig_count(t).collect()[0]
    assert rig.country_name == "UAE" and float(rig.rig_count) == 12.0


def test_runs_of_one_subject_equal_the_complete_run(spark, tmp):
    landing = land(tmp)
    with open(landing["price_dir"] + "/p.json") as f:
        prices = json.load(f)
    prices["response"]["data"].append({**prices["response"]["data"][0], "value": "not a number"})
    write(landing["price_dir"] + "/p.json", json.dumps(prices))
    sources = {"weather": ["registry_csv", "atmospheric_dir", "marine_dir"], "price": ["price_dir"], "rig": ["rig_dir"]}
    at = "2024-01-01 12:00:00"
    with pytest.raises(ContractError, match="Quality gate failed"):
        runs.run_validation(spark, f"{tmp}/parts", at)  # nothing is stored yet
    keys = {name: runs.run_landed_subject(spark, name, {k: landing[k] for k in names}, f"{tmp}/parts", at)
            for name, names in sources.items()}
    assert runs.run_validation(spark, f"{tmp}/parts", at).where("NOT passed").count() == 0
    runs.run_landed(spark, landing, f"{tmp}/whole", at)
    parts, whole = (runs.WarehouseStore(spark, f"{tmp}/{d}/warehouse") for d in ("parts", "whole"))
    for table in runs.S.REQUIRED_TABLES:
        assert sorted(map(str, parts.read(table).collect())) == sorted(map(str, whole.read(table).collect())), table
    ledger = {(r.pipeline_name, r.status) for r in runs.read_ledger(spark, f"{tmp}/parts")["fact_pipeline_run"].collect()}
    assert ledger == {("weather_pipeline", "SUCCESS"), ("price_pipeline", "SUCCESS"), ("rig_pipeline", "SUCCESS"),
                      ("warehouse_validation", "SUCCESS"), ("warehouse_validation", "FAILED")}
    metrics = {(r.pipeline_run_key, r.dataset): r.rows_removed
               for r in spark.read.parquet(f"{tmp}/parts/ledger/run_metrics").collect()}
    assert metrics[keys["price"], "price"] == 1 and set(metrics) == {(keys["price"], "price"), (keys["rig"], "rig")}
