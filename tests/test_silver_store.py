"""Stored Silver: read contract, order of files, sheet header, newest slices."""

import json
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.test_sources import asset, doc, write
from tidewatch.operators.contracts import ContractError
from tidewatch.plans import build, runs, views_price as VP, views_rig as VR, views_weather as VW
from tidewatch.plans.silver import silver_atmospheric, silver_price, silver_rig
from tidewatch.sources import bronze, testtables as TT

SF = "/root/testdata/sf0.001"


def test_silver_contract_names_columns_and_stops_at_empty_tables(spark, tmp):
    rows = spark.createDataFrame([(" A0 ", "2024-01-01T00:00", "2024-01-01T01:00"), ("A1", "never", "2024-01-01T01:00"),
                                  (None, "2024-01-01T00:00", "2024-01-01T01:00")],
                                 "asset_id string, forecast_reference_time string, forecast_valid_time string")
    bronze.write_silver(rows, f"{tmp}/ok", ["asset_id"])
    read = bronze.read_silver(spark, f"{tmp}/ok", "atmospheric").collect()
    assert [(r.asset_id, str(r.forecast_valid_time)) for r in read] == [("A0", "2024-01-01 01:00:00")]
    bronze.write_silver(rows.where("asset_id = 'A1'"), f"{tmp}/invalid")
    with pytest.raises(ContractError, match="no valid rows"):
        bronze.read_silver(spark, f"{tmp}/invalid", "atmospheric")
    bronze.write_silver(rows.limit(0), f"{tmp}/empty")
    with pytest.raises(ContractError, match="is empty"):
        bronze.read_silver(spark, f"{tmp}/empty", "atmospheric")
    with pytest.raises(ContractError, match="forecast_valid_time"):
        bronze.silver_contract(rows.drop("forecast_valid_time"), bronze.SILVER_CONTRACTS["marine"], "marine Silver")


def test_silver_files_do_not_overlap(spark, tmp):
    rows = spark.range(40_000).selectExpr("concat('A', lpad(cast(id % 400 AS string), 3, '0')) AS asset_id",
                                          "timestamp_ntz'2024-01-01' + make_dt_interval(0, id % 100) AS forecast_valid_time")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a few MB would become one file
    seen = bronze.write_silver(rows, f"{tmp}/s", ["asset_id", "forecast_valid_time"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert seen.get["rows"] == 40_000
    ranges = spark.read.parquet(f"{tmp}/s").groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("asset_id", "forecast_valid_time")).alias("low"), F.max(F.struct("asset_id", "forecast_valid_time")).alias("high")).collect()
    ranges.sort(key=lambda r: tuple(r.low))
    assert len(ranges) > 1 and all(tuple(a.high) < tuple(b.low) for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("title", ["Rig Count Value by country and month", '"Rigs, Rig Count Value, by month",x', "about Rig Count Value,,"])
def test_sheet_title_that_names_the_value_column(spark, tmp, title):
    head = 'Region,Country,DrillFor,Location,"Rig Status",Year,Month, "Rig Count Value" ,Note'
    write(f"{tmp}/s.csv", "\n".join(["preamble", title, *[""] * 9, head, "Middle East,UAE,Oil,Offshore,Active,2024,1,12,n"]) + "\n")
    rows = bronze.read_rig_sheet(spark, f"{tmp}/s.csv").where("Year = '2024'").collect()
    assert [(r.Country, r["Rig Count Value"]) for r in rows] == [("UAE", "12")]


def test_latest_summaries_read_the_newest_partition_only(spark, tmp):
    silver = runs.write_silver_frames(spark, build.silver_frames(spark, SF), tmp)
    store = runs.WarehouseStore(spark, f"{tmp}/warehouse")
    runs.load_warehouse(spark, store, silver, "2024-02-01 00:00:00")
    for view, part in ((VP.latest_price_summary, "price_month"), (VR.latest_rig_summary, "rig_month")):
        df = view(store.tables())
        assert list(map(tuple, df.collect())) == list(map(tuple, view(store.tables(keep_partition=False)).collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"PartitionFilters: \[[^\]]*{part}#\d+ = Subquery", plan)


def test_a_landed_document_is_parsed_by_many_tasks(spark, tmp):
    import json

    times = ["2024-01-01T08:00", "2024-01-01T09:00"]
    entries = [asset(i, times) for i in range(2_000)]
    write(f"{tmp}/f.json", doc(entries, ingestion="2024-01-01T07:30:00Z"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a few MB would become one file
    folder = bronze.land_entries(spark, f"{tmp}/f.json", f"{tmp}/bronze", "assets", "2024-01-01 12:00:00")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert "ingest_date=2024-01-01" in folder
    lines = bronze.read_landed(spark, folder)
    assert lines.rdd.getNumPartitions() > 1 and lines.count() == 2_000
    rows, watches = bronze.landed_forecast_hours(lines, "atmospheric_forecast", bronze.ATMOSPHERIC_ARRAYS)
    rows.write.format("noop").mode("overwrite").save()
    for watch in watches:
        watch.check()
    plain = bronze.read_forecast_hours(spark, f"{tmp}/f.json", "atmospheric_forecast", bronze.ATMOSPHERIC_ARRAYS)
    assert rows.columns == plain.columns and rows.exceptAll(plain).isEmpty() and rows.count() == plain.count()
    rows, watches = bronze.landed_forecast_hours(lines, "marine_forecast", bronze.ATMOSPHERIC_ARRAYS)
    rows.write.format("noop").mode("overwrite").save()
    with pytest.raises(ContractError, match="expected dataset 'marine_forecast'"):
        watches[0].check()
    records = [{"period": "2024-01-02", "product": "P", "value": str(i), "series": f"S{i}"} for i in range(300)]
    write(f"{tmp}/p.json", json.dumps({"response": {"data": records}}))
    folder = bronze.land_entries(spark, f"{tmp}/p.json", f"{tmp}/bronze", "response.data", "2024-01-01 12:00:00")
    landed, read = bronze.landed_price_records(bronze.read_landed(spark, folder)), bronze.read_price_records(spark, f"{tmp}/p.json")
    assert landed.columns == read.columns and landed.exceptAll(read).isEmpty() and landed.count() == 300
    write(f"{tmp}/none.json", json.dumps({"response": {"data": []}}))
    folder = bronze.land_entries(spark, f"{tmp}/none.json", f"{tmp}/bronze", "response.data", "2024-01-01 12:00:00")
    with pytest.raises(ContractError, match="no records"):
        bronze.landed_price_records(bronze.read_landed(spark, folder))


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rig_sheet_texts_are_cleaned_per_sheet_row_not_per_order(spark):
    plan = silver_rig(TT.rig_sheet_rows(spark, SF), TT.RUN_TIME)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "o_orderdate" in line]
    assert len(scans) == 1 and "RLIKE" not in scans[0] and "make_date" not in scans[0]


def test_silver_tables_are_built_once_for_all_their_uses_in_a_view(spark):
    plan = _final_plan(E.queries()["price_history"](spark, SF))
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    for column in ("l_shipdate", "o_orderdate"):
        assert len(re.findall(rf"FileScan parquet \[[^\]]*{column}", final)) == 1, column


def test_silver_price_keeps_the_last_valid_record_of_differently_spelt_keys(spark):
    rows = [
        ("2024-01-01", "P", "Oil", 1.0, "S", "$", 1),
        (" 2024-01-01", "P ", "Oil", 2.0, "S ", "$", 2),  # the same key, spelt otherwise
        ("2024-01-01", "P", "Oil", -3.0, "S", "$", 3),  # no price: must not hide an earlier record
        ("2024-01-01", "P", None, 4.0, "S", "$", 4),
        ("2024-01-01", "P", "Oil", float("nan"), "S", "$", 5),
        ("no day", "P", "Oil", 6.0, "S", "$", 6),
        ("2024-01-02", "P", "Oil", 7.0, "S", None, 7),
        ("2024-01-02", "P", "Oil", 8.0, "S", "$", 0),
    ]
    df = spark.createDataFrame(
        rows, "period string, product string, `product-name` string, value double, series string, units string, record_order int")
    got = sorted((str(r.timestamp)[:10], r.product_code, r.series, r.price_usd, r.record_order) for r in silver_price(df).collect())
    assert got == [("2024-01-01", "P", "S", 2.0, 2), ("2024-01-02", "P", "S", 8.0, 0)]


def test_landed_lines_are_parsed_once_whatever_reads_their_fields(spark):
    landed = spark.createDataFrame([("prices", "2024-01-01", "f", None, 0, json.dumps(
        {"period": "2024-01-01", "product": "P", "product-name": "Oil", "value": "1.5", "series": "S", "units": "$"}))], bronze.LANDED)
    found = silver_price(bronze.landed_price_records(landed))
    assert [(r.product_code, r.price_usd, r.unit) for r in found.collect()] == [("P", 1.5, "$")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("JsonToStructs") == 1


def test_forecast_times_and_numbers_are_read_without_redundant_conditions(spark):
    names = ["asset_id", "forecast_reference_time", "forecast_valid_time", *bronze.ATMOSPHERIC_ARRAYS,
             "location_id", "latitude", "longitude", "source_file", "record_order"]
    values = ["A", "2024-01-01T00:00Z", "2024-01-01T05:00+02:00", *["1.5"] * 8, "NaN", None, "12d", "inf", "f", "1"]
    found = silver_atmospheric(spark.createDataFrame([tuple(values), (*values[:2], "never", *values[3:])],
                                                     ", ".join(f"`{n}` string" for n in names)))
    rows = found.collect()
    assert [(r.forecast_horizon_hours, r.temperature_c, r.weather_code, r.latitude, r.longitude) for r in rows] == [
        (3, 1.5, None, None, float("inf"))]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "isnan" not in plan.lower()
    assert not any("floor" in line.lower() for line in plan.splitlines() if "Filter" in line)


def test_hours_of_the_time_dimension_do_not_shuffle_whole_forecast_keys(spark):
    plan = build.warehouse(spark, SF)["dim_time"]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(timestamp" in plan and "hashpartitioning(asset_id" not in plan
    hours = build.silver_frames(spark, SF)["atmospheric"]
    assert hours.count() == hours.select("asset_id", "forecast_reference_time", "forecast_valid_time", "source").distinct().count()


def test_latest_global_run_limits_the_hours_that_are_rated(spark):
    t = build.warehouse(spark, SF)
    run = VW.latest_global_run(t)
    plan = run._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"date_trunc\(week(?:(?!date_trunc).)*= scalar-subquery", plan)
    risk = t["fact_operational_weather_risk"]
    newest = risk.agg(F.max("forecast_reference_time")).first()[0]
    expected = risk.where(F.col("forecast_reference_time") == F.lit(newest)).select(run.columns)
    assert run.columns[0] == "forecast_reference_time" and run.count() == expected.count() > 0
    assert run.exceptAll(expected).isEmpty()
