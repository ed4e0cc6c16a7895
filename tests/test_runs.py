import pytest

from tidewatch.operators.contracts import ContractError
from tidewatch.plans import runs

SF = "/root/testdata/sf0.001"


def test_batch_run_gate_ledger_and_redelivery(spark, tmp):
    with pytest.raises(ContractError, match="Quality gate failed"):
        runs.run_all(spark, SF, tmp, run_time="2024-02-01 00:00:00", run_key=1)
    stored = runs.run_all(spark, SF, tmp, run_time="2024-02-02 00:00:00", run_key=2, gate=False)
    assert stored.count() == 22
    store = runs.WarehouseStore(spark, f"{tmp}/warehouse")
    w = store.read("fact_weather_forecast")
    n = w.count()
    assert n > 0 and w.select("asset_key", "forecast_reference_time", "forecast_valid_time", "source").distinct().count() == n
    assert [r[0] for r in w.select("ingestion_time").distinct().collect()][0].day == 2
    a = store.read("dim_asset").select("created_at", "updated_at").distinct().collect()
    assert [(r.created_at.day, r.updated_at.day) for r in a] == [(1, 2)]
    led = runs.read_ledger(spark, tmp)
    status = {r.pipeline_run_key: r.status for r in led["fact_pipeline_run"].collect()}
    assert status == {1: "FAILED", 2: "SUCCESS"}
    per_run = {r[0]: r[1] for r in led["fact_data_quality_check"].groupBy("pipeline_run_key").count().collect()}
    assert per_run == {1: 22, 2: 22}  # the failed run kept its checks


def test_store_append_and_truncate_reload(spark, tmp):
    store = runs.WarehouseStore(spark, f"{tmp}/wh")
    rows = spark.range(3).selectExpr("id AS pipeline_run_key", "'p' AS pipeline_name")
    store.append("fact_pipeline_run", rows)          # K06: append load
    store.append("fact_pipeline_run", rows)
    assert spark.read.parquet(store.path("fact_pipeline_run")).count() == 6
    store.replace_all({"fact_pipeline_run": rows.limit(1)})   # K11: truncate and reload
    assert spark.read.parquet(store.path("fact_pipeline_run")).count() == 1


def test_latest_views_and_touched_slices_prune_partitions(spark, tmp):
    import re

    from tidewatch.plans import build
    from tidewatch.plans import views_weather as VW

    silver = runs.write_silver_frames(spark, build.silver_frames(spark, SF), tmp)
    store = runs.WarehouseStore(spark, f"{tmp}/warehouse")
    runs.load_warehouse(spark, store, silver, "2024-02-01 00:00:00")
    t = store.tables(keep_partition=True)
    unpruned = sorted(map(tuple, VW.offshore_risk_summary(store.tables(keep_partition=False)).collect()))
    for view in (VW.offshore_risk_summary, VW.weather_run_summary):
        df = view(t)
        rows = sorted(map(tuple, df.collect()))
        assert re.search(r"PartitionFilters: \[[^\]]*run_date#\d+ (>=|=) Subquery", df._jdf.queryExecution().executedPlan().toString())
        if view is VW.offshore_risk_summary:
            assert rows == unpruned
    touched = store.touched_slice("fact_rig_count", spark.createDataFrame([("1998-01",), ("1995-03",)], "rig_month string"))
    assert re.search(r"PartitionFilters: \[[^\]]*rig_month#\d+ >= Subquery", touched._jdf.queryExecution().executedPlan().toString())


def test_staged_copies_are_removed_after_publish(spark, tmp):
    import glob

    from tidewatch.session import checkpoint_dir

    store = runs.WarehouseStore(spark, f"{tmp}/wh")
    rows = spark.range(3).selectExpr("id AS pipeline_run_key", "'p' AS pipeline_name")
    store.append("fact_pipeline_run", rows)
    before = set(glob.glob(f"{checkpoint_dir(spark)}/stage-*"))
    store.replace_all({"fact_pipeline_run": rows.limit(2)})
    assert set(glob.glob(f"{checkpoint_dir(spark)}/stage-*")) <= before
    assert spark.read.parquet(store.path("fact_pipeline_run")).count() == 2
