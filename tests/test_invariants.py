"""Invariants of the views on the smallest test tables."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewatch.plans import build
from tidewatch.plans import views_weather as VW

SF = "/root/testdata/sf0.001"


def test_hours_by_level_sum_to_total(spark):
    t = build.warehouse(spark, SF)
    for df in (VW.offshore_risk_summary(t), VW.asset_operational_kpis(t), VW.weather_run_summary(t)):
        bad = df.where(F.col("green_hours") + F.col("amber_hours") + F.col("red_hours") + F.col("unknown_hours")
                       != F.col("forecast_hours")).count()
        assert bad == 0


def test_latest_is_subset_of_history(spark):
    t = build.warehouse(spark, SF)
    latest = VW.latest_offshore_forecast(t)
    history = VW.offshore_operational_forecast(t)
    assert latest.exceptAll(history).count() == 0
    runs = latest.groupBy("asset_id").agg(F.countDistinct("forecast_reference_time").alias("n"))
    assert runs.where("n <> 1").count() == 0


def test_no_window_without_partition_by(spark):
    q = E.queries()
    empty_partition = re.compile(r"Window \[[^\]]*\], \[\]")
    names = ["rig_monthly_change", "latest_rig_count", "latest_price_by_product", "latest_price_by_series",
             "next_critical_event", "serve_current_conditions", "asset_map", "silver_price", "silver_rig",
             "operational_risk", "dim_product_rows", "dim_country_rows", "latest_pipeline_run"]
    for name in names:
        fn = q[name]
        plan = fn(spark, SF)._jdf.queryExecution().sparkPlan().toString()
        assert not empty_partition.search(plan), name
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan, name
