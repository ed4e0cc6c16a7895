import pytest
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError
from tidewatch.plans import build
from tidewatch.plans import ledger as L
from tidewatch.plans import quality as Q
from tidewatch.sources.testtables import RUN_TIME

SF = "/root/testdata/sf0.001"


def test_run_ledger_fold(spark):
    ev = (L.start_event(spark, 1, "p", "2024-01-01 00:00:00")
          .unionByName(L.finish_event(spark, 1, "p", "2024-01-01 00:00:01.5"))
          .unionByName(L.start_event(spark, 2, "p", "2024-01-02 00:00:00"))
          .unionByName(L.start_event(spark, 3, "p", "2024-01-03 00:00:00"))
          .unionByName(L.finish_event(spark, 3, "p", "2024-01-03 00:01:00", error="boom")))
    runs = {r.pipeline_run_key: r for r in L.fold_runs(ev).collect()}
    assert runs[1].status == "SUCCESS" and float(runs[1].duration_seconds) == 1.5
    assert runs[2].status == "RUNNING" and runs[2].finished_at is None
    assert runs[3].status == "FAILED" and runs[3].error_message == "boom"
    checks = L.quality_rows(spark.createDataFrame(
        [(10, 1, "a", True, "5", "e", ""), (11, 1, "b", False, "0", "e", "bad")],
        "quality_check_key long, pipeline_run_key long, check_name string, passed boolean, check_value string, "
        "expectation string, details string").withColumn("checked_at", F.lit("2024-01-01").cast("timestamp_ntz")))
    t = {"fact_pipeline_run": L.fold_runs(ev), "fact_data_quality_check": checks}
    # the latest run (3) failed and stored no checks: the view has no row, the function form one zero row
    assert L.latest_quality_summary(t).count() == 0
    tot = L.latest_quality_summary_total(t).collect()[0]
    assert (tot.total_checks, tot.passed_checks, tot.failed_checks) == (0, 0, 0)
    hist = {r.pipeline_run_key: r for r in L.pipeline_run_history(t).collect()}
    assert (hist[1].total_checks, hist[1].passed_checks, hist[1].failed_checks) == (2, 1, 1)
    assert hist[3].total_checks == 0
    assert L.latest_pipeline_run(t).collect()[0].pipeline_run_key == 3
    assert [r.check_name for r in L.latest_quality_checks(
        {**t, "fact_pipeline_run": L.fold_runs(ev.where("pipeline_run_key = 1"))}).collect()] == ["b", "a"]


def test_quality_checks_and_fault_injection(spark):
    from tidewatch.plans.serving import register_views

    t = build.warehouse(spark, SF)
    register_views(spark, t, RUN_TIME)
    checks = {r.check_name: r for r in Q.quality_checks(spark, t, RUN_TIME).collect()}
    assert len(checks) == 22
    assert checks["fact_weather_forecast row count"].passed
    assert checks["Atmospheric duplicate grain"].passed and checks["Weather asset references"].passed
    # inject faults: a duplicated fact row, a negative visibility, an unknown level, an orphan asset
    w = t["fact_weather_forecast"]
    bad_w = w.unionByName(w.limit(1)).unionByName(
        w.limit(1).withColumn("visibility_m", F.lit(-1).cast("decimal(12,3)"))
        .withColumn("asset_key", F.lit(-42).cast("long"))
        .withColumn("forecast_valid_time", F.lit("1999-01-01").cast("timestamp_ntz")))
    r = t["fact_operational_weather_risk"]
    bad_r = r.unionByName(r.limit(1).withColumn("overall_risk_level", F.lit("PURPLE"))
                          .withColumn("forecast_valid_time", F.lit("1999-01-01").cast("timestamp_ntz")))
    bad = build.Lazy({**{n: (lambda n: (lambda: t[n]))(n) for n in t},
                      "fact_weather_forecast": lambda: bad_w, "fact_operational_weather_risk": lambda: bad_r})
    got = {r.check_name: r for r in Q.quality_checks(spark, bad, RUN_TIME).collect()}
    for name in ["Atmospheric duplicate grain", "Visibility range", "Operational risk categories",
                 "Weather asset references", "Historical weather table alignment"]:
        assert not got[name].passed, name
    with pytest.raises(ContractError, match="Visibility range"):
        Q.gate(Q.quality_checks(spark, bad, RUN_TIME))
    missing = Q.quality_checks(spark, t, RUN_TIME, existing_tables=["dim_time"], existing_views=[]).collect()
    assert len(missing) == 2 and not missing[0].passed and "Missing:" in missing[0].details
    spark.catalog.dropTempView("vw_next_weather_critical_event")
    dropped = {r.check_name: r for r in Q.quality_checks(spark, t, RUN_TIME).collect()}
    views = dropped["Required analytical views"]
    assert len(dropped) == 19 and not views.passed and "vw_next_weather_critical_event" in views.details


def test_run_on_an_empty_folder_fails_check_one(spark, tmp):
    from tidewatch.plans import runs

    store = runs.WarehouseStore(spark, f"{tmp}/nothing")
    found = [n for n in Q.S.REQUIRED_TABLES if store.exists(n)]
    rows = Q.quality_checks(spark, store.tables(), RUN_TIME, found, []).collect()
    assert found == [] and len(rows) == 2 and not any(r.passed for r in rows)


def test_error_without_a_message_is_a_failure(spark):
    at = "2024-02-01 00:00:00"
    assert L.finish_event(spark, 1, "p", at, error="").first().status == "FAILED"
    assert L.finish_event(spark, 1, "p", at, error="x" * 5000).first().error_message == "x" * 5000
    assert L.finish_event(spark, 1, "p", at).first().status == "SUCCESS"
    assert len({L.issue_key() for _ in range(100)}) == 100


def test_constraint_violations_clean_on_fresh_load(spark):
    t = build.warehouse(spark, SF)
    bad = [(r.table_name, r.constraint_name) for r in Q.constraint_violations(t).collect() if r.violations]
    assert bad == []
