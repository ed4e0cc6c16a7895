"""Plan properties: no Python UDFs, scans pruned, one-row broadcasts, entry contract."""

import os
import re

import __spark_entry__ as E
from tidewatch.plans import build
from tidewatch.plans import views_weather as VW

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_registered_query(spark):
    q = E.queries()
    for name in ["offshore_risk_summary", "silver_price", "silver_rig", "dq_checks", "executive_snapshot",
                 "serve_price_kpis", "rig_monthly_change"]:
        plan = plan_of(q[name](spark, SF))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_scans_read_only_needed_columns(spark):
    df = VW.offshore_risk_summary(build.warehouse(spark, SF))
    read = set(re.findall(r"FileScan parquet \[([^\]]*)\].*?ReadSchema", plan_of(df)))
    columns = {c.split("#")[0] for scan in read for c in scan.split(",")}
    # names, texts and measures that the view doesn't show are never read
    assert columns and columns.isdisjoint({"c_phone", "c_acctbal", "n_comment", "r_comment", "l_comment", "text"}), columns


def test_entry_and_oracle_keys(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) >= {"asset_id", "forecast_date", "green_hours", "red_hours"}
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    missing = sorted(set(q) - set(o))
    # the subpackage's trained, hashed or tokenised results have no SQL form
    assert all(n.startswith("op") or n == "pipeline" for n in missing), missing


def test_views_register_as_temp_views(spark):
    from tidewatch.plans.serving import register_views

    register_views(spark, build.warehouse(spark, SF), "2024-01-29 12:00:00")
    n = spark.sql("SELECT COUNT(*) AS n FROM vw_offshore_risk_summary").collect()[0].n
    assert n == E.entry(spark).count()
    assert spark.catalog.tableExists("vw_latest_rig_count")


def test_oracle_date_columns_match_query_schemas(spark):
    from pyspark.sql import types as T

    from tidewatch.oracle import DATE_COLUMNS
    from tidewatch.plans.registry import QUERIES

    for name, fn in QUERIES.items():
        cols = [f.name for f in fn(spark, SF).schema.fields if isinstance(f.dataType, T.DateType)]
        assert cols == DATE_COLUMNS.get(name, []), name
