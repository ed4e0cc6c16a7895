"""Enforced constraints, key contracts counted by the load, recovery of a cut-off publish, latest runs."""

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError
from tidewatch.plans import build, constraints, runs
from tidewatch.plans import views_weather as VW

SF = "/root/testdata/sf0.001"
AT = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    return runs.write_silver_frames(spark, build.silver_frames(spark, SF), str(tmp_path_factory.mktemp("silver")))


def changed(silver, **frames):
    return build.Lazy({n: (lambda n: (lambda: frames[n] if n in frames else silver[n]))(n) for n in silver})


KEYS = {"registry": ["asset_id"], "price": ["timestamp", "series"],
        "rig": ["observation_date", "region", "country", "drilling_target", "location_type"]}


@pytest.mark.parametrize("frame, column, value, table, constraint", [
    ("price", "series", "repeat('x', 151)", "fact_oil_price", r"series_length \(1 rows\)"),
    ("registry", "asset_name", "CAST(NULL AS STRING)", "dim_asset", r"asset_name_not_null \(1 rows\)"),
    ("risk", "overall_risk_level", "'PURPLE'", "fact_operational_weather_risk", r"overall_risk_level_domain \(1 rows\)"),
    ("atmospheric", "relative_humidity_pct", "101.0D", "fact_weather_forecast", r"humidity_range \(1 rows\)"),
    ("rig", "source_file", "CAST(NULL AS STRING)", "fact_rig_count", r"source_file_not_null \(1 rows\)"),
])
def test_a_broken_constraint_stops_the_load_before_publish(spark, silver, tmp, frame, column, value, table, constraint):
    store = runs.WarehouseStore(spark, f"{tmp}/wh")
    rows = silver[frame]
    keys = KEYS.get(frame, ["asset_id", "forecast_reference_time", "forecast_valid_time"])
    first = rows.orderBy(*keys).first()
    this = F.lit(True)
    for k in keys:
        this = this & (F.col(k) == F.lit(first[k]))
    bad = rows.withColumn(column, F.when(this, F.expr(value)).otherwise(F.col(column)))
    subject = next((names for names in runs.SUBJECTS.values() if frame in names), runs.SUBJECTS["weather"])
    part = changed({n: silver[n] for n in (*subject, "risk") if n in subject or "registry" in subject}, **{frame: bad})
    with pytest.raises(ContractError, match=f"{table}: constraints broken: .*{constraint}"):
        runs.load_warehouse(spark, store, part, AT)
    assert not store.exists(table)
    if frame == "price":
        runs.load_warehouse(spark, store, changed({"price": rows}), AT)
        assert store.read(table).count() > 0 and constraints.row_violations(store.read(table), table).where("violations > 0").isEmpty()


def test_unresolved_keys_are_counted_by_the_load_and_named(spark, silver, tmp):
    store = runs.WarehouseStore(spark, f"{tmp}/wh")
    some = silver["atmospheric"].limit(2).withColumn("asset_id", F.lit("nowhere"))
    bad = silver["atmospheric"].unionByName(some.dropDuplicates(["asset_id", "forecast_reference_time", "forecast_valid_time"]))
    with pytest.raises(ContractError, match="asset_key not found for: nowhere"):
        runs.load_warehouse(spark, store, changed(silver, atmospheric=bad), AT)
    assert store.exists("dim_asset") and not store.exists("fact_weather_forecast") and not store.exists("agg_latest_run")


def test_a_publish_cut_off_between_tables_is_finished(spark, silver, tmp, monkeypatch):
    store = runs.WarehouseStore(spark, f"{tmp}/wh")
    whole = runs.WarehouseStore(spark, f"{tmp}/whole")
    runs.load_warehouse(spark, whole, silver, AT)
    publish, seen = runs.WarehouseStore.publish, []

    def cut_off(self, batch, name):
        seen.append(name)
        if name == "fact_marine_forecast":
            raise KeyboardInterrupt
        publish(self, batch, name)

    monkeypatch.setattr(runs.WarehouseStore, "publish", cut_off)
    with pytest.raises(KeyboardInterrupt):
        runs.load_warehouse(spark, store, silver, AT)
    monkeypatch.undo()
    assert store.exists("fact_weather_forecast") and not store.exists("fact_marine_forecast")
    assert set(store.recover()) >= {"fact_marine_forecast", "fact_oil_price", "agg_latest_run"}
    for table in [*runs.S.REQUIRED_TABLES, "agg_latest_run"]:
        assert sorted(map(str, store.read(table).collect())) == sorted(map(str, whole.read(table).collect())), table
    assert store.recover() == []


def test_a_load_that_was_not_staged_whole_is_discarded(spark, silver, tmp, monkeypatch):
    store = runs.WarehouseStore(spark, f"{tmp}/wh")
    rows = spark.range(3).selectExpr("id AS asset_key", "timestamp_ntz'2024-01-01' AS forecast_reference_time")
    store.replace_all({"agg_latest_run": rows})
    store.stage("agg_latest_run", rows.limit(1), "cut-off")
    assert store.recover() == [] and store.read("agg_latest_run").count() == 3
    assert not runs.files.exists(spark, store.path("staging/cut-off"))


def test_latest_runs_are_merged_and_views_scan_no_history(spark, silver, tmp):
    store = runs.WarehouseStore(spark, f"{tmp}/wh")
    cut = silver["atmospheric"].agg(F.expr("percentile_approx(forecast_reference_time, 0.5)")).first()[0]
    for part in (F.col("forecast_reference_time") > cut, F.col("forecast_reference_time") <= cut):
        runs.load_warehouse(spark, store, changed(silver, **{n: silver[n].where(part) for n in ("atmospheric", "marine", "risk")}), AT)
    t = store.tables()
    plain = build.Lazy({n: (lambda n: (lambda: t[n]))(n) for n in t if n != "agg_latest_run"})
    assert sorted(map(tuple, VW.latest_runs(t).collect())) == sorted(map(tuple, VW.latest_runs(plain).collect()))
    assert sorted(map(tuple, VW.offshore_risk_summary(t).collect())) == sorted(map(tuple, VW.offshore_risk_summary(plain).collect()))
    plan = VW.offshore_risk_summary(t)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation [" in line and "weather_forecast_key" in line]
    assert len(scans) <= 1


def test_partition_counters_equal_a_full_count(spark, silver, tmp):
    from tidewatch.plans import quality as Q

    store = runs.WarehouseStore(spark, f"{tmp}/wh")
    cut = silver["atmospheric"].agg(F.expr("percentile_approx(forecast_reference_time, 0.5)")).first()[0]
    late = F.col("forecast_reference_time") > cut

    def batch(part):
        return changed(silver, **{n: silver[n].where(part) for n in ("atmospheric", "marine", "risk")})

    def same():
        t = store.tables()
        plain = build.Lazy({n: (lambda n: (lambda: t[n]))(n) for n in t if n != "agg_fact_partition"})
        kept, counted = (sorted(map(str, Q.gather(Q.table_metrics(x)).collect()[0].asDict().items())) for x in (t, plain))
        assert kept == counted

    runs.load_warehouse(spark, store, batch(late), AT)
    same()
    runs.load_warehouse(spark, store, batch(~late), AT)
    same()
    runs.files.delete(spark, store.path("agg_fact_partition"))  # as in a warehouse of an earlier version
    runs.load_warehouse(spark, store, batch(late), AT)
    same()
    # duplicates and broken rules that a full count finds are found in the counters too
    weather = store.read("fact_weather_forecast", keep_partition=True)
    hurt = weather.unionByName(weather.limit(3)).withColumn("visibility_m", -F.abs("visibility_m") - 1)
    counters = Q.partition_counters(hurt, "fact_weather_forecast", "run_date").agg(F.sum("duplicates"), F.sum("visibility"), F.sum("n")).first()
    assert tuple(counters) == (3, hurt.where("visibility_m < 0").count(), hurt.count())
