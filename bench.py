"""Benchmark: load the warehouse from the test tables, then time the headline
views over the stored tables.  Prints ONE JSON line on stdout.

    BENCH_SF_DIR   test-table folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_REPEAT   runs per query, median reported (default 3)
    BENCH_SHUFFLE_PARTITIONS  shuffle partitions (default: one per core; AQE
                   coalesces further)

Each query is executed in full with the ``noop`` sink (no collect to the
driver).  ``load`` is the complete Silver + star-schema load (written to a
fresh folder); ``flagship_from_raw`` is the flagship computed straight from
the raw test tables, as the correctness check runs it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
SHUFFLE = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(CPUS)))


def main() -> None:
    from tidewatch.plans import build
    from tidewatch.plans import ledger as L
    from tidewatch.plans import quality as Q
    from tidewatch.plans import runs
    from tidewatch.plans import serving as SV
    from tidewatch.plans import views_integrated as VI
    from tidewatch.plans import views_price as VP
    from tidewatch.plans import views_rig as VR
    from tidewatch.plans import views_weather as VW
    from tidewatch.plans.registry import queries
    from tidewatch.session import get_session
    from tidewatch.sources.testtables import AS_OF, RUN_TIME

    spark = get_session(
        f"local[{CPUS}]",
        app_name="tidewatch-bench",
        shuffle_partitions=SHUFFLE,
        extra_conf={"spark.driver.memory": "16g", "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024)},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("TMPDIR", "/tmp"))

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    silver = runs.write_silver_frames(spark, build.silver_frames(spark, SF_DIR, RUN_TIME), root)
    store = runs.WarehouseStore(spark, os.path.join(root, "warehouse"))
    runs.load_warehouse(spark, store, silver, RUN_TIME)
    timings["load"] = time.perf_counter() - t0

    t = store.tables(keep_partition=True)
    ledger = build.ledger_tables(spark, SF_DIR)  # run ledger from the stand-in run events
    tables = build.Lazy({**{n: (lambda n: (lambda: t[n]))(n) for n in t}, **ledger})

    SV.register_views(spark, tables, RUN_TIME)  # checks 20-22 look for the views in the catalog
    headline = {
        "offshore_risk_summary": lambda: VW.offshore_risk_summary(tables),
        "latest_offshore_forecast": lambda: VW.latest_offshore_forecast(tables),
        "asset_kpis": lambda: VW.asset_operational_kpis(tables),
        "next_critical_event": lambda: VW.next_weather_critical_event(tables, AS_OF),
        "offshore_operational_forecast": lambda: VW.offshore_operational_forecast(tables),
        "executive_snapshot": lambda: VI.executive_energy_operations(tables, RUN_TIME),
        "daily_price": lambda: VP.daily_oil_price(tables),
        "price_summary": lambda: VP.energy_price_summary(tables),
        "latest_price_by_series": lambda: VP.latest_oil_price_by_series(tables),
        "rig_monthly_change": lambda: VR.rig_count_monthly_change(tables),
        "rig_region_monthly": lambda: VR.rig_count_region_monthly(tables),
        "latest_rig_count": lambda: VR.latest_rig_count(tables),
        "asset_map": lambda: SV.asset_map(tables, AS_OF),
        "run_history": lambda: L.pipeline_run_history(tables),
        "dq_checks": lambda: Q.quality_checks(spark, tables, RUN_TIME),
    }
    for name, build_df in headline.items():
        runs_s = []
        for _ in range(REPEAT):
            s = time.perf_counter()
            run(build_df())
            runs_s.append(time.perf_counter() - s)
        timings[name] = statistics.median(runs_s)

    q = queries()
    s = time.perf_counter()
    run(q["offshore_risk_summary"](spark, SF_DIR))
    timings["flagship_from_raw"] = time.perf_counter() - s

    view_total = sum(v for k, v in timings.items() if k in headline)
    print(json.dumps({
        "metric": "headline_views_total",
        "value": round(view_total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": CPUS,
        "repeat": REPEAT,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
