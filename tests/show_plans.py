"""Print the final (post-AQE) physical plans of a few headline queries over
a stored warehouse, as recorded in docs/PLANS.md."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(sf_dir: str) -> None:
    from tidewatch.plans import build, runs
    from tidewatch.plans import views_price as VP
    from tidewatch.plans import views_weather as VW
    from tidewatch.operators.dedupe import keep_last
    from tidewatch.session import get_session
    from tidewatch.sources import testtables as TT

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="plans-")
    silver = runs.write_silver_frames(spark, build.silver_frames(spark, sf_dir), root)
    store = runs.WarehouseStore(spark, os.path.join(root, "warehouse"))
    runs.load_warehouse(spark, store, silver, TT.RUN_TIME)
    t = store.tables(keep_partition=True)
    parts = runs.batch_partitions(silver)
    cases = {
        "offshore_risk_summary (flagship, stored warehouse)": VW.offshore_risk_summary(t),
        "daily_price (stored warehouse)": VP.daily_oil_price(t),
        "touched slice of fact_weather_forecast for a batch (upsert input)":
            store.touched_slice("fact_weather_forecast", parts["fact_weather_forecast"]),
        "keep_last of the price records (Silver price dedupe)":
            keep_last(TT.price_records(spark, sf_dir), ["period", "series"], ["record_order"]),
    }
    for title, df in cases.items():
        df.collect()  # runs this Dataset's own execution, so the plan below is final
        print(f"### {title}\n\n```")
        print(df._jdf.queryExecution().executedPlan().toString())
        print("```\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
