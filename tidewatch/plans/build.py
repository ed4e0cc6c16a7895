"""Assemble the Silver frames and the star schema from the test tables.

``silver_frames`` runs the Silver jobs on the stand-in inputs; ``warehouse``
loads every dimension and fact from them as a first load (empty targets)
and returns the tables as lazy DataFrames.  The batch run in
``tidewatch.plans.runs`` uses the same functions and writes the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.dedupe import keep_last
from tidewatch.plans import ledger as L
from tidewatch.plans import warehouse as W
from tidewatch.plans.risk import operational_risk
from tidewatch.plans.silver import silver_atmospheric, silver_marine, silver_price, silver_rig
from tidewatch.sources import bronze
from tidewatch.sources import testtables as TT


def asset_limits(registry: DataFrame) -> DataFrame:
    """One row of limits per asset (the lenient registry read, S01)."""
    return keep_last(bronze.clean_asset_registry(registry), ["asset_id"], ["registry_row"])


class Lazy(Mapping):
    """Read-only mapping whose values are built on first access and kept.

    Queries touch only a few tables; building a DataFrame runs Spark's
    analyzer, so nothing is built that a query does not read.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __contains__(self, name: object) -> bool:
        return name in self._builders

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def silver_frames(spark: SparkSession, sf_dir: str, run_time: str = TT.RUN_TIME) -> Lazy:
    """The Silver frames of the stand-in inputs, built lazily."""
    f: Lazy

    def risk() -> DataFrame:
        # one Silver job's output: unique per (asset, run, hour), one source
        return operational_risk(f["atmospheric"], f["marine"], asset_limits(f["registry"]), unique_hours=True)

    f = Lazy({
        "registry": lambda: TT.asset_registry(spark, sf_dir),
        "atmospheric": lambda: silver_atmospheric(TT.atmospheric_hours(spark, sf_dir)),
        "marine": lambda: silver_marine(TT.marine_hours(spark, sf_dir)),
        "risk": risk,
        "price": lambda: silver_price(TT.price_records(spark, sf_dir)),
        "rig": lambda: silver_rig(TT.rig_sheet_rows(spark, sf_dir), run_time),
    })
    return f


def warehouse_from_silver(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    run_time: str = TT.RUN_TIME,
    validate: bool = False,
    current: Mapping[str, DataFrame] | None = None,
    from_silver_jobs: bool = True,
) -> Lazy:
    """Load every dimension and fact; ``current`` holds existing tables (else empty).

    ``from_silver_jobs`` says the Silver frames come straight from the
    Silver jobs (not re-read from storage), so their keys are unique and
    the fact loads' keep-last steps are skipped.
    """
    cur = dict(current or {})

    def target(name: str) -> DataFrame:
        return cur[name] if name in cur else W.empty_table(spark, name)

    t: Lazy

    def registry() -> DataFrame:
        return bronze.strict_asset_registry(silver["registry"])

    def stamps() -> DataFrame:
        # the risk hours are among the atmospheric ones; the key of the price
        # fact holds the timestamp, so its keep-last cannot remove one. Hours are made
        # distinct per frame: Spark then leaves out the shuffle of their whole keys
        frames = [silver[n].select(F.col("forecast_valid_time").alias("timestamp")).distinct()
                  for n in ("atmospheric", "marine") if n in silver]
        if "price" in silver:
            frames.append(W.price_fact_input(silver["price"], deduplicated=True).select("timestamp"))
        if "rig" in silver:
            frames.append(silver["rig"].select(F.col("observation_date").alias("timestamp")))
        return reduce(DataFrame.unionByName, frames)

    def check(name: str) -> DataFrame | None:
        return t[name] if validate else None

    def forecast(table: str, frame: str) -> Callable[[], DataFrame]:
        return lambda: W.load_forecast_fact(
            target(table), silver[frame], table, run_time, check("dim_asset"), check("dim_time")
        )

    t = Lazy({
        "dim_location": lambda: W.load_dim_location(target("dim_location"), registry(), run_time),
        "dim_asset": lambda: W.load_dim_asset(target("dim_asset"), registry(), t["dim_location"], run_time),
        "dim_time": lambda: W.load_dim_time(target("dim_time"), stamps(), run_time),
        "dim_energy_product": lambda: W.load_dim_energy_product(target("dim_energy_product"), silver["price"], run_time),
        "dim_country": lambda: W.load_dim_country(target("dim_country"), silver["rig"], run_time),
        "dim_rig_classification": lambda: W.load_dim_rig_classification(
            target("dim_rig_classification"), silver["rig"], run_time),
        "fact_weather_forecast": forecast("fact_weather_forecast", "atmospheric"),
        "fact_marine_forecast": forecast("fact_marine_forecast", "marine"),
        "fact_operational_weather_risk": forecast("fact_operational_weather_risk", "risk"),
        "fact_oil_price": lambda: W.load_fact_oil_price(
            target("fact_oil_price"), silver["price"], run_time,
            check("dim_energy_product"), check("dim_time"), deduplicated=from_silver_jobs),
        "fact_rig_count": lambda: W.load_fact_rig_count(
            target("fact_rig_count"), silver["rig"], run_time,
            check("dim_country"), check("dim_rig_classification"), check("dim_time"),
            deduplicated=from_silver_jobs),
    })
    return t


def ledger_tables(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """Run ledger and stored checks folded from the stand-in run events."""
    return {
        "fact_pipeline_run": lambda: L.fold_runs(TT.run_ledger_events(spark, sf_dir)),
        "fact_data_quality_check": lambda: L.quality_rows(TT.quality_check_rows(spark, sf_dir)),
    }


def warehouse(
    spark: SparkSession, sf_dir: str, run_time: str = TT.RUN_TIME, validate: bool = False
) -> Lazy:
    """Every warehouse table, first load from the test tables, as lazy frames."""
    t = warehouse_from_silver(spark, silver_frames(spark, sf_dir, run_time), run_time, validate)
    builders = {name: (lambda n: (lambda: t[n]))(name) for name in t}
    builders.update(ledger_tables(spark, sf_dir))
    return Lazy(builders)
