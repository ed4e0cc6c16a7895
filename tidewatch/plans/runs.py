"""The batch runs: Silver -> star schema -> quality gate -> run ledger (§3.1).

The complete run loads every subject and checks the warehouse. The weather,
price and rig runs load one subject into the same warehouse, and the
validation run only checks what is stored; each is recorded in the ledger.

Storage is plain Parquet under a root folder.  A load computes the next
state of each table with the ``upsert`` family, stages all of them beside the
tables, and publishes them together by moving folders:

* the declared constraints (K05) and the key contracts (J07) are counted by the
  writes that stage the tables; a violation stops the load before anything is
  published;
* a marker says that every table of a load is staged. A load cut off after it
  is finished by the next one (``recover``); one cut off before it is discarded.
  One load at a time may run on a warehouse, as its read-then-replace needs anyway;

* forecast facts are partitioned by ``run_date`` (date of the forecast
  run).  Their grain contains the run time, so a batch only touches its
  own runs' partitions: only the current rows of those partitions are read
  (scalar subqueries on the partition column prune the rest at run time),
  upserted with the batch and staged (a table being read cannot be
  overwritten), and only their folders are replaced;
* price and rig facts are partitioned by month the same way, so a batch
  rewrites only its months;
* dimensions are small and rewritten whole through the same staging.

Every stage reads what the previous stage wrote, so an executor lost in a
late stage never forces a recomputation from the raw inputs.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidewatch import schemas as S
from tidewatch.operators.contracts import Watch, require_non_empty
from tidewatch.operators.metrics import observe_rows, rows_removed
from tidewatch.operators.upsert import empty_like
from tidewatch.plans import build
from tidewatch.plans import constraints as C
from tidewatch.plans import ledger as L
from tidewatch.plans import quality as Q
from tidewatch.plans import silver as SIL
from tidewatch.plans import warehouse as W
from tidewatch.plans.serving import register_ledger_views, register_views
from tidewatch.session import checkpoint_dir
from tidewatch.sources import bronze, files
from tidewatch.sources import testtables as TT

# table -> (partition column, expression on the table, clustering columns
# within files).  Every partition expression is a function of the table's
# grain, so a row can never move between partitions on update.
LAYOUT = {
    "fact_weather_forecast": ("run_date", lambda: F.to_date("forecast_reference_time"), ["asset_key", "forecast_valid_time"]),
    "fact_marine_forecast": ("run_date", lambda: F.to_date("forecast_reference_time"), ["asset_key", "forecast_valid_time"]),
    "fact_operational_weather_risk": ("run_date", lambda: F.to_date("forecast_reference_time"), ["asset_key", "forecast_valid_time"]),
    "fact_oil_price": ("price_month", lambda: F.date_format("source_timestamp", "yyyy-MM"), ["product_key", "source_timestamp"]),
    "fact_rig_count": ("rig_month", None, ["country_key", "time_key"]),  # month of its hour in dim_time
}
SILVER_SORT = {
    "atmospheric": ["asset_id", "forecast_valid_time"],
    "marine": ["asset_id", "forecast_valid_time"],
    "risk": ["asset_id", "forecast_valid_time"],
    "price": ["timestamp", "series"],
    "rig": ["observation_date", "region", "country", "drilling_target", "location_type"],
    "registry": ["registry_row"],
}


# The Silver frame each table is loaded from (dim_time: all of them).
DIM_INPUT = {"dim_location": "registry", "dim_asset": "registry", "dim_time": None, "dim_energy_product": "price",
             "dim_country": "rig", "dim_rig_classification": "rig"}
FACT_INPUT = {"fact_weather_forecast": "atmospheric", "fact_marine_forecast": "marine",
              "fact_operational_weather_risk": "risk", "fact_oil_price": "price", "fact_rig_count": "rig"}
SUBJECTS = {"weather": ["registry", "atmospheric", "marine"], "price": ["price"], "rig": ["rig"]}
METRICS_SCHEMA = "pipeline_run_key long, dataset string, rows_in long, rows_out long, rows_removed long"


READY = "_READY"  # marker in a load's staging folder: every table is staged and checked


class WarehouseStore:
    """Parquet tables under ``root``, one folder per table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def exists(self, name: str) -> bool:
        """Whether the table was written; any other read error is raised."""
        try:
            self.spark.read.parquet(self.path(name)).schema
            return True
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                return False
            raise

    def read(self, name: str, keep_partition: bool = False) -> DataFrame:
        """The stored table, or an empty one; the layout column only if asked."""
        schema = {**S.TABLES, **S.DERIVED}[name][0]
        if not self.exists(name):
            return empty_like(self.spark, schema)
        df = self.spark.read.parquet(self.path(name))
        cols = [f.name for f in schema.fields]
        if keep_partition and name in LAYOUT:
            cols.append(LAYOUT[name][0])
        return df.select(*cols)

    def tables(self, keep_partition: bool = True) -> build.Lazy:
        names = [*S.TABLES, *(n for n in S.DERIVED if self.exists(n))]
        return build.Lazy({n: (lambda n: (lambda: self.read(n, keep_partition)))(n) for n in names})

    def latest_runs(self) -> DataFrame:
        """Each asset's latest run; of a warehouse loaded before the table was kept, from its fact."""
        name = "agg_latest_run" if self.exists("agg_latest_run") else "fact_weather_forecast"
        return self.read(name).select("asset_key", "forecast_reference_time")

    def touched_slice(self, name: str, parts: DataFrame) -> DataFrame:
        """Current rows of the partitions listed in ``parts`` (one column named
        like the partition column).

        The batch's smallest and largest value are scalar subqueries on the
        partition column, so Spark lists only the partitions between them at
        run time; the semi-join then keeps exactly the touched ones.
        """
        if not self.exists(name):
            return empty_like(self.spark, S.TABLES[name][0])
        current = self.read(name, keep_partition=True)
        col = LAYOUT[name][0]
        low, high = parts.agg(F.min(col)).scalar(), parts.agg(F.max(col)).scalar()
        near = current.where((F.col(col) >= low) & (F.col(col) <= high))
        return near.join(parts.distinct(), on=col, how="left_semi").drop(col)

    def _laid_out(self, name: str, df: DataFrame) -> DataFrame:
        """With the partition column, range partitioned and sorted: one run can
        be a third of the data, so a partition value is split over many tasks."""
        col, expr, cluster = LAYOUT[name]
        if expr is not None:
            df = df.withColumn(col, expr())
        else:
            months = self.read("dim_time").select("time_key", F.date_format("timestamp", "yyyy-MM").alias(col))
            df = df.join(months, on="time_key", how="left")
        return df.repartitionByRange(col, *cluster).sortWithinPartitions(col, *cluster)

    def stage(self, name: str, df: DataFrame, batch: str) -> None:
        """Write the next state of a table (or of its touched partitions) beside the
        tables; nothing visible changes yet. Constraints are counted by the write."""
        if name in LAYOUT:
            df = self._laid_out(name, df)
        df, seen = C.watched(df, name)
        writer = df.write.mode("overwrite")
        if name in LAYOUT:
            writer = writer.partitionBy(LAYOUT[name][0])
        writer.parquet(self._staged(batch, name))
        if seen is not None:
            C.require_kept(name, seen.get)

    def _staged(self, batch: str, name: str = "") -> str:
        return os.path.join(self.path("staging"), batch, name)

    def publish(self, batch: str, name: str) -> None:
        """Move a staged table, or its touched partitions, to its place. Folders that
        were moved are gone from the staging, so a repeated call does the rest."""
        staged = self._staged(batch, name)
        if name not in LAYOUT:
            if files.exists(self.spark, staged):
                files.replace(self.spark, staged, self.path(name))
            return
        for part in files.names(self.spark, staged):
            if part.startswith(LAYOUT[name][0] + "="):
                files.replace(self.spark, os.path.join(staged, part), os.path.join(self.path(name), part))

    def recover(self) -> list[str]:
        """Finish a publish that was cut off, discard loads that were never staged
        whole; returns the tables that were published."""
        done = []
        for batch in files.names(self.spark, self.path("staging")):
            if files.exists(self.spark, self._staged(batch, READY)):
                tables = [n for n in files.names(self.spark, self._staged(batch)) if n != READY]
                for name in tables:
                    self.publish(batch, name)
                done += tables
            files.delete(self.spark, self._staged(batch))
        return done

    def replace_all(self, frames: Mapping[str, DataFrame], watches: Sequence[Watch] = ()) -> None:
        """Stage every table, check what the writes counted, then publish them: a
        table's next state may read another table's current files, which must not
        change before every state is staged."""
        batch = uuid.uuid4().hex
        try:
            for name, df in frames.items():
                self.stage(name, df, batch)
            for watch in watches:
                watch.check()
            facts = [n for n in frames if n in LAYOUT]
            if facts:
                frames = {**frames, "agg_fact_partition": self._counted(facts, batch)}
                self.stage("agg_fact_partition", frames["agg_fact_partition"], batch)
        except Exception:
            files.delete(self.spark, self._staged(batch))
            raise
        files.touch(self.spark, self._staged(batch, READY))
        for name in frames:
            self.publish(batch, name)
        files.delete(self.spark, self._staged(batch))

    def _counted(self, facts: Sequence[str], batch: str) -> DataFrame:
        """Next state of the partition counters: those of the staged partitions are
        counted, the others kept. A warehouse loaded before they were kept is counted whole, once."""
        name, keys = "agg_fact_partition", S.DERIVED["agg_fact_partition"][1]
        new = empty_like(self.spark, S.DERIVED[name][0])
        for fact in facts:
            if any(n.startswith(LAYOUT[fact][0] + "=") for n in files.names(self.spark, self._staged(batch, fact))):
                staged = self.spark.read.parquet(self._staged(batch, fact))
                new = new.unionByName(Q.partition_counters(staged, fact, LAYOUT[fact][0]))
        old = self.read(name)
        if not self.exists(name):
            for fact in [n for n in LAYOUT if self.exists(n)]:
                old = old.unionByName(Q.partition_counters(self.read(fact, keep_partition=True), fact, LAYOUT[fact][0]))
        return old.join(new.select(*keys), on=keys, how="left_anti").select(*old.columns).unionByName(new)

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(name))


def write_silver_frames(
    spark: SparkSession, silver: Mapping[str, DataFrame], root: str, counts: dict | None = None,
    watches: Sequence[Watch] = (),
) -> build.Lazy:
    """Write each Silver frame (K03) and return them read back from storage, under
    their contract (S08). ``counts`` gets the rows written beside the rows read;
    ``watches`` are the document contracts that the writes count (S03, F07).

    The risk frame is rebuilt from the *stored* atmospheric, marine and
    registry frames, as the risk job reads the Silver files: the events are
    not read a second time and the lineage is cut at the Silver layer.
    """
    def path(n: str) -> str:
        return os.path.join(root, "silver", n)

    def stored(n: str) -> DataFrame:
        return bronze.read_silver(spark, path(n), n) if n in bronze.SILVER_CONTRACTS else spark.read.parquet(path(n))

    base = [n for n in silver if n != "risk"]  # risk is rebuilt from the stored frames
    for name in base:
        written = bronze.write_silver(silver[name], path(name), SILVER_SORT.get(name, ()))
        if counts is not None and name in counts:
            counts[name] = (counts[name], written)
        for watch in watches:  # those of the frames written so far
            watch.check()
        # a Silver job that produced no row fails the run (one-row probe
        # of the written files, not a recount)
        require_non_empty(spark.read.parquet(path(name)), f"{name} transformation produced no valid rows.")
    if "registry" in base:
        require_non_empty(bronze.clean_asset_registry(stored("registry")), "No valid assets remain after validation.")
        # the plain registry: a repeated asset or hour stops the run
        risk = build.operational_risk(stored("atmospheric"), stored("marine"), stored("registry"),
                                      validate=True, unique_hours=True)
        bronze.write_silver(risk, path("risk"), SILVER_SORT["risk"])
        base.append("risk")
    return build.Lazy({n: (lambda n: (lambda: stored(n)))(n) for n in base})


def batch_partitions(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Partition values each fact's batch writes to, from the Silver rows."""
    parts = {
        "atmospheric": lambda df: df.select(F.to_date("forecast_reference_time").alias("run_date")),
        "price": lambda df: df.select(F.date_format("timestamp", "yyyy-MM").alias("price_month")),
        "rig": lambda df: df.select(F.date_format("observation_date", "yyyy-MM").alias("rig_month")),
    }
    parts["marine"] = parts["risk"] = parts["atmospheric"]
    return {fact: parts[frame](silver[frame]) for fact, frame in FACT_INPUT.items() if frame in silver}


def load_warehouse(
    spark: SparkSession, store: WarehouseStore, silver: Mapping[str, DataFrame], run_time: str, validate: bool = True
) -> None:
    """Upsert the batch into the dimensions of its frames, publish them, then the facts.

    Facts are checked against the *published* dimensions (every asset id,
    hour, product, country and classification must resolve, J07) and only
    the partitions the batch touches are read and rewritten.
    """
    dims = [n for n, frame in DIM_INPUT.items() if frame is None or frame in silver]
    nxt = build.warehouse_from_silver(
        spark, silver, run_time, current={n: store.read(n) for n in dims})
    store.replace_all({n: nxt[n] for n in dims})
    d = {n: store.read(n) for n in dims}
    chk = (lambda n: d[n]) if validate else (lambda n: None)
    parts = batch_partitions(silver)
    cur = {n: store.touched_slice(n, parts[n]) for n in parts}
    facts: dict[str, DataFrame] = {}
    watches: list[Watch] | None = [] if validate else None
    for table in parts:
        rows = silver[FACT_INPUT[table]]
        if table == "fact_oil_price":
            facts[table] = W.load_fact_oil_price(cur[table], rows, run_time, chk("dim_energy_product"), chk("dim_time"),
                                                 deduplicated=True, watches=watches)
        elif table == "fact_rig_count":
            facts[table] = W.load_fact_rig_count(
                cur[table], rows, run_time, chk("dim_country"), chk("dim_rig_classification"), chk("dim_time"),
                deduplicated=True, watches=watches)
        else:
            facts[table] = W.load_forecast_fact(cur[table], rows, table, run_time, chk("dim_asset"), chk("dim_time"), watches)
    if "atmospheric" in silver:
        facts["agg_latest_run"] = W.merge_latest_runs(store.latest_runs(), silver["atmospheric"])
    store.replace_all(facts, watches or ())


def run_all(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    run_time: str = TT.RUN_TIME,
    run_key: int | None = None,
    gate: bool = True,
) -> DataFrame:
    """One complete run on the test tables (stand-in inputs); returns the
    stored check rows."""
    return run_silver(spark, lambda: build.silver_frames(spark, sf_dir, run_time), root, run_time, run_key, gate)


def landed_silver(
    spark: SparkSession,
    run_time: str,
    registry_csv: str | None = None,
    atmospheric_dir: str | None = None,
    marine_dir: str | None = None,
    price_dir: str | None = None,
    rig_dir: str | None = None,
    counts: dict | None = None,
    watches: list[Watch] | None = None,
    bronze_root: str | None = None,
) -> build.Lazy:
    """Silver frames of the sources given: the newest non-empty file of each
    (S07), read with the Bronze readers and run through the Silver jobs; risk
    is rebuilt from the stored Silver by ``write_silver_frames``. ``counts``
    receives the observed rows into the price and rig jobs (F09); with ``watches`` the
    document contracts are counted by the write instead of probes before it. With
    ``bronze_root`` forecast and price documents are first landed there, an asset or record to
    a line (K01), and read from those lines by as many tasks as they fill."""
    def newest(folder: str, glob: str) -> str:
        return bronze.latest_file(spark, [folder], glob)

    def counted(name: str, records: DataFrame, job) -> DataFrame:
        if counts is None:
            return job(records)
        records, counts[name] = observe_rows(records, f"{name}_in")
        return job(records)

    def hours(folder: str, dataset: str, arrays: Sequence[str]) -> DataFrame:
        path = newest(folder, "*.json")
        if watches is None:
            return bronze.read_forecast_hours(spark, path, dataset, arrays)
        if bronze_root is not None:
            rows, seen = bronze.landed_forecast_hours(landed(path, dataset, "assets"), dataset, arrays)
        else:
            rows, seen = bronze.watched_forecast_hours(bronze.read_forecast_documents(spark, path, arrays), dataset, arrays)
        watches.extend(seen)
        return rows

    def landed(path: str, name: str, array: str) -> DataFrame:
        return bronze.read_landed(spark, bronze.land_entries(spark, path, os.path.join(bronze_root, name), array, run_time))

    def prices(path: str) -> DataFrame:
        if bronze_root is None:
            return bronze.read_price_records(spark, path)
        return bronze.landed_price_records(landed(path, "energy_prices", "response.data"))

    jobs = {
        "registry": (registry_csv, lambda: bronze.read_asset_registry(spark, registry_csv)),
        "atmospheric": (atmospheric_dir, lambda: SIL.silver_atmospheric(
            hours(atmospheric_dir, "atmospheric_forecast", bronze.ATMOSPHERIC_ARRAYS))),
        "marine": (marine_dir, lambda: SIL.silver_marine(
            hours(marine_dir, "marine_forecast", bronze.MARINE_ARRAYS))),
        "price": (price_dir, lambda: counted(
            "price", prices(newest(price_dir, "*.json")), SIL.silver_price)),
        "rig": (rig_dir, lambda: counted(
            "rig", bronze.read_rig_sheet(spark, newest(rig_dir, "*.csv")), lambda df: SIL.silver_rig(df, run_time))),
    }
    return build.Lazy({name: job for name, (source, job) in jobs.items() if source is not None})


def run_landed(
    spark: SparkSession,
    landing: Mapping[str, str],
    root: str,
    run_time: str,
    run_key: int | None = None,
    gate: bool = True,
) -> DataFrame:
    """One complete run from landed files (entry point of the batch run).

    ``landing`` names ``registry_csv``, ``atmospheric_dir``, ``marine_dir``,
    ``price_dir`` and ``rig_dir``.
    """
    counts: dict = {}
    watches: list[Watch] = []
    return run_silver(spark, lambda: landed_silver(spark, run_time, **landing, counts=counts, watches=watches,
                                                       bronze_root=os.path.join(root, "bronze")), root, run_time,
                      run_key, gate, counts, watches)


def run_landed_subject(
    spark: SparkSession, subject: str, landing: Mapping[str, str], root: str, run_time: str, run_key: int | None = None
) -> int:
    """The weather, price or rig run from landed files: only that subject's
    Silver, dimensions, hours and facts are loaded; returns the run's key.
    ``landing`` names the subject's sources as in ``run_landed``."""
    counts: dict = {}
    watches: list[Watch] = []
    return run_subject(spark, subject, lambda: landed_silver(spark, run_time, **landing, counts=counts, watches=watches,
                                                       bronze_root=os.path.join(root, "bronze")), root,
                       run_time, run_key, counts, watches)


def run_subject(
    spark: SparkSession,
    subject: str,
    silver_builder,
    root: str,
    run_time: str,
    run_key: int | None = None,
    counts: dict | None = None,
    watches: Sequence[Watch] = (),
) -> int:
    """Silver -> warehouse -> views of one of ``SUBJECTS``, recorded in the run
    ledger; the other subjects' tables are not touched. Returns the run's key."""
    def body(key: int) -> int:
        frames = silver_builder()
        silver = build.Lazy({n: (lambda n: (lambda: frames[n]))(n) for n in SUBJECTS[subject]})
        store = _load(spark, silver, root, run_time, key, counts, watches)
        register_views(spark, store.tables(), run_time)
        return key

    return _recorded(spark, root, f"{subject}_pipeline", run_key, body)


def run_validation(
    spark: SparkSession, root: str, run_time: str, run_key: int | None = None, gate: bool = True
) -> DataFrame:
    """The checks alone, on the stored warehouse (its views, which live in the
    session, are registered first); returns the stored check rows."""
    return _recorded(spark, root, "warehouse_validation", run_key,
                     lambda key: _checked(spark, root, run_time, key, gate))


def run_silver(
    spark: SparkSession,
    silver_builder,
    root: str,
    run_time: str,
    run_key: int | None,
    gate: bool,
    counts: dict | None = None,
    watches: Sequence[Watch] = (),
) -> DataFrame:
    """Silver -> warehouse -> checks -> gate, recorded in the run ledger."""
    def body(key: int) -> DataFrame:
        _load(spark, silver_builder(), root, run_time, key, counts, watches)
        return _checked(spark, root, run_time, key, gate)

    return _recorded(spark, root, "complete_energy_operations", run_key, body)


def _load(spark: SparkSession, silver: Mapping[str, DataFrame], root: str, run_time: str, run_key: int,
          counts: dict | None, watches: Sequence[Watch]) -> WarehouseStore:
    """Write Silver, store the observed row counts, load the warehouse."""
    store = WarehouseStore(spark, os.path.join(root, "warehouse"))
    stored = write_silver_frames(spark, silver, root, counts, watches)
    if counts:
        rows = [(run_key, name, int(before.get["rows"]), int(after.get["rows"]), rows_removed(before, after))
                for name, (before, after) in counts.items()]
        spark.createDataFrame(rows, METRICS_SCHEMA).write.mode("append").parquet(
            os.path.join(root, "ledger", "run_metrics"))
    load_warehouse(spark, store, stored, run_time)
    return store


def _checked(spark: SparkSession, root: str, run_time: str, run_key: int, gate: bool) -> DataFrame:
    """Check the stored warehouse. Results are stored *before* the gate raises,
    so a failed run keeps its checks (a deliberate difference from the
    reference, where a failed gate stores none)."""
    store = WarehouseStore(spark, os.path.join(root, "warehouse"))
    log = os.path.join(root, "ledger", "quality_checks")
    tables = store.tables()
    register_views(spark, tables, run_time)
    checks = Q.quality_checks(spark, tables, run_time, [n for n in S.REQUIRED_TABLES if store.exists(n)])
    rows = checks.select(
        F.xxhash64(F.lit(run_key), F.col("check_name")).alias("quality_check_key"),
        F.lit(run_key).cast("long").alias("pipeline_run_key"),
        "check_name", "passed", "check_value", "expectation", "details",
        F.lit(run_time).cast("timestamp_ntz").alias("checked_at"),
    )
    staged = os.path.join(checkpoint_dir(spark), f"checks-{uuid.uuid4().hex}")
    L.quality_rows(rows).write.mode("overwrite").parquet(staged)
    spark.read.parquet(staged).write.mode("append").parquet(log)
    files.delete(spark, staged)
    stored = spark.read.parquet(log).where(F.col("pipeline_run_key") == run_key)
    if gate:
        Q.gate(stored)
    return stored


def _recorded(spark: SparkSession, root: str, name: str, run_key: int | None, body):
    """Run ``body(run_key)`` between a RUNNING and a SUCCESS or FAILED event;
    the ledger records wall-clock UTC, the data uses the run time."""
    run_key = L.issue_key() if run_key is None else run_key
    events = os.path.join(root, "ledger", "run_events")

    def now() -> str:
        return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")

    def finish(error: str | None = None) -> None:
        L.finish_event(spark, run_key, name, now(), error).write.mode("append").parquet(events)
        register_ledger_views(spark, read_ledger(spark, root))

    L.start_event(spark, run_key, name, now()).write.mode("append").parquet(events)
    try:
        result = body(run_key)
    except Exception as exc:
        finish(str(exc))
        raise
    finish()
    return result


def read_ledger(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Runs and checks stored so far; before the first run's checks, none."""
    ledger = WarehouseStore(spark, os.path.join(root, "ledger"))
    checks = ledger.path("quality_checks")
    return {
        "fact_pipeline_run": L.fold_runs(spark.read.parquet(ledger.path("run_events"))),
        "fact_data_quality_check": spark.read.schema(L.QUALITY_SCHEMA).parquet(checks)
        if ledger.exists("quality_checks") else spark.createDataFrame([], L.QUALITY_SCHEMA),
    }
