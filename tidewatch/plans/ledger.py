"""Run ledger and quality-check log (K12, K13) and the observability views.

The ledger is append-only: starting and finishing a run each append an
event row; the current state of a run is the fold of its events
(``max_by`` on event time), so no row is ever updated in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions import scalars as X

Tables = Mapping[str, DataFrame]
QUALITY_SCHEMA = ("quality_check_key long, pipeline_run_key long, check_name string, passed boolean, check_value string, "
                  "expectation string, details string, checked_at timestamp_ntz")


def issue_key() -> int:
    """A new run key: 63 random bits, so runs that start anywhere get their own."""
    return uuid.uuid4().int >> 65


def start_event(spark: SparkSession, run_key: int, name: str, at: str) -> DataFrame:
    """The RUNNING event of a new run."""
    return spark.createDataFrame(
        [(run_key, name, None, "RUNNING", None)],
        "pipeline_run_key long, pipeline_name string, event_time timestamp_ntz, status string, error_message string",
    ).withColumn("event_time", F.lit(at).cast("timestamp_ntz"))


def finish_event(spark: SparkSession, run_key: int, name: str, at: str, error: str | None = None) -> DataFrame:
    """The SUCCESS (no error) or FAILED event of a run."""
    status = "SUCCESS" if error is None else "FAILED"  # an error without a message is one too
    return spark.createDataFrame(
        [(run_key, name, None, status, error)],
        "pipeline_run_key long, pipeline_name string, event_time timestamp_ntz, status string, error_message string",
    ).withColumn("event_time", F.lit(at).cast("timestamp_ntz"))


def fold_runs(events: DataFrame) -> DataFrame:
    """Current state per run: started at its RUNNING event, finished at its
    last SUCCESS / FAILED event, duration in seconds (K12, X19)."""
    is_start = F.col("status") == "RUNNING"
    last = F.struct("event_time", F.when(is_start, 0).otherwise(1))
    folded = events.groupBy("pipeline_run_key").agg(
        F.max_by("pipeline_name", last).alias("pipeline_name"),
        F.min(F.when(is_start, F.col("event_time"))).alias("started_at"),
        F.max(F.when(~is_start, F.col("event_time"))).alias("finished_at"),
        F.max_by("status", last).alias("status"),
        F.max_by("error_message", last).alias("error_message"),
    )
    return folded.select(
        "pipeline_run_key", "pipeline_name", "started_at", "finished_at",
        X.elapsed_seconds("finished_at", "started_at").alias("duration_seconds"),
        "status", "error_message",
    )


def quality_rows(checks: DataFrame) -> DataFrame:
    """Check results as stored rows: value as text, empty details -> NULL."""
    return checks.select(
        F.col("quality_check_key").cast("long"),
        F.col("pipeline_run_key").cast("long"),
        "check_name",
        F.col("passed").cast("boolean"),
        X.value_to_text("check_value", checks.schema["check_value"].dataType).alias("check_value"),
        "expectation",
        X.empty_to_null("details").alias("details"),
        F.col("checked_at").cast("timestamp_ntz"),
    )


def _latest_run_key(t: Tables) -> DataFrame:
    """Key of the run that started last (T02), as a one-row frame."""
    runs = t["fact_pipeline_run"]
    return runs.agg(F.max_by("pipeline_run_key", F.struct("started_at", "pipeline_run_key")).alias("pipeline_run_key"))


def latest_pipeline_run(t: Tables) -> DataFrame:
    """The run with the latest start (ORDER BY started_at DESC LIMIT 1, T02)."""
    runs = t["fact_pipeline_run"]
    return runs.orderBy(F.col("started_at").desc(), F.col("pipeline_run_key").desc()).limit(1).select(
        *[f.name for f in S.FACT_PIPELINE_RUN.fields]
    )


def latest_quality_summary(t: Tables) -> DataFrame:
    """Checks of the latest run: total, passed, failed, pass rate; no row when
    that run stored no checks (A18 view form)."""
    q = t["fact_data_quality_check"].join(F.broadcast(_latest_run_key(t)), on="pipeline_run_key", how="inner")
    out = q.groupBy("pipeline_run_key").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )
    return out.select("*", X.percent_of("passed_checks", "total_checks").alias("pass_rate_percent"))


def latest_quality_summary_total(t: Tables) -> DataFrame:
    """Function form of the summary: always one row, zeros when nothing is stored."""
    q = t["fact_data_quality_check"].join(F.broadcast(_latest_run_key(t)), on="pipeline_run_key", how="inner")
    out = q.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )
    return out.select(
        "total_checks",
        F.coalesce(F.col("passed_checks"), F.lit(0)).cast("long").alias("passed_checks"),
        F.coalesce(F.col("failed_checks"), F.lit(0)).cast("long").alias("failed_checks"),
        F.coalesce(X.percent_of("passed_checks", "total_checks"), F.lit(0).cast("decimal(10,2)")).alias("pass_rate_percent"),
    )


def latest_quality_checks(t: Tables) -> DataFrame:
    """Checks of the latest run, failed first, then by name."""
    q = t["fact_data_quality_check"].join(F.broadcast(_latest_run_key(t)), on="pipeline_run_key", how="inner")
    return q.select(*[f.name for f in S.FACT_DATA_QUALITY_CHECK.fields]).orderBy(
        F.col("passed").asc(), F.col("check_name").asc()
    )


def pipeline_run_history(t: Tables) -> DataFrame:
    """Every run with its check counts, runs without checks kept; newest first.

    Checks are counted per run before the join (combined map-side), so the
    join moves one row per run instead of one per check.
    """
    runs = t["fact_pipeline_run"].select(*[f.name for f in S.FACT_PIPELINE_RUN.fields])
    counts = t["fact_data_quality_check"].where(F.col("quality_check_key").isNotNull()).groupBy("pipeline_run_key").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )
    joined = runs.join(counts, on="pipeline_run_key", how="left")
    zero = F.lit(0).cast("long")
    return joined.select(
        *runs.columns,
        *[F.coalesce(F.col(c), zero).alias(c) for c in ["total_checks", "passed_checks", "failed_checks"]],
    ).orderBy(F.col("started_at").desc())
