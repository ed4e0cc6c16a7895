"""Spark session settings shared by jobs, tests and the bench.

The engine runs on whatever cluster the session points at.  The helpers
here only fill in settings that are still unset, so a cluster's own
configuration (shuffle partitions, checkpoint folder, ...) always wins.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC is part of the data model: all
# timestamps are UTC wall-clock values held as TIMESTAMP_NTZ.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "tidewatch",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session or build a local one for tests and bench."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", str(shuffle_partitions)
        )
    for key, value in {**REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings jobs depend on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the
    cluster (a shared file system).  Only a local master, whose tasks share
    this machine's disk, may leave it unset, as in tests: a temp folder is
    then created.  On a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not spark.sparkContext.getCheckpointDir():  # the setting itself is fixed once a session runs
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside remove their shuffle files when they end. For writes, whose
    shuffles nobody reads again; else the files stay until the driver's garbage collector
    finds them unused, often for the rest of the session."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
