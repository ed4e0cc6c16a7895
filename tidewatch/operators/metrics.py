"""Job metrics gathered while the job runs, without a second pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows flowing through ``df`` as a side effect of the action
    that consumes it (``Observation``); no extra job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def rows_removed(before: Observation, after: Observation) -> int:
    """Rows removed between two observed points (before - after), read after
    the consuming action has run."""
    return int(before.get["rows"]) - int(after.get["rows"])
