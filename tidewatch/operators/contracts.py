"""Contracts: checks that must stop a job.

Column contracts are plan-time (no Spark job).  Data contracts either run
one small probe job (``limit`` on a violations frame) or are folded into
the query itself with ``raise_error``, so no second pass over the data
is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A data contract did not hold."""


def require_columns(df: DataFrame, required: Sequence[str], what: str = "input") -> DataFrame:
    """Error listing the sorted missing column names."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ContractError(f"Missing required columns in {what}: " + ", ".join(missing))
    return df


def require_non_empty(df: DataFrame, message: str) -> DataFrame:
    """Error when the frame has no row (F08).  Runs a one-row probe job."""
    if df.isEmpty():
        raise ContractError(message)
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Error if ``keys`` is not unique in ``df`` (J05 one-to-one / many-to-one)."""
    dup = duplicate_keys(df, keys).limit(5).collect()
    if dup:
        examples = ", ".join(str(tuple(r[k] for k in keys)) for r in dup)
        raise ContractError(f"{what}: key {list(keys)} is not unique, e.g. {examples}")
    return df


def missing_keys(
    df: DataFrame, dim: DataFrame, on: Sequence[str] | str, dim_on: Sequence[str] | None = None
) -> DataFrame:
    """Distinct natural keys of ``df`` with no row in ``dim``.

    The keys are made distinct first (combined map-side), so the anti-join
    moves one row per key, not one per fact row.
    """
    on = [on] if isinstance(on, str) else list(on)
    dim_on = list(dim_on) if dim_on else on
    wanted = df.select(*on).dropna().distinct()
    known = dim.select(*[F.col(d).alias(o) for o, d in zip(on, dim_on)])
    return wanted.join(known, on=on, how="left_anti")


def assert_keys_resolve(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | str,
    what: str,
    dim_on: Sequence[str] | None = None,
) -> DataFrame:
    """Error naming up to five natural keys that are missing from ``dim``."""
    on_list = [on] if isinstance(on, str) else list(on)
    miss = missing_keys(df, dim, on_list, dim_on).limit(5).collect()
    if miss:
        examples = ", ".join(str(r[0] if len(on_list) == 1 else tuple(r)) for r in miss)
        raise ContractError(f"{what} not found for: {examples}")
    return df


class Watch:
    """A contract counted while a load runs; ``check`` is called after it. Only a
    broken contract costs a job of its own, the one that names examples."""

    def __init__(self, seen: Observation, explain) -> None:
        self._seen, self._explain = seen, explain

    def check(self) -> None:
        if any(self._seen.get.values()):
            self._explain()
            raise ContractError("a contract was broken while the load ran")


def watch_keys(
    df: DataFrame, dim: DataFrame, on: Sequence[str] | str, what: str, dim_on: Sequence[str] | None = None
) -> tuple[DataFrame, Watch]:
    """``df`` left-joined to the dimension's keys, unresolved keys counted by whatever
    consumes it (J07): no probe before the load and no second scan of ``df``."""
    on_list = [on] if isinstance(on, str) else list(on)
    dim_list = list(dim_on) if dim_on else on_list
    known = dim.select(*[F.col(d).alias(o) for o, d in zip(on_list, dim_list, strict=True)], F.lit(True).alias("__known"))
    seen = Observation()
    missing = F.col("__known").isNull()
    for c in on_list:
        missing = missing & F.col(c).isNotNull()
    joined = df.join(known, on=on_list, how="left").observe(seen, F.count_if(missing).alias("missing")).select(*df.columns)
    return joined, Watch(seen, lambda: assert_keys_resolve(df, dim, on_list, what, dim_list))


def hourly_array_violations(
    assets: DataFrame, required: Sequence[str], id_col: str = "asset_id", hourly: str = "hourly"
) -> DataFrame:
    """Assets whose hourly arrays are missing or not as long as ``time``.

    ``assets`` has one row per asset with a struct column ``hourly``.  Under
    ANSI mode ``size(NULL)`` is NULL, so a missing array is tested apart.
    """
    return (
        assets.select(F.col(id_col).alias("asset_id"), hourly_array_problems(required, hourly).alias("problems"))
        .where(F.size("problems") > 0)
    )


def hourly_array_problems(required: Sequence[str], hourly: str = "hourly") -> Column:
    """Texts naming the arrays that are missing or not as long as ``time``."""
    time_len = F.size(F.col(f"{hourly}.time"))
    problems = []
    for field in required:
        arr = F.col(f"{hourly}.{field}")
        problems.append(
            F.when(arr.isNull(), F.lit(f"{field}: missing")).when(
                F.size(arr) != time_len, F.lit(f"{field}: length differs from time")
            )
        )
    return F.array_compact(F.array(*problems))


def assert_hourly_arrays(assets: DataFrame, required: Sequence[str], id_col: str = "asset_id") -> DataFrame:
    bad = hourly_array_violations(assets, required, id_col).limit(5).collect()
    if bad:
        detail = "; ".join(f"asset {r['asset_id']}: {', '.join(r['problems'])}" for r in bad)
        raise ContractError(f"Invalid hourly arrays: {detail}")
    return assets


def first_existing_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First of ``candidates`` that ``df`` has, else None (P06; plan-time only)."""
    present = set(df.columns)
    return next((c for c in candidates if c in present), None)
