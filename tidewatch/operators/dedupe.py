"""Keep-last / latest-per-group operators.

"Latest row per key" is written as an aggregate (``max_by`` over a struct
ordering key) instead of ``row_number() OVER (PARTITION BY ...)``.  The
aggregate is combined map-side, so a key that holds a third of all rows
is reduced to one row per map task before the shuffle; a window would
move every row of that key into a single task and sort it there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PAYLOAD = "__payload"
_ORDER = "__order"


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` that hold every one of ``columns`` (texts or times).

    The conditions are plain ones that Spark drops where an earlier step made
    them already (``dropna`` tests its columns together and is kept each time),
    however many steps ask again for a table's keys.
    """
    for c in columns:
        df = df.where(F.col(f"`{c}`").isNotNull())
    return df


def _order_struct(order_by: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])


def _pick(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    largest: bool,
    whole: bool = False,
) -> DataFrame:
    keys = list(keys)
    payload = [c for c in df.columns if whole or c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    if whole and largest and all(isinstance(c, str) for c in order_by):
        # order columns come first in the kept row: one copy of each in sorts and shuffles
        first = list(dict.fromkeys(order_by))
        row = F.struct(*[F.col(f"`{c}`") for c in [*first, *[c for c in df.columns if c not in first]]])
        grouped = df.groupBy(*keys).agg(F.max(row).alias(_PAYLOAD))
        return grouped.select(*[F.col(_PAYLOAD).getField(c).alias(c) for c in df.columns])
    pick = F.max_by if largest else F.min_by
    packed = F.struct(*[F.col(f"`{c}`") for c in payload])
    grouped = df.groupBy(*keys).agg(pick(packed, _order_struct(order_by)).alias(_PAYLOAD))
    out = grouped.select(
        *[k for k in keys if k not in payload], *[F.col(_PAYLOAD).getField(c).alias(c) for c in payload]
    )
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def keep_last(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], whole: bool = False
) -> DataFrame:
    """One row per ``keys``: the one that comes last in input order.

    ``order_by`` must describe input order (array position, file + row
    index, a sequence column).  Rows that tie on it must be identical in
    every kept column, otherwise the choice among them is arbitrary, which
    is what ``dropDuplicates`` would do anyway.

    ``whole``: the key columns come out of the kept row as well. Conditions
    put on the result then run on kept rows only (on a grouping key Spark
    moves them down to every input row), so all uses of the result within a
    query have one plan below here and share its shuffle. The columns must be
    of types that Spark can order (no maps).
    """
    return _pick(df, keys, order_by, largest=True, whole=whole)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per ``keys``: the first in ``order_by`` order."""
    return _pick(df, keys, order_by, largest=False)


def latest_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Row with the greatest ``order_by`` per group (W01-W03 ``row_number() = 1``)."""
    return _pick(df, keys, order_by, largest=True)


def earliest_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Row with the smallest ``order_by`` per group."""
    return _pick(df, keys, order_by, largest=False)


def rows_at_group_max(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """All rows whose ``column`` equals its maximum within ``keys``.

    Group max, then an equi-join back on (keys, column).  The aggregate is
    small (one row per group); AQE broadcasts it when its measured size
    allows and falls back to a sort-merge join, skew-split, when not.
    """
    latest = df.groupBy(*keys).agg(F.max(column).alias(column))
    return df.join(latest, on=[*keys, column], how="inner")


def rows_at_global_max(df: DataFrame, column: str) -> DataFrame:
    """All rows whose ``column`` equals the global maximum.

    The maximum is a one-row aggregate, so broadcasting it is safe at any
    input size; it is never collected to the driver.
    """
    latest = df.agg(F.max(column).alias(column))
    return df.join(F.broadcast(latest), on=[column], how="inner")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Head-n preview of a result (T05); a limit is the feature here."""
    return df.limit(n)
