"""Idempotent loads by natural key without a table format.

Parquet tables cannot be updated in place, so a load computes the next
state of the table as a DataFrame and the writer publishes it (see
``tidewatch.sources.warehouse_io``).  Only partitions that the batch
touches need to be rewritten; callers pass the touched slice of the
target, not the whole table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.dedupe import keep_first, keep_last

_PRESENT = "__u_present"


def surrogate_key(*natural: str | Column) -> Column:
    """Stable 64-bit key from the natural key, computed without a lookup.

    Uniqueness is verified by a quality check, not assumed.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in natural]
    return F.xxhash64(*cols)


def align_schema(
    df: DataFrame,
    schema: T.StructType,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, add missing ones.

    A missing column gets its default (or NULL); extra columns are dropped.
    """
    defaults = defaults or {}
    cols = []
    for field in schema.fields:
        if field.name in df.columns:
            cols.append(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name))
        else:
            value = defaults.get(field.name)
            lit = value if isinstance(value, Column) else F.lit(value)
            cols.append(lit.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def insert_ignore(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``.

    Within the batch the first row per key wins (later ones conflict with
    it); keys already in the target are left alone.  Returns the new table.
    """
    incoming = incoming.select(*target.columns)
    if order_by:
        batch = keep_first(incoming, keys, order_by)
    else:
        batch = incoming.dropDuplicates(list(keys))
    new_rows = batch.join(target.select(*keys), on=list(keys), how="left_anti")
    return target.unionByName(new_rows)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.

    * A key repeated in the batch ends with its last row (``order_by`` is
      input order).
    * For a key already in the target, only ``update_cols`` take the batch
      value; every other column (``created_at``, surrogate keys, ...) keeps
      the stored value.
    * A new key is inserted with the batch row as is.

    ``updates`` must carry every target column (fill defaults with
    ``align_schema`` first).  One full outer join on the keys.
    """
    keys = list(keys)
    updates = updates.select(*target.columns)
    if order_by:
        updates = keep_last(updates, keys, order_by)
    t = target.alias("t")
    u = updates.withColumn(_PRESENT, F.lit(True)).alias("u")
    cond = [F.col(f"t.`{k}`") == F.col(f"u.`{k}`") for k in keys]
    joined = t.join(u, on=cond, how="full_outer")
    present = F.col(f"u.{_PRESENT}").isNotNull()
    out = []
    for c in target.columns:
        tc, uc = F.col(f"t.`{c}`"), F.col(f"u.`{c}`")
        if c in keys:
            out.append(F.when(present, uc).otherwise(tc).alias(c))
        elif c in update_cols:
            out.append(F.when(present, uc).otherwise(tc).alias(c))
        else:
            # preserved column: the stored value when the row existed
            # (stored keys are never NULL, so one key column tells)
            t_exists = F.col(f"t.`{keys[0]}`").isNotNull()
            out.append(F.when(t_exists, tc).otherwise(uc).alias(c))
    return joined.select(*out)


def upsert_with_lookup(
    target: DataFrame,
    updates: DataFrame,
    lookup: DataFrame,
    on: str,
    keys: Sequence[str],
    update_cols: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Upsert whose rows need a foreign key found in ``lookup``.

    Rows whose lookup value is unknown are skipped, as
    ``INSERT ... SELECT ... FROM dim WHERE id = :id`` inserts nothing.
    """
    found = updates.join(lookup, on=on, how="inner")
    return upsert(target, found, keys, update_cols, order_by)


def empty_like(spark, schema: T.StructType) -> DataFrame:
    """An empty table of ``schema`` (the state before the first load).

    Built as a filtered-out one-row relation, which the optimizer folds to
    an empty local relation; joins and unions with it are then removed at
    plan time (an empty RDD-backed frame would still be shuffled).
    """
    row = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return row.where(F.lit(False))
