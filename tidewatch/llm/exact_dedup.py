"""Exact dedup: 128-bit content hash, then bytes compared inside the group.

DataFrame operations only. Rows are grouped by (md5 of the text, text): the
hash deals the groups over tasks, the second key makes Spark compare the bytes
of every pair of texts that share a hash, so a hash collision can't merge two
texts. The aggregation is combined in each map task, so a text that a third of
all rows repeat leaves one row per task.

Per hash, the classes are then a few fixed-size numbers; documents get theirs
by a join on the hash alone, without their text. Only hashes that hold more
than one text (none, short of an attack on md5) are joined by hash and text.

Defined cases: null text counts as empty; empty texts are equal to each other;
the largest id of equal texts stays (or the smallest, ``keep="min"``); null ids
lose against any id, and a group of null ids only keeps id null; rows that
repeat the kept id are all marked kept (``distinct_rows`` leaves one of them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, id_text


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "max", digest=_digest) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    best = F.max if keep == "max" else F.min
    rows = id_text(docs, id_col, text_col).withColumn("h", digest(F.col("text")))
    texts = rows.groupBy("h", "text").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    by_hash = cut(texts.groupBy("h").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")))
    sole = by_hash.where("texts = 1").select("h", "keep_id", "group_size")
    light = rows.select("h", "id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    out = light.join(sole, "h")
    shared = by_hash.where("texts > 1").select("h")
    if not shared.isEmpty():
        both = rows.join(shared, "h", "left_semi").join(texts, ["h", "text"])
        out = out.unionByName(both.select(
            "h", "id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size"))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def distinct_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one per text, with the columns of ``docs``: of equal
    texts the row with the largest id (ties: the largest other columns)."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    row = F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)],
                   F.col(text_col).isNotNull().alias("has_text"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    best = docs.select(text.alias("text"), _digest(text).alias("h"), row.alias("row")) \
        .groupBy("h", "text").agg(F.max("row").alias("row"))
    at = {c: F.col(f"row.c{i}").alias(c) for i, c in enumerate(others)}
    at[id_col] = F.col("row.id").alias(id_col)
    at[text_col] = F.when(F.col("row.has_text"), F.col("text")).alias(text_col)
    return best.select(*[at[c] for c in docs.columns])
