"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text_arrays import slices


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local master, as in
    tests, may leave it unset: a temporary folder is then set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not context.getCheckpointDir():  # the setting itself is fixed once a session runs
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage in the shared checkpoint folder:
    a lost executor then costs no more than the tasks that it ran."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through the cluster's own file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text (null: empty), under fixed names: no other
    column of ``df`` can clash with what an operator adds."""
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def by_text_size(batches, fn, text: str = "text"):
    """Apply ``fn(RecordBatch) -> RecordBatch | None`` to row slices of a few
    MB of text, so temporary arrays stay small whatever the batch size is."""
    for batch in batches:
        for at, to in slices(batch.column(batch.schema.get_field_index(text))):
            out = fn(batch.slice(at, to - at))
            if out is not None:
                yield out


def column_udf(fn, return_type: str):
    """Arrow UDF over one text column that sees a few MB of text at a time.

    ``fn`` maps a string array (nulls as empty) to an array of equal length.
    """
    from pyspark.sql.functions import arrow_udf

    def run(texts: pa.Array) -> pa.Array:
        texts = texts.fill_null("")
        parts = [fn(texts.slice(at, to - at)) for at, to in slices(texts)]
        if not parts:
            return fn(texts)
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return arrow_udf(run, returnType=return_type)


def crc32_mod(id_col: str, k: int):
    """crc32 of the id as decimal text, modulo ``k`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % k

BROADCAST_ROWS = 200_000  # of a few numbers each: some MB
HUB_LINKS = 512  # links of one node that are joined as one key


def small(df: DataFrame) -> DataFrame:
    """``df`` (already cut, a few short columns), marked for broadcast only if
    its counted rows are at most BROADCAST_ROWS; else Spark shuffles the join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the
    smallest node of its connected component.

    Every round takes the smallest label among a node's neighbours and then
    jumps to that label's own label, so rounds grow with the logarithm of a
    component's diameter. Each round is cut; no link goes to the driver. The links
    of a hub (a node with over HUB_LINKS of them) are salted: they are spread over
    parts of about HUB_LINKS links, and the hub's label is copied once for each part.
    Only labels that have a smaller label of their own take part in the jump.
    """
    links = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    links = cut(links)
    hubs = small(cut(links.groupBy(F.col("b").alias("hub")).agg(
        F.ceil(F.count(F.lit(1)) / HUB_LINKS).cast("int").alias("parts")).where("parts > 1")))
    parts = F.coalesce("parts", F.lit(1))
    both = cut(links.join(hubs, links["b"] == hubs["hub"], "left")
               .select("a", "b", F.pmod(F.xxhash64("a"), parts).cast("int").alias("salt")))
    labels = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        spread = labels.join(hubs, labels["node"] == hubs["hub"], "left").select(
            "node", "label", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        near = (both.join(spread, (both["b"] == spread["node"]) & (both["salt"] == spread["part"]))
                .groupBy(both["a"].alias("node")).agg(F.min("label").alias("near")))
        step = cut(labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                    F.least("label", "near").alias("next")))
        held = step.groupBy("next").agg(F.lit(1).alias("held"))  # a label that many nodes hold is looked up once
        far = small(cut(held.join(labels, held["next"] == labels["node"]).where("label <> next")
                        .select("next", F.col("label").alias("far"))))
        new = cut(step.join(far, "next", "left").select(
            "node", "old", F.coalesce("far", "next").alias("label")))
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels
