"""Corpus pipeline over ``documents``: toxicity, exact dedup, near dedup,
benchmark decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes each stage's rows as Parquet in the shared
checkpoint folder and gives the next stage what it reads back, so no stage is
computed twice and a lost executor costs only the running stage; a stage's rows are
deleted once the next stage's are written. All stages but
the last return the columns of ``documents``, rows unchanged; the last returns
one row per packed piece.

Defined cases: null texts count as empty and stay as they are; an empty text has no
shingle and no benchmark item, so only exact dedup thins such rows; rows with a null id
stay in the near-duplicate stage and go with their exact copies; rows of one id with
different texts are judged apart; of copies the largest id stays, of a near-duplicate
class the smallest; very long texts are read whole; extra columns are carried along, and
their names clash with nothing; an empty table passes every stage empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import toxicity
from tidewatch.llm.decontamination import decontaminate
from tidewatch.llm.exact_dedup import distinct_rows
from tidewatch.llm.ngram_join import keep_one_per_class
from tidewatch.llm.packing import pack
from tidewatch.llm.queries import toxicity_model
from tidewatch.llm.shared import delete_folder, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity machine scores below 0.7."""
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text: the largest doc_id."""
    return distinct_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per near-duplicate class (word 5-grams, 0.8): the smallest doc_id."""
    return keep_one_per_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item (0.8 of its word 5-grams)."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack_rows),
]

# Trained scores, MinHash and tokenizer ids have no SQL form; tests/llm compares
# every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if before:
            delete_folder(spark, before)
        before = out
    return docs
