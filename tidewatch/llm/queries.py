"""Registered queries of this subpackage and their SQL (DuckDB) where SQL can
express one. Each query applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import masked_lm, quality, secrets, toxicity
from .alignment import align
from .conversation_trie import prefix_trie
from .decontamination import contained_items
from .exact_dedup import exact_dedup
from .group_packing import pack_groups
from .licenses import scan_licenses
from .ngram_join import near_duplicates
from .packing import pack
from .shared import crc32_mod, table
from .surrogates import replace_entities


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: rules, and random strings by Markov models."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        secrets.written(F.col("found")).alias("spans"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains (0.8 or more)."""
    found = contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; rows with crc32(doc_id) mod 5 = 0 are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False))
    model = quality.train(docs, labels.where(~held))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-log-likelihood of every document."""
    docs = table(spark, sf_dir, "documents")
    return masked_lm.score(docs, masked_lm.train(docs))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    return replace_entities(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learnt from the labelled rows with crc32(doc_id) mod 3 other than 1."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.train(docs, labels.where(crc32_mod("doc_id", 3) != 1))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; rows with crc32(doc_id) mod 3 = 1 are held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    held = F.coalesce(crc32_mod("doc_id", 3) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id that stays for its text; the largest id stays."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class and number of links (0.8 or more)."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its aligned tokens of two tokenizers and corpus-wide link counts."""
    return align(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed first-fit decreasing into sequences of at most 2048 tokens."""
    return pack_groups(table(spark, sf_dir, "documents"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_secret_scan, op3_benchmark_decontamination, op4_license_scan,
    op5_quality_classifier, op6_lm_scoring, op7_pii, op8_toxicity, op9_exact_dedup, op10_ngram_jaccard_join,
    op11_cross_tokenizer_alignment, op12_packing, op13_conversation_prefix_trie)}

ORACLE = {
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    # CRC-32 bit by bit: every byte enters the register, then eight shifts. A node is the text of its turns' hashes.
    "op13_conversation_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS pos, t, n
            FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS n,
                         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t
                  FROM conversations WHERE conv_id IS NOT NULL)
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                    lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1)))) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), rebuilt AS (
            SELECT c.conv_id, 0 AS part, b.pos, b.t, b.n FROM convs c JOIN turns b ON b.conv_id = c.base AND b.pos <= c.h
            UNION ALL
            SELECT c.conv_id, 1, o.pos, o.t, o.n FROM convs c JOIN turns o ON o.conv_id = c.conv_id AND o.pos > c.h
        ), paths AS (
            SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(t, ' ') OVER w) AS node,
                   lag(1) OVER w AS later, lead(1) OVER w AS more, n FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
            UNION ALL
            SELECT conv_id, 0, 'root', NULL, (SELECT any_value(1) FROM rebuilt r WHERE r.conv_id = convs.conv_id), 0 FROM convs
        ), nodes AS (
            SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (more IS NULL), '')) AS ends_sha256
            FROM paths GROUP BY node
        ), linked AS (
            SELECT v.*, up.node AS parent FROM nodes v
            LEFT JOIN paths up ON up.conv_id = v.conv_id AND up.depth = v.depth - 1
        ), counted AS (
            SELECT v.*, (SELECT count(*) FROM linked c WHERE c.parent = v.node) AS n_children FROM linked v
        ), below AS (
            SELECT above.node, sum((u.n_children = 0)::BIGINT) AS n_leaves, sum((u.n_convs - 1) * u.n) AS saved_tokens
            FROM counted u JOIN paths above ON above.conv_id = u.conv_id AND above.depth <= u.depth GROUP BY above.node
        )
        SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
               b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
        FROM counted v JOIN below b ON b.node = v.node LEFT JOIN nodes p ON p.node = v.parent
    """,
}
