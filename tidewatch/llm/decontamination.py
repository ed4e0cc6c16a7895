"""Benchmark decontamination: short test items found inside long documents.

An item is contained in a document when at least ``threshold`` of its distinct
word 5-gram shingles are among the document's. Jaccard similarity says little
when one side is a hundred times longer, so the search is for containment:

* Items are partitioned by size (powers of two of their shingle count). Each
  partition has its own MinHash sketch length: the k smallest values of a
  hash over the item's shingles, with k over ``1 - threshold`` of the
  partition's largest size. A document that contains the item lacks fewer than
  k of its shingles, so it holds at least one of the sketch: no true pair can be
  missed, whatever the document's length.
* One scan of the documents probes the sketch values through a bit table of
  bounded size. Only documents that hold one (the candidates) go on, reduced to
  those of their shingles that are in some item.
* The exact step joins these with the items on the shingle's hash and its words,
  and counts the distinct shingles that a document shares with each item.

The bit table has at most 2**27 bits and is the only thing sent to every task;
a larger benchmark fills it more, which costs time and loses nothing. The index
itself is joined by Spark and may have any size.

Defined cases: null text is empty; an item or document without words has no
shingle and matches nothing; a text of one to four words has one shingle, all
of its words, so it matches only texts of the same few words; items that
repeat (id and text) count once; documents that repeat an id are told apart by
their text, and rows equal in both are reported once; null ids are reported as null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_text_size, cut, id_text, small
from .text_arrays import SHINGLE, Words, lowered, mix, shingles

_MAX_BITS = 27


def _shingle_words(words: Words, first: int, text: int) -> bytes:
    last = min(first + SHINGLE, int(words.bounds[text + 1]))
    return b" ".join(words.word(i) for i in range(first, last))


def _sketch_length(n: np.ndarray, threshold: float) -> np.ndarray:
    """By size partition [2**c, 2**(c+1)): more than (1 - threshold) of its top."""
    top = 2 ** (np.floor(np.log2(n)) + 1) - 1
    return np.minimum(n, np.floor((1 - threshold) * top + 1e-9) + 1).astype(np.int64)


def _item_shingles(threshold: float):
    def run(batches):
        def rows(batch):
            words = Words(lowered(batch.column(1)))
            value, first, text = shingles(words)
            order = np.lexsort((mix(value), text))  # the sketch's order, by text
            value, first, text = value[order], first[order], text[order]
            new = np.ones(len(value), dtype=bool)
            new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
            value, first, text = value[new], first[new], text[new]
            n = np.bincount(text, minlength=batch.num_rows)
            rank = np.arange(len(text)) - np.searchsorted(text, text)
            sketched = rank < _sketch_length(n[text], threshold) if len(text) else np.zeros(0, bool)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), batch.column(2).take(pa.array(text)),
                 pa.array(n[text].astype(np.int64)), pa.array(value.view(np.int64)),
                 pa.array([_shingle_words(words, int(f), int(t)) for f, t in zip(first, text, strict=True)], pa.binary()),
                 pa.array(sketched)], names=["item_id", "item", "n", "h", "words", "sketched"])

        yield from by_text_size(batches, rows)

    return run


def _bit_table(index: DataFrame, bits: int) -> np.ndarray:
    """One bit per leading ``bits`` of the hashes: at most 2**(bits - 3) bytes."""
    lead = F.shiftrightunsigned("h", 64 - bits)
    blocks = (index.groupBy(F.shiftright(lead, 15).alias("block"))
              .agg(F.bitmap_construct_agg(lead.bitwiseAND(F.lit(32767))).alias("set")).collect())
    table = np.zeros((1 << (bits - 15), 4096), np.uint8)
    for row in blocks:
        table[row["block"]] = np.frombuffer(row["set"], np.uint8)
    return table.reshape(-1)


def _hits(sketch: np.ndarray, known: np.ndarray, bits: int):
    def run(batches):
        def test(table, value):
            lead = (value >> np.uint64(64 - bits)).astype(np.int64)
            return (table[lead >> 3] >> (lead & 7).astype(np.uint8)) & 1 == 1

        def rows(batch):
            words = Words(lowered(batch.column(1)))
            value, first, text = shingles(words)
            candidate = np.zeros(batch.num_rows, dtype=bool)
            candidate[text[test(sketch, value)]] = True
            keep = np.flatnonzero(candidate[text] & test(known, value)) if len(text) else np.zeros(0, np.int64)
            value, first, text = value[keep], first[keep], text[keep]
            if not len(value):
                return None
            _, some = np.unique(np.stack([text, value.view(np.int64)]), axis=1, return_index=True)
            value, first, text = value[some], first[some], text[some]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), batch.column(2).take(pa.array(text)),
                 pa.array(value.view(np.int64)),
                 pa.array([_shingle_words(words, int(f), int(t)) for f, t in zip(first, text, strict=True)], pa.binary())],
                names=["id", "row", "h", "words"])

        yield from by_text_size(batches, rows)

    return run


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs (id, row, item_id, matched, n_shingles, containment); ``row`` is a
    hash of the document's text, which tells rows of one id apart."""
    tests = id_text(items, item_id_col, item_text_col).distinct().withColumn("item", F.xxhash64("id", "text"))
    schema = f"item_id {items.schema[item_id_col].dataType.simpleString()}, item bigint, n bigint, h bigint, " \
             "words binary, sketched boolean"
    index = cut(tests.mapInArrow(_item_shingles(threshold), schema))
    bits = min(_MAX_BITS, max(20, math.ceil(math.log2(index.count() * 16 + 1))))
    sketch, known = (_bit_table(index.where("sketched"), bits), _bit_table(index, bits))
    rows = id_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, row bigint, h bigint, words binary"
    hits = rows.mapInArrow(_hits(sketch, known, bits), schema)
    shared = (hits.join(index, ["h", "words"]).groupBy("id", "row", "item_id", "item", "n")
              .agg(F.count_distinct("h").alias("matched"), F.bool_or("sketched").alias("candidate")))
    found = shared.where("candidate").withColumn("containment", F.col("matched") / F.col("n"))
    return found.where(F.col("containment") >= threshold).select(
        F.col("id").alias(id_col), "row", "item_id", "matched", F.col("n").alias("n_shingles"), "containment")


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, unchanged."""
    found = contained_items(docs, items, threshold, id_col, text_col)
    bad = small(cut(found.select(F.col(id_col).alias("bad_id"), F.col("row").alias("bad_row")).distinct()))
    same = docs[id_col].eqNullSafe(bad["bad_id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == bad["bad_row"])
    return docs.join(bad, same, "left_anti")
