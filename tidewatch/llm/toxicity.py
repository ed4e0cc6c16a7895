"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its lower-cased words and the first 4 to 7 bytes of
longer words, hashed to 2**20 buckets with no stored vocabulary. A text is the
L2-normalised vector x of log(1 + count) over the terms that the labels tell
apart, and its log-odds are

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

so a pair of terms (an insult next to a group's name) can weigh what neither
term does alone.

Training (all steps over Spark rows, the driver only sees bounded results):
1. the labelled rows are sampled down to ``SAMPLE`` rows, those with the
   smallest hash of their id;
2. term counts per label are summed by a Spark aggregation; the ``TERMS`` terms
   that depart most from independence (z over ``MIN_Z``, in at least ``MIN_DOCS``
   rows) are kept, and the ``COMMON`` terms of most rows whatever their z: a pair
   may tell the labels apart when neither of its terms does;
3. every sampled row, reduced to kept terms, comes to the driver (at most
   SAMPLE rows of kept terms), where numpy fits w and V by Adagrad.

Scoring reads whole texts in one pass and adds columns to the rows.

Defined cases: null and empty texts, and texts with no kept term, get the score
of the bias; with no labelled row (as with empty tables), or labels of one kind, the model
is the smoothed share of label 1; repeated rows get equal scores; a repeated label takes the
larger; terms that tie are taken by bucket; texts of any length are read whole, a few MB
at a time; only id and text are read, so no other column's name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_text_size, column_udf
from .text_arrays import BASE, Words, distinct_per_text, lowered, mix

BITS = 20
PREFIXES = (4, 5, 6, 7)
SAMPLE = 20_000
TERMS, COMMON = 8192, 1024
MIN_Z = 4.0
MIN_DOCS = 3
SCALE = 5.0  # length of x
_U = np.uint64


@dataclass(frozen=True)
class Model:
    bucket: np.ndarray  # kept terms, ascending
    w: np.ndarray
    v: np.ndarray
    bias: float


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every term occurrence, in no set order."""
    words = Words(lowered(texts))
    text = np.repeat(np.arange(len(texts)), words.count())
    found, owner = [mix(words.hash)], [text]
    size = words.end - words.start
    keep = np.flatnonzero(size > min(PREFIXES))
    prefix = np.zeros(len(keep), dtype=_U)
    for j in range(max(PREFIXES)):
        keep, prefix = (x[size[keep] > j] for x in (keep, prefix)) if j else (keep, prefix)
        prefix = prefix + words.data[words.start[keep] + j].astype(_U) * _U(pow(BASE, j, 1 << 64))
        if j + 1 in PREFIXES:
            whole = size[keep] > j + 1
            found.append(mix(prefix[whole] + _U(j + 1)))
            owner.append(text[keep[whole]])
    return (np.concatenate(found) >> _U(64 - BITS)).astype(np.int64), np.concatenate(owner)


def _counted(bucket: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text, occurrences) of the distinct pairs, by text."""
    key, count = np.unique((text << BITS) | bucket, return_counts=True)
    return key & ((1 << BITS) - 1), key >> BITS, count


def _term_counts(batches):
    """Rows with each term, by label: one row per term of a task."""
    total = np.zeros((2, 1 << BITS), np.int64)

    def add(batch):
        bucket, text = distinct_per_text(*terms(batch.column(0)))
        label = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), np.int64)[text]
        for y in (0, 1):
            total[y] += np.bincount(bucket[label == y], minlength=1 << BITS)

    for _ in by_text_size(batches, add):
        pass
    some = np.flatnonzero(total.any(axis=0))
    for at in range(0, len(some), 10_000):
        part = some[at: at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[1][part]), pa.array(total[0][part])],
                                         names=["bucket", "ones", "zeros"])


def _kept_terms(kept: np.ndarray):
    def run(batches):
        def rows(batch):
            bucket, text = terms(batch.column(0))
            at = np.searchsorted(kept, bucket)
            at[at == len(kept)] = 0
            ok = kept[at] == bucket
            slot, text, count = _counted(at[ok], text[ok])
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [batch.column(1), pa.ListArray.from_arrays(edges, pa.array(slot.astype(np.int32))),
                 pa.ListArray.from_arrays(edges, pa.array(count.astype(np.int32)))], names=["label", "term", "n"])

        yield from by_text_size(batches, rows)

    return run


def fit_machine(rows: list[tuple[int, np.ndarray, np.ndarray]], n_terms: int, factors: int = 4, epochs: int = 8,
                rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Adagrad over (label, terms, counts): w, V and the bias."""
    rng = np.random.default_rng(seed)
    w, v = np.zeros(n_terms), rng.normal(0, 0.02, (n_terms, factors))
    gw, gv = np.full(n_terms, 1e-2), np.full((n_terms, factors), 1e-2)
    ones = sum(r[0] for r in rows)
    bias = float(np.log((ones + 1) / (len(rows) - ones + 1)))
    vectors = []
    for label, term, count in rows:
        x = np.log1p(count)
        vectors.append((label, term, x * (SCALE / np.sqrt((x * x).sum())) if len(x) else x))
    for _ in range(epochs):
        for i in rng.permutation(len(vectors)):
            label, term, x = vectors[i]
            part = v[term] * x[:, None]
            total = part.sum(axis=0)
            z = bias + w[term] @ x + 0.5 * (total @ total - (part * part).sum())
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
            bias -= rate * 0.1 * g
            if abs(g) < 1e-3 or not len(term):
                continue
            step = g * x + decay * w[term]
            gw[term] += step * step
            w[term] -= rate * step / np.sqrt(gw[term])
            step = g * (x[:, None] * total - v[term] * (x * x)[:, None]) + decay * v[term]
            gv[term] += step * step
            v[term] -= rate * 0.5 * step / np.sqrt(gv[term])
    return w, v, bias


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on the rows of ``labels`` (id, label 0/1), which the caller has
    already restricted to those that may be learnt from."""
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id").select("text", "label"))  # at most `sample` short rows
    counts = (rows.mapInArrow(_term_counts, "bucket bigint, ones bigint, zeros bigint")
              .groupBy("bucket").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")))
    size = rows.agg(F.sum("label").alias("ones"), F.count("label").alias("n")).first()
    n, ones = size["n"], size["ones"] or 0
    share = (ones + 1) / (n + 2)
    both = F.col("ones") + F.col("zeros")
    z = F.abs(F.col("ones") - both * share) / F.sqrt(both * (share * (1 - share)))
    able = counts.where(both >= MIN_DOCS).withColumn("z", z)
    marked = able.where(F.col("z") > MIN_Z).orderBy(F.desc("z"), "bucket").limit(TERMS)
    common = able.orderBy(F.desc(both), "bucket").limit(COMMON)
    kept = np.unique(marked.select("bucket").unionByName(common.select("bucket")).toPandas()["bucket"].to_numpy(np.int64))
    if not len(kept) or ones in (0, n):
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 1)), float(np.log(share / (1 - share))))
    data = rows.mapInArrow(_kept_terms(kept), "label int, term array<int>, n array<int>").toArrow()
    data = data.sort_by([("label", "ascending")]).to_pydict()
    fitted = sorted(zip(data["label"], data["term"], data["n"], strict=True))
    return Model(kept, *fit_machine(
        [(y, np.array(t, np.int64), np.array(c, np.float64)) for y, t, c in fitted], len(kept)))


def probabilities(texts: pa.Array, model: Model) -> np.ndarray:
    z = np.full(len(texts), model.bias)
    if len(model.bucket):
        slot_of = np.full(1 << BITS, -1, np.int32)
        slot_of[model.bucket] = np.arange(len(model.bucket))
        bucket, text = terms(texts)
        slot = slot_of[bucket]
        slot, text, count = _counted(slot[slot >= 0].astype(np.int64), text[slot >= 0])
        if len(slot):
            first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            size = np.diff(np.r_[first, len(text)])
            x = np.log1p(count)
            x *= SCALE / np.repeat(np.sqrt(np.add.reduceat(x * x, first)), size)
            part = model.v[slot] * x[:, None]
            total = np.add.reduceat(part, first)
            z[text[first]] += (np.add.reduceat(model.w[slot] * x, first)
                               + 0.5 * ((total * total).sum(axis=1) - np.add.reduceat((part * part).sum(axis=1), first)))
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scorer(model: Model):
    """Column function: text -> probability of label 1."""
    return column_udf(lambda texts: pa.array(probabilities(texts, model)), "double")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: id, score, predicted."""
    return (docs.select(F.col(id_col), scorer(model)(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged."""
    return docs.where(scorer(model)(F.col(text_col)) < threshold)
