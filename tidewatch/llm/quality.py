"""Quality by compression: two zstandard dictionaries, good and bad.

A dictionary of typical passages is trained from the texts labelled good and
another from those labelled bad. A text is compressed with each, ``BLOCK`` bytes at a
time: every block starts from the dictionary alone, so the dictionaries weigh as much
at the end of a long text as at its start. The difference
of the two summed sizes, normalised, says which kind it resembles, and logistic
regression on labelled rows turns that into a probability. Two norms are used,
the text's bytes and the sum of the two sizes, because a text that repeats itself
shrinks to nothing under both dictionaries; their compressed size per byte and
its square tell the regression which norm to trust.

Training is bounded by documented parameters, whatever the size of the tables:
the labelled rows with the smallest hash of their id are taken, ``SAMPLE`` of
each kind. Half of them (by hash) build the dictionaries: their whole texts are
cut into pieces of ``PIECE`` bytes and ``PIECES`` of a kind, by smallest hash,
are given to the trainer. The other half, compressed in tasks, calibrate.

Defined cases: null and empty texts get the calibrated score of measures 0;
without rows of both kinds (as with empty tables) no dictionary is used and every text
gets the smoothed share of label 1; repeated rows get equal scores; a repeated label takes the
larger; rows that tie for the sample are taken by id; texts of any length are compressed
whole, block by block; only the id and text columns are read, so no other name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_text_size, column_udf
from .text_arrays import raw

SAMPLE = 5_000
PIECE = 2048
PIECES = 4_000
BLOCK = 4096
DICTIONARY = 112_640
LEVEL = 3
SMOOTH = 32  # bytes added to every norm: a few bytes of text say little


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weight: np.ndarray  # of ``measures`` and a constant


def _pieces(batches):
    def cut(batch):
        texts, label, order = [], [], []
        for i, text in enumerate(batch.column(0).to_pylist()):
            data = (text or "").encode()
            for at in range(0, len(data), PIECE):
                texts.append(data[at: at + PIECE])
                label.append(batch.column(1)[i].as_py())
                order.append(at)
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(label, pa.int32())],
                                          names=["piece", "label"])

    yield from by_text_size(batches, cut)


def measures(texts: pa.Array, good: bytes, bad: bytes) -> np.ndarray:
    """Per text: the difference of its compressed sizes (bad - good) per byte and
    per compressed byte, the latter times the size per byte r, r and r * r."""
    compress = []
    for data in (good, bad):
        known = zstandard.ZstdCompressionDict(data)
        known.precompute_compress(level=LEVEL)
        compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=False,
                                                 write_content_size=False, write_dict_id=False).compress)
    data, offsets = raw(texts)
    view = memoryview(data)
    sizes = np.zeros((2, len(texts)))
    for i in np.flatnonzero(np.diff(offsets)):
        for at in range(offsets[i], offsets[i + 1], BLOCK):
            part = view[at: min(at + BLOCK, offsets[i + 1])]
            sizes[0, i] += len(compress[0](part))
            sizes[1, i] += len(compress[1](part))
    difference, total = sizes[1] - sizes[0], sizes.sum(axis=0) + SMOOTH
    length = np.diff(offsets) + SMOOTH
    rate = sizes.sum(axis=0) / length
    return np.stack([difference / length, difference / total, difference / total * rate, rate, rate * rate], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (constant last) by Newton steps on a lightly regularised likelihood."""
    scale = np.append(np.maximum(x.std(axis=0), 1e-9), 1.0)
    design = np.column_stack([x, np.ones(len(x))]) / scale
    weight = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ weight, -30, 30)))
        gradient = design.T @ (p - y) + 0.01 * weight
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(len(weight))
        step = np.linalg.solve(hessian, gradient)
        weight -= step * min(1.0, 5.0 / np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return weight / scale


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on the rows of ``labels`` (id, label 0/1), which the caller has
    already restricted to those that may be learnt from."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")))
    rank = [F.xxhash64("id"), F.col("id")]
    chosen = (known.where("label = 0").orderBy(*rank).limit(sample)
              .unionByName(known.where("label = 1").orderBy(*rank).limit(sample)))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id")  # at most 2 * sample short rows
            .select("text", "label", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 0).alias("builds")))
    pieces = rows.where("builds").select("text", "label").mapInArrow(_pieces, "piece binary, label int")
    rank = [F.xxhash64("piece"), F.col("piece")]
    parts = [[bytes(r.piece) for r in pieces.where(F.col("label") == y).orderBy(*rank).limit(PIECES)
              .select("piece").collect()] for y in (0, 1)]
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)
    plain = Model(b"", b"", np.array([0, 0, 0, 0, 0, np.log(share / (1 - share))]))
    if any(len(p) < 8 for p in parts):  # the trainer needs several samples
        return plain
    try:
        bad, good = (zstandard.train_dictionary(min(DICTIONARY, max(1024, sum(map(len, p)) // 4)), p).as_bytes()
                     for p in parts)
    except zstandard.ZstdError:  # samples too small or all alike
        return plain
    measure = column_udf(lambda texts: pa.array(list(measures(texts, good, bad)), pa.list_(pa.float64())),
                         "array<double>")
    found = sorted((r["label"], *r["x"]) for r in rows.where("not builds")
                   .select(measure("text").alias("x"), "label").collect())
    y, x = np.array([r[0] for r in found], float), np.array([r[1:] for r in found], float)
    if len(np.unique(y)) < 2:
        return plain
    return Model(good, bad, _logistic(x, y))


def probabilities(texts: pa.Array, model: Model) -> np.ndarray:
    x = measures(texts, model.good, model.bad) if model.good else np.zeros((len(texts), 5))
    return 1 / (1 + np.exp(-np.clip(x @ model.weight[:-1] + model.weight[-1], -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: id, score, predicted."""
    scorer = column_udf(lambda texts: pa.array(probabilities(texts, model)), "double")
    return (docs.select(F.col(id_col), scorer(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
