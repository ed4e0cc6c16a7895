"""Masked pseudo-likelihood of documents by a bidirectional window network.

Every token is predicted from the ``WINDOW`` tokens on each side, never from
itself; a document's score is the sum of log P(token | both sides).

Vocabulary: words of all documents are counted by a Spark aggregation (combined
in the tasks first). Every word that occurs ``OWN_COUNT`` times or more, and the
``KNOWN`` most frequent ones in any case, gets a number of its own, so the
vocabulary grows with the corpus up to ``VOCABULARY`` words (the most frequent
ones; a bound on what the driver and each task hold: 87,616 numbers, 33 floats each);
the rarer words share about a third as many numbers by hash. Number 0 pads the edges.

Network (numpy): embeddings E of the 2 * WINDOW neighbours, each position with
its own weights, summed into h = tanh(sum_p C_p * E[token_p]). The output is a
two-level softmax, P(class | h) P(token | class, h), with as many classes as
tokens in each (CLASSES and WITHIN at the least), so a prediction costs twice the
root of the vocabulary in products and probabilities still sum to one over it.
Output weights are held within ``LIMIT`` / (SIZE + 1), which keeps the exponentials of
the outputs finite without a look at each row's largest. Tokens are taken in the order of the texts, so a token's embedding is read once for the 2 * WINDOW
windows around it, by shifted sums, and its gradient is added up once.

Training over Spark is one pass over every window of every document. The windows
are dealt over ``ROUNDS`` rounds in stretches of ``STRETCH``. In a round
every partition takes gradient steps from the shared parameters on the round's
windows of its own documents, and the partitions' parameters are averaged,
weighted by windows. Partitions give blocks of parameters, which tasks add up
block by block; the driver gets one set.

Defined cases: null and empty texts have no tokens, log probability 0 and mean
0; a one-token text is predicted from padding; an empty table gives no rows;
repeated rows get equal scores; null and repeated ids are kept row by row; words of
equal counts are taken in the order of their hashes; very long texts are scored whole,
a few thousand windows at a time; only id and text are read, so no other column's name
can clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_text_size, column_udf, cut, id_text
from .text_arrays import Words, lowered, mix

WINDOW = 3
SIZE = 16
CLASSES, WITHIN = 64, 64
KNOWN, OWN_COUNT, VOCABULARY = 3072, 2000, 1 << 16
STRETCH, LIMIT = 256, 60.0
ROUNDS, SHARE = 2, 1.0
_V = CLASSES * WITHIN
_U = np.uint64


@dataclass(frozen=True)
class Vocabulary:
    hashes: np.ndarray  # of the known words, ascending
    number: np.ndarray

    @property
    def known(self) -> int:
        return max(KNOWN, len(self.hashes))

    @property
    def side(self) -> int:
        """Classes, and tokens of a class: at least a quarter of the numbers is shared."""
        return max(CLASSES, math.ceil(math.sqrt(self.known * _V / KNOWN)))

    def tokens(self, words: Words) -> np.ndarray:
        spread = (self.known + 1 + mix(words.hash) % _U(self.side ** 2 - self.known - 1)).astype(np.int32)
        if not len(self.hashes):
            return spread
        at = np.minimum(np.searchsorted(self.hashes, words.hash), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words.hash, self.number[at], spread)


def _word_counts(batches):
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        value, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return value, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

    def add(batch):
        parts.append(np.unique(Words(lowered(batch.column(1))).hash, return_counts=True))
        if len(parts) >= 16:
            parts[:] = [merged()]

    for _ in by_text_size(batches, add):
        pass
    if parts:
        value, count = merged()
        for at in range(0, len(value), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(value[at: at + 50_000].view(np.int64)), pa.array(count[at: at + 50_000])],
                                             names=["word", "n"])


def build_vocabulary(rows: DataFrame, own_count: int = OWN_COUNT, most: int = VOCABULARY) -> Vocabulary:
    counted = cut(rows.mapInArrow(_word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    ranked = counted.orderBy(F.desc("n"), "word")
    top = ranked.where(F.col("n") >= own_count).limit(most).collect()
    if len(top) < KNOWN:
        top = ranked.limit(KNOWN).collect()
    hashes = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    number = 1 + np.arange(len(top))  # class_of puts neighbours in frequency into different classes
    return Vocabulary(hashes[order], number[order].astype(np.int32))


def _sizes(side: int) -> list[int]:
    return [side ** 2 * SIZE, 2 * WINDOW * SIZE, side * (SIZE + 1), side ** 2 * (SIZE + 1)]


def fresh(seed: int = 11, side: int = CLASSES) -> np.ndarray:
    rng = np.random.default_rng(seed)
    e, c, top, low = _sizes(side)
    return np.concatenate([rng.normal(0, 0.3, e), np.full(c, 0.5), np.zeros(top), np.zeros(low)]).astype(np.float32)


def _parts(flat: np.ndarray):
    side = math.isqrt(len(flat) // (2 * SIZE + 1))
    while sum(_sizes(side)) > len(flat):
        side -= 1
    e, c, top, low = np.split(flat, np.cumsum(_sizes(side))[:-1])
    return (e.reshape(side ** 2, SIZE), c.reshape(2 * WINDOW, SIZE), top.reshape(side, SIZE + 1),
            low.reshape(side, side, SIZE + 1))


def class_of(token: np.ndarray, side: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    return token % side, token // side


def _by_class(group: np.ndarray, side: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of the rows by class, and (class, from, to) of every class that has rows."""
    order = np.argsort(group.astype(np.uint16), kind="stable")  # 16 bits: a radix sort
    edges = np.searchsorted(group[order], np.arange(side + 1)).tolist()
    return order, [(g, edges[g], edges[g + 1]) for g in range(side) if edges[g] < edges[g + 1]]


_OFFSETS = [*range(-WINDOW, 0), *range(1, WINDOW + 1)]


class Tokens:
    """Tokens of an array of texts with ``WINDOW`` places of padding at both ends."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        edge = np.zeros(WINDOW, np.int32)
        self.token = np.concatenate([edge, tokens.astype(np.int32), edge])
        text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.text = np.concatenate([np.full(WINDOW, -1, np.int32), text, np.full(WINDOW, -2, np.int32)])
        self.n = len(tokens)

    def only(self, chosen: np.ndarray) -> tuple["Tokens", np.ndarray]:
        """The chosen windows and the tokens next to them, and which windows are chosen."""
        near = np.concatenate([np.zeros(WINDOW, bool), chosen, np.zeros(WINDOW, bool)])
        at = near.copy()
        for d in range(1, WINDOW + 1):
            at[d:] |= near[:-d]
            at[:-d] |= near[d:]
        out = Tokens.__new__(Tokens)
        at[:WINDOW] = at[-WINDOW:] = True
        out.token, out.text = self.token[at], self.text[at]
        out.n = len(out.token) - 2 * WINDOW
        return out, near[at][WINDOW: WINDOW + out.n]

    def around(self, at: int, to: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Tokens of the places ``at`` to ``to`` and those next to them; for each
        offset, the windows whose place at that offset lies beyond their text."""
        text = self.text[at: to + 2 * WINDOW]
        own = text[WINDOW: WINDOW + to - at]
        return self.token[at: to + 2 * WINDOW], [
            np.flatnonzero(text[WINDOW + d: WINDOW + d + to - at] != own) for d in _OFFSETS]


def _squashed(total: np.ndarray) -> np.ndarray:
    h = np.ones((len(total), SIZE + 1), np.float32)
    np.tanh(total, out=h[:, :SIZE])
    return h


def _hidden(e: np.ndarray, c: np.ndarray, rows: np.ndarray, beyond: list[np.ndarray]) -> np.ndarray:
    """Hidden state of consecutive windows; ``rows`` are the embeddings of ``Tokens.around``."""
    n = len(rows) - 2 * WINDOW
    total, part = np.zeros((n, SIZE), np.float32), np.empty((n, SIZE), np.float32)
    for k, d in enumerate(_OFFSETS):
        near = rows[WINDOW + d: WINDOW + d + n]
        np.multiply(near, c[k], out=part)
        total += part
        total[beyond[k]] += (e[0] - near[beyond[k]]) * c[k]
    return _squashed(total)


def _exponentials(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of the outputs (in place) and their row sums."""
    np.exp(z, out=z)
    return z, z @ np.ones(z.shape[1], np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    z, total = _exponentials(z)
    z /= total[:, None]
    return z


def _log_probabilities(flat: np.ndarray, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    _, _, top, low = _parts(flat)
    group, place = class_of(target, len(top))

    def chosen(z: np.ndarray, which: np.ndarray) -> np.ndarray:
        own = z[np.arange(len(z)), which]
        return own - np.log(_exponentials(z)[1])

    out = chosen(h @ top.T, group)
    order, classes = _by_class(group, len(top))
    h, z = h[order], np.empty((len(h), len(top)), np.float32)
    for g, first, to in classes:
        np.matmul(h[first:to], low[g].T, out=z[first:to])
    out[order] += chosen(z, place[order])
    return out.astype(np.float64)


def log_probabilities(flat: np.ndarray, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log P(target | the 2 * WINDOW tokens ``around``), exact over the whole vocabulary."""
    e, c, _, _ = _parts(flat)
    return _log_probabilities(flat, _squashed((e[around] * c).sum(axis=1)), target)


def _add_rows(total: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """total[at] += rows, equal places summed."""
    order = np.argsort(at.astype(np.uint16) if len(total) <= 1 << 16 else at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    total[at[first]] += np.add.reduceat(rows[order], first, axis=0)


def _gradient(flat: np.ndarray, grad: np.ndarray, tokens: Tokens, at: int, to: int, chosen: np.ndarray) -> None:
    """Adds the gradient of the summed loss of the ``chosen`` windows (places from ``at``) to ``grad``."""
    e, c, top, low = _parts(flat)
    ge, gc, gtop, glow = _parts(grad)
    near, beyond = tokens.around(at, to)
    rows = np.take(e, near, axis=0)
    hidden = _hidden(e, c, rows, beyond)
    group, place = class_of(near[WINDOW + chosen], len(top))
    order, classes = _by_class(group, len(top))
    chosen, group, place = chosen[order], group[order], place[order]
    h = hidden[chosen]
    every = np.arange(len(h))
    p = _softmax(h @ top.T)
    p[every, group] -= 1
    gtop += p.T @ h
    gh = p @ top
    q = np.empty((len(h), len(top)), np.float32)
    for g, first, end in classes:
        np.matmul(h[first:end], low[g].T, out=q[first:end])
    q = _softmax(q)
    q[every, place] -= 1
    for g, first, end in classes:
        glow[g] += q[first:end].T @ h[first:end]
        gh[first:end] += q[first:end] @ low[g]
    gz = np.zeros((to - at, SIZE), np.float32)
    gz[chosen] = (gh * (1 - h * h))[:, :SIZE]
    grows, part = np.zeros_like(rows), np.empty_like(gz)
    for k, d in enumerate(_OFFSETS):
        span, out = slice(WINDOW + d, WINDOW + d + to - at), beyond[k]
        gc[k] += np.einsum("nd,nd->d", gz, rows[span])
        gc[k] += (gz[out] * (e[0] - rows[span][out])).sum(axis=0)
        np.multiply(gz, c[k], out=part)
        ge[0] += part[out].sum(axis=0)
        part[out] = 0
        grows[span] += part
    _add_rows(ge, near, grows)


def train_step(flat: np.ndarray, memory: np.ndarray, tokens: Tokens, at: int, to: int, chosen: np.ndarray, rate: float) -> None:
    """One Adagrad step, in place, on the mean loss of the chosen windows between two places."""
    n = int(np.count_nonzero(chosen[at:to]))
    if not n:
        return
    grad = np.zeros_like(flat)
    for k in range(at, to, _CHUNK):
        end = min(k + _CHUNK, to)
        _gradient(flat, grad, tokens, k, end, np.flatnonzero(chosen[k:end]))
    grad /= n
    memory += grad * grad
    flat -= rate * grad / np.sqrt(memory + 1e-8)
    for weights in _parts(flat)[2:]:
        np.clip(weights, -LIMIT / (SIZE + 1), LIMIT / (SIZE + 1), out=weights)


_BATCH, _CHUNK, _BLOCK = 2048, 8192, 512


def windows_of(words: Words, turn: int, rounds: int, share: float) -> np.ndarray:
    """Which windows a round learns from: over all rounds every window comes up once
    (or ``share`` of them, whatever the texts begin with)."""
    sums = np.r_[_U(0), np.cumsum(words.hash)]
    of_text = mix(sums[words.bounds[1:]] - sums[words.bounds[:-1]])
    place = np.arange(len(words.hash)) - np.repeat(words.bounds[:-1], words.count())
    turn_of = np.repeat(of_text, words.count()) + (place // STRETCH).astype(_U)
    chosen = turn_of % _U(rounds) == _U(turn)
    if share < 1:
        chosen &= mix(turn_of + mix(place.astype(_U))) >> _U(32) < _U(int(share * (1 << 32)))
    return chosen


def _train_partition(vocabulary: Vocabulary, flat: np.ndarray, turn: int, rounds: int, share: float, rate: float):
    least = max(_BATCH, vocabulary.side ** 2 // 2)  # a step changes all parameters: its cost stays that of its windows

    def run(batches):
        own, memory = flat.copy(), np.full(len(flat), 1e-6, np.float32)
        windows = 0

        def add(batch):
            nonlocal windows
            words = Words(lowered(batch.column(1)))
            tokens = Tokens(vocabulary.tokens(words), words.count())
            chosen = windows_of(words, turn, rounds, share)
            n = int(np.count_nonzero(chosen))
            if not n:
                return
            tokens, chosen = tokens.only(chosen)
            size = max(least, min(n // 32, 2 * _CHUNK))
            starts = np.arange(0, tokens.n, size)
            for at in starts[np.argsort(mix(starts.astype(_U)))].tolist():
                train_step(own, memory, tokens, at, min(at + size, tokens.n), chosen, rate)
            windows += n

        for _ in by_text_size(batches, add):
            pass
        if windows:
            for block in range(0, len(own), _BLOCK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([windows]), pa.array([own[block: block + _BLOCK].tobytes()], pa.binary())],
                    names=["block", "windows", "part"])

    return run


def _average(batches):
    """One row per block of batches: its mean, weighted by windows."""
    sums: dict[int, np.ndarray] = {}
    seen: dict[int, int] = {}
    for batch in batches:
        for block, windows, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums[block] = sums.get(block, 0.0) + np.frombuffer(part, np.float32).astype(np.float64) * windows
            seen[block] = seen.get(block, 0) + windows
    if sums:
        parts = [(sums[b] / seen[b]).astype(np.float32).tobytes() for b in sums]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(parts, pa.binary())], names=["block", "part"])


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    flat: np.ndarray


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, share: float = SHARE,
          rate: float = 0.2) -> Model:
    rows = id_text(docs, id_col, text_col)
    vocabulary = build_vocabulary(rows)
    flat = fresh(side=vocabulary.side)
    for turn in range(rounds):
        parts = rows.mapInArrow(_train_partition(vocabulary, flat, turn, rounds, share, rate),
                                "block bigint, windows bigint, part binary")
        mean = parts.repartition("block").mapInArrow(_average, "block bigint, part binary")
        for row in mean.collect():
            values = np.frombuffer(row["part"], np.float32)
            flat[row["block"]: row["block"] + len(values)] = values
    return Model(vocabulary, flat)


def totals(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, summed log probability) of every text."""
    words = Words(lowered(texts))
    tokens = Tokens(model.vocabulary.tokens(words), words.count())
    e, c, _, _ = _parts(model.flat)
    logs = np.zeros(tokens.n)
    for at in range(0, tokens.n, _CHUNK):
        to = min(at + _CHUNK, tokens.n)
        near, beyond = tokens.around(at, to)
        logs[at:to] = _log_probabilities(model.flat, _hidden(e, c, np.take(e, near, axis=0), beyond), near[WINDOW: WINDOW + to - at])
    sums = np.concatenate([[0.0], np.cumsum(logs)])
    return words.count(), sums[words.bounds[1:]] - sums[words.bounds[:-1]]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, log_prob, mean_log_prob."""
    def run(texts: pa.Array) -> pa.Array:
        n, total = totals(texts, model)
        return pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), pa.array(total), pa.array(total / np.maximum(n, 1))],
                                          names=["n_tokens", "log_prob", "mean_log_prob"])

    scorer = column_udf(run, "struct<n_tokens:bigint,log_prob:double,mean_log_prob:double>")
    return docs.select(F.col(id_col), scorer(F.col(text_col)).alias("found")).select(id_col, "found.*")
