"""Words and word shingles of whole Arrow text columns as numpy arrays.

The operators that run Python inside tasks share these helpers. They work on
the UTF-8 bytes of an Arrow string array, with no Python string per word:
a table marks the bytes that belong to words, a prefix sum of byte * BASE**i
(mod 2**64) gives every word's 64-bit hash by one subtraction.

A *word* is a longest run of ASCII letters, ASCII digits and characters
outside ASCII: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased
text. A text of one to four words has one shingle, all of its words; an empty
text has none.

Temporary arrays are built for ``BLOCK`` bytes at a time, cut between words, so
one very long text needs no more than its words' own arrays (20 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
SHINGLE = 5
_U = np.uint64
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_COMBINE = 0xD6E8FEB86659FD93

WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x61:0x7B] = True
WORD_BYTE[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i <= n, kept per process."""
    if len(_powers.get("up", ())) <= n:
        size = max(n, BLOCK) + 1
        for key, base in (("up", BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit (a bijection)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def lowered(texts: pa.Array, ascii_only: bool = False) -> pa.Array:
    """Null as empty, lower case (A-Z only, or every letter)."""
    texts = pc.fill_null(texts, "")
    return pc.ascii_lower(texts) if ascii_only else pc.utf8_lower(texts)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls; offsets[0] is 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, at, data = texts.buffers()
    if at is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(at, width)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """(from, to) row ranges of at most ``max_bytes`` of text, one row at least."""
    _, offsets = raw(pc.fill_null(texts, ""))
    row, n = 0, len(texts)
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1
        to = min(max(to, row + 1), n)
        yield row, to
        row = to


class Words:
    """Words of an array of texts.

    ``start``/``end``: byte places in ``data``; ``hash``: 64 bits;
    ``bounds[i]:bounds[i+1]``: the words of text i.
    """

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = raw(texts)
        self.start, self.end, self.hash = self._words()
        self.bounds = np.searchsorted(self.start, self.offsets)

    def _words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets, n = self.data, self.offsets, len(self.data)
        out: list[tuple[np.ndarray, ...]] = []
        at = 0
        while at < n:
            to = self._cut(at)
            block = data[at:to]
            inside = WORD_BYTE[block]
            edges = offsets[np.searchsorted(offsets, at, "right"): np.searchsorted(offsets, to, "left")] - at
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            edges = edges[(edges > 0) & (edges < to - at)]
            first[edges] = inside[edges]
            last[edges - 1] = inside[edges - 1]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            up, down = _power_tables(to - at)
            sums = np.zeros(to - at + 1, dtype=_U)
            np.cumsum(block * up[: to - at], out=sums[1:])
            out.append((s + at, e + at, mix((sums[e] - sums[s]) * down[s])))
            at = to
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _cut(self, at: int) -> int:
        """End of the block that begins at ``at``: a text's end or between words."""
        n = len(self.data)
        to = at + BLOCK
        if to >= n:
            return n
        gaps = np.flatnonzero(~WORD_BYTE[self.data[at:to]])
        edge = self.offsets[np.searchsorted(self.offsets, to, "right") - 1]
        best = max(int(gaps[-1]) + 1 + at if len(gaps) else at, int(edge))
        if best > at:
            return best
        far = np.flatnonzero(~WORD_BYTE[self.data[to:]])  # one word longer than a block
        end = int(far[0]) + to if len(far) else n
        return min(end, int(self.offsets[np.searchsorted(self.offsets, at, "right")]))

    def count(self) -> np.ndarray:
        return np.diff(self.bounds)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()


def word_hash(word: str) -> int:
    """The hash that ``Words`` gives to this (lower-cased) word."""
    h = 0
    for i, b in enumerate(word.encode()):
        h += b * pow(BASE, i, 1 << 64)
    return int(mix(np.array([h & ((1 << 64) - 1)], dtype=_U))[0])


def shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word, text) of every shingle, in the order of the texts."""
    h, bounds = words.hash, words.bounds
    n = np.diff(bounds)
    total = len(h)
    if total == 0:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    summed = h.copy()
    power = 1
    for j in range(1, min(k, total)):
        power = power * _COMBINE % (1 << 64)
        summed[: total - j] += h[j:] * _U(power)
    whole = np.ones(total, dtype=bool)
    for j in range(1, k):
        whole[bounds[1:][n >= j] - j] = False
    for i in np.flatnonzero((n > 0) & (n < k)):  # one shingle of all words
        value, power = k - int(n[i]), 1
        for x in h[bounds[i]: bounds[i + 1]]:
            value = (value + int(x) * power) % (1 << 64)
            power = power * _COMBINE % (1 << 64)
        summed[bounds[i]] = value
        whole[bounds[i]] = True
    first = np.flatnonzero(whole)
    return mix(summed[first]), first, np.searchsorted(bounds, first, "right") - 1


def distinct_per_text(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs sorted by text, then value."""
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], text[new]
