import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import text_arrays as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
texts = st.lists(st.text(st.characters(codec="utf-8"), max_size=40), max_size=8)


@settings(max_examples=200, deadline=None)
@given(texts, st.sampled_from([3, 7, 1 << 20]))
def test_words_are_the_pattern_s_words(values, block):
    before, T.BLOCK = T.BLOCK, block
    try:
        words = T.Words(T.lowered(pa.array(values, pa.string()), ascii_only=True))
    finally:
        T.BLOCK = before
    for i, text in enumerate(values):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        found = WORD.findall(lower)
        at = range(words.bounds[i], words.bounds[i + 1])
        assert [words.word(j).decode() for j in at] == found
        assert [int(words.hash[j]) for j in at] == [T.word_hash(w) for w in found]


def test_shingles_match_word_tuples():
    values = ["a b c d e f", "a b c d e", "a b", "", "b a", None, "A  b, c d e f!", "a b c d e f a b c d e f"]
    words = T.Words(T.lowered(pa.array(values, pa.string())))
    value, first, text = T.shingles(words)
    expected = []
    for i, t in enumerate(values):
        w = WORD.findall((t or "").lower())
        expected += [(i, tuple(w[k:k + 5])) for k in range(max(1, len(w) - 4)) if w]
    assert text.tolist() == [i for i, _ in expected]
    by_words: dict = {}
    for h, (_, s) in zip(value.tolist(), expected, strict=True):
        assert by_words.setdefault(s, h) == h
    assert len(set(by_words.values())) == len(by_words)


def test_shingles_of_very_few_words():
    for text, count in (("", 0), ("a", 1), ("a b", 1), ("a b c d e", 1)):
        assert len(T.shingles(T.Words(pa.array([text])))[0]) == count


def test_slices_cover_all_rows_once():
    array = pa.array(["x" * n for n in (0, 5, 3, 100, 0, 1, 1)])
    parts = list(T.slices(array, 6))
    assert [i for a, b in parts for i in range(a, b)] == list(range(7))
    assert all(b - a == 1 or sum(len(x.as_py()) for x in array[a:b]) <= 6 for a, b in parts)
    sliced = pa.array(["left out", "ab c", "d"]).slice(1)
    words = T.Words(sliced)
    assert [words.word(i) for i in range(3)] == [b"ab", b"c", b"d"] and np.diff(words.bounds).tolist() == [2, 1]
