"""Token ids of long texts in parts, and the byte strings of token ids.

A text is cut only before a blank that follows a character that is neither white
space nor U+2581. Both kinds of tokenizer give the same ids for the parts as for
the whole: byte-level BPE starts a new pre-token there, and no piece of the other
vocabulary holds U+2581 after another character (checked when it is loaded).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .packing import _SPLIT, COMPARE, _added, _ranks, has_long_run

PART = 1 << 18  # characters
BLANK = "▁"  # fixed value: how sentencepiece writes a blank


def parts(text: str, size: int = PART) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters; all but the first begin with a blank."""
    at = 0
    while len(text) - at > size:
        k = text.find(" ", at + size)
        while k > 0 and (text[k - 1].isspace() or text[k - 1] == BLANK):
            k = text.find(" ", k + 1)
        if k < 0 or k == len(text) - 1:
            break
        yield text[at:k]
        at = k
    yield text[at:]


@lru_cache(maxsize=4)
def _reference(path: str, special: bool):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    return tokenizer


@lru_cache(maxsize=4)
def _encoding(path: str, special: bool):
    import tiktoken

    return tiktoken.Encoding("byte_bpe", pat_str=_SPLIT, mergeable_ranks=_ranks(path),
                             special_tokens=_added(path) if special else {})


class ByteBpe:
    """Ids by a byte-level BPE file of ``tokenizers`` without added tokens.

    ``special``: the string of an added token in a text is that token's one id
    (as ``tokenizers`` does by itself); otherwise it is plain text. The ids are
    computed by ``tiktoken`` over the same vocabulary, in a third of the time.
    The first text of a task and every 50th after it are encoded by both, and a
    difference stops the task. Very long pre-tokens go to ``tokenizers`` itself.
    """

    def __init__(self, path: str, special: bool):
        self._path, self._special, self._seen = path, special, 0
        self._encoding = _encoding(path, special)
        self._allowed = set(_added(path)) if special else set()

    def _part(self, text: str, compare: bool) -> np.ndarray:
        slow = has_long_run(text)
        if slow or compare:
            right = np.array(_reference(self._path, self._special).encode(text, add_special_tokens=False).ids, np.uint32)
            if slow:
                return right
        ids = self._encoding.encode_to_numpy(text, allowed_special=self._allowed, disallowed_special=())
        if compare and not np.array_equal(ids, right):
            raise ValueError("tiktoken and tokenizers differ on this vocabulary")
        return ids

    def __call__(self, text: str) -> np.ndarray:
        compare = self._seen % COMPARE == 0
        self._seen += 1
        found = [self._part(part, compare) for part in parts(text)]
        return found[0] if len(found) == 1 else np.concatenate(found)


def byte_strings(path: str) -> pa.LargeBinaryArray:
    """The bytes of every id of a byte-level BPE file (added tokens: their text)."""
    words = {i: word for word, i in _ranks(path).items()}
    words.update({i: word.encode() for word, i in _added(path).items()})
    return pa.array([words.get(i, b"") for i in range(max(words) + 1)], pa.large_binary())


@lru_cache(maxsize=2)
def piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_ids(model, part: str, first: bool) -> np.ndarray:
    """Ids of one part; the model itself puts a blank in front."""
    return np.array(model.encode(part if first else part[1:]), np.uint32)


def piece_strings(model) -> pa.LargeBinaryArray:
    """The bytes of every id of a sentencepiece model with byte fallback."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if BLANK in piece.lstrip(BLANK):
            raise ValueError("a piece of this vocabulary spans words: long texts cannot be cut")
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(BLANK, " ").encode())
    return pa.array(out, pa.large_binary())
