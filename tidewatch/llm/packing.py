"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing. Each input partition tokenises its documents,
cuts those longer than a sequence, and packs the pieces best-fit (largest
first). Full and nearly full bins are final at once. Underfull bins go up a
tree: ``fan_in`` neighbouring groups are merged, their bins are items of a new
best-fit round, and so on up to the root. A group holds about ``max_items``
bins at most: where a level would hold more, its bins are dealt over G groups by
hash. Best fit leaves a group at most one bin that is half full or less, and two
fuller bins never merge; so of such a round only that bin and the G emptiest others
of every group go on (G bins can take the G small ones of all groups), the rest are
closed. Rounds end with one group at every size, and then no two bins that are not
nearly full could be merged. (Beyond max_items / 4 groups, 10^10 bins, a group
hands on its max_items / 4 emptiest.)

Only piece descriptors (about 50 bytes each) move between tasks, never texts or
ids. Every round is cut in the shared checkpoint folder.

Defined cases: null text is empty (its document is the end id alone); rows with
a null or repeated id are packed like any other; a very long text is cut into as
many pieces as it needs; of bins with equal room any may be chosen; an empty table
gives no rows; only the id and the text are read, so no column's name can clash.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_text_size, cut, id_text

PIECE = ("id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
         "bin bigint, offset bigint, grp bigint, done boolean")
_ARROW = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("grp", pa.int64()),
                    ("done", pa.bool_())])

# Fixed value: how byte-level BPE of this vocabulary splits a text before its merges.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ANY_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")  # what its \s matches


def _ranks(path: str) -> dict[bytes, int]:
    """Byte strings of the vocabulary file of a byte-level ``tokenizers`` model:
    printable Latin-1 stands for itself, other bytes for U+0100 onwards."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in plain}
    byte.update({chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))})
    return {bytes(byte[c] for c in word): i for word, i in vocabulary.items()}


_RUN = 2000
COMPARE = 50  # every so many texts of a task are encoded by tokenizers too


def has_long_run(text: str) -> bool:
    """True for every text with 2 * _RUN or more characters in a row that are all
    white space or all none: such a run fills a whole aligned part of _RUN."""
    parts = (text[at: at + _RUN] for at in range(0, len(text) - _RUN + 1, _RUN))
    return any(part.isspace() or not _ANY_SPACE.search(part) for part in parts)


def _added(path: str) -> dict[str, int]:
    """The file's added tokens, found as they are written."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("an added token of this vocabulary is not found by its string alone")
    return {t["content"]: t["id"] for t in added}


class Encoder:
    """Ids of a text as little-endian 32-bit bytes.

    The ids are those of ``tokenizers`` with this vocabulary file and
    add_special_tokens=False: none is added, but the string of an added token
    of the file (``<|endoftext|>``) in a text is that token's one id.
    They are computed by ``tiktoken`` over the same vocabulary, which needs a
    third of the time; the first text of every task and every 50th after it are
    encoded by both, and a difference stops the task. Texts with very long pre-tokens, on which the
    regular expression of ``tiktoken`` overflows its stack, are encoded by
    ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken

        self._path, self._seen = path, 0
        added = _added(path)
        encoding = tiktoken.Encoding("byte_bpe", pat_str=_SPLIT, mergeable_ranks=_ranks(path), special_tokens=added)
        self._encode = partial(encoding.encode, allowed_special=set(added), disallowed_special=())

    def __call__(self, text: str) -> bytes:
        if has_long_run(text):
            return np.array(reference_ids(self._path, text), dtype="<u4").tobytes()
        ids = self._encode(text)
        if self._seen % COMPARE == 0 and ids != reference_ids(self._path, text):
            raise ValueError("tiktoken and tokenizers differ on this vocabulary")
        self._seen += 1
        return np.array(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def reference_ids(path: str, text: str) -> list[int]:
    return _tokenizer(path).encode(text, add_special_tokens=False).ids


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, its offset there, fill of each bin), largest items
    first, each into the open bin that it leaves the least room in."""
    order = np.argsort(-sizes, kind="stable")
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_mask = 0
    where, at, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    for i in order.tolist():
        size = int(sizes[i])
        fitting = open_mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_no = room[free].pop()
            if not room[free]:
                open_mask &= ~(1 << free)
        else:
            free, bin_no = capacity, len(fill)
            fill.append(0)
        where[i], at[i] = bin_no, fill[bin_no]
        fill[bin_no] += size
        left = free - size
        if left:
            room[left].append(bin_no)
            open_mask |= 1 << left
    return where, at, np.array(fill, np.int64)


def _pieces_of(data: bytes, max_tokens: int):
    """(piece, start, length, crc32); only the first piece may be shorter."""
    total = len(data) // 4
    first = total if total <= max_tokens else (total % max_tokens or max_tokens)
    start = 0
    piece = 0
    while start < total:
        length = first if piece == 0 else max_tokens
        yield piece, start, length, zlib.crc32(data[4 * start: 4 * (start + length)])
        start, piece = start + length, piece + 1


def _local(path: str, end_id: int, max_tokens: int, near: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encode = Encoder(path)
        part = TaskContext.get().partitionId()
        cols: list[list] = [[], [], [], [], []]

        def take(batch):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for values in _pieces_of(encode(text) + end, max_tokens):
                    for col, value in zip(cols, (key, *values), strict=True):
                        col.append(value)

        for _ in by_text_size(batches, take):
            pass
        if not cols[0]:
            return
        where, at, fill = best_fit(np.array(cols[3], np.int64), max_tokens)
        table = pa.table([*cols, where + (part << 32), at, np.full(len(where), part),
                          fill[where] >= max_tokens - near], schema=_ARROW)
        yield from table.to_batches(max_chunksize=50_000)

    return run


def _round(max_tokens: int, near: int, last: bool, emptiest: int | None):
    """``emptiest``: how many of a group's bins over half full go on (None: all)."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bin", "ascending"), ("offset", "ascending")])
        old = table["bin"].to_numpy()
        length = table["length"].to_numpy()
        offset = table["offset"].to_numpy()
        bins, first, which = np.unique(old, return_index=True, return_inverse=True)
        sizes = np.bincount(which, weights=length).astype(np.int64)
        where, at, fill = best_fit(sizes, max_tokens)
        name = np.full(len(fill), np.iinfo(np.int64).max)
        np.minimum.at(name, where, bins)
        done = (fill >= max_tokens - near) | last
        if emptiest is not None:
            over = np.flatnonzero(2 * fill > max_tokens)
            done[over[np.argsort(fill[over], kind="stable")][emptiest:]] = True
        keep = {n: table[n] for n in ("id", "piece", "start", "length", "ids_crc32", "grp")}
        return pa.table({**keep, "bin": name[where][which], "offset": offset + at[which],
                         "done": done[where][which]}).select(_ARROW.names).cast(_ARROW)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048,
         tokenizer_path: str | None = None, end_id: int = 0, near: int = 8, fan_in: int = 8,
         max_items: int = 200_000) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``near``: a bin with at most that much room is closed before the root.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    rows = cut(id_text(docs, id_col, text_col).mapInArrow(_local(tokenizer_path, end_id, max_tokens, near), PIECE))
    finished, groups, last = [rows.where("done")], None, False
    rest = rows.where("not done")
    while not last:
        stats = rest.agg(F.count_if(F.col("offset") == 0).alias("bins"), F.max("grp").alias("top")).first()
        if not stats["bins"]:
            break
        groups = groups or int(stats["top"]) + 1
        fewer, bound = -(-groups // fan_in), -(-stats["bins"] // max_items)
        if fewer >= bound:  # up the tree: neighbours meet
            deal, emptiest = F.floor(F.col("grp") / F.lit(fan_in)), None
        else:  # too many underfull bins for one group each: deal them anew
            deal = F.pmod(F.xxhash64("bin", F.lit(groups), F.lit(stats["bins"])), F.lit(bound))
            emptiest = min(bound, -(-max_items // 4))
        groups = max(fewer, bound)
        last = groups == 1
        done = cut(rest.withColumn("grp", deal.cast("bigint")).groupBy("grp")
                   .applyInArrow(_round(max_tokens, near, last, emptiest), PIECE))
        finished.append(done.where("done"))
        rest = done.where("not done")
    out = finished[0]
    for df in finished[1:]:
        out = out.unionByName(df)
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
                      F.col("bin").alias("sequence_id"), "offset")
