"""First-fit decreasing packing with a tournament tree, in randomised groups.

Rows are dealt to tasks by a hash of id and text, so neighbours in the input,
sources and copies are spread. A task tokenises its rows; whole sequences are cut
off long documents at once, and what is left of each document (shorter than a
sequence) is an item. Every ``group_items`` items make a group, packed by itself:

1. First-fit decreasing. The leaves of a tournament tree hold the room of the
   group's bins, each inner node the larger of its two; going left wherever the
   left side has room finds the first bin that fits in log2(bins) steps.
2. Closing. A sequence is padded to ``max_tokens`` unless its length is a power
   of two, and documents may be cut: the emptiest bins are cut up to fill the
   fullest ones, and the one bin left over is cut into powers of two. So no
   sequence of a group has padding, and a filled bin costs one cut at most.

Texts are shuffled once; a task holds the ids of one group (``group_items`` items
of under ``max_tokens`` ids) and one text. Pieces are then cut in the shared
checkpoint folder, so every reader sees the same packing.

Defined cases: null and empty texts are the end id alone; the rows of a null or
repeated id are packed each by itself; equal rows (same id, same text) are dealt
to one task, which still packs them group by group; equal sizes are packed in the
order of arrival; texts of any length are cut whole, in parts of bounded size; an
empty table gives no rows; other columns of the input are never read, so their
names cannot clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_text_size, cut, id_text
from .tokens import ByteBpe

_COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items of each bin: largest items first, each into the first bin with room."""
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, node = sizes[item], 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(item)
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins


def _is_power(n: int) -> bool:
    return n & (n - 1) == 0


def close_bins(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """The same (item, start, length) pieces, cut so that every bin is full or a
    power of two long."""
    done, rest = [], []
    for pieces in bins:
        fill = sum(p[2] for p in pieces)
        (done if fill == capacity or _is_power(fill) else rest).append((fill, pieces))
    rest.sort(key=lambda b: -b[0])

    def take(pieces: list, n: int) -> list:
        """The last ``n`` ids' worth of pieces, cut off ``pieces``."""
        out = []
        while n:
            item, start, length = pieces.pop()
            moved = min(n, length)
            out.append((item, start + length - moved, moved))
            if moved < length:
                pieces.append((item, start, length - moved))
            n -= moved
        return out

    full, last = 0, len(rest) - 1
    while full < last:
        (fill, pieces), (spare, donor) = rest[full], rest[last]
        moved = min(capacity - fill, spare)
        pieces.extend(take(donor, moved))
        rest[full], rest[last] = (fill + moved, pieces), (spare - moved, donor)
        if fill + moved == capacity:
            full += 1
        if spare == moved or _is_power(spare - moved):  # nothing left, or nothing to pad
            last -= 1
    out = [pieces for _, pieces in done] + [pieces for fill, pieces in rest if fill == capacity or (fill and _is_power(fill))]
    for fill, pieces in rest:
        if fill and fill != capacity and not _is_power(fill):  # one at most
            for bit in range(fill.bit_length() - 1, -1, -1):
                if fill >> bit & 1:
                    out.append(take(pieces, 1 << bit))
    return out


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _pack_task(path: str, end_id: int, capacity: int, group_items: int, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), *((c, pa.int64()) for c in _COLUMNS)])

    def run(batches):
        encode = ByteBpe(path, special=True)
        sequence = TaskContext.get().partitionId() << 40
        items: list[tuple] = []  # (id, start of its document's rest, all ids of the document, the rest)
        rows: list[tuple] = []

        def close_group():
            nonlocal sequence
            sizes = [len(ids) for *_, ids in items]
            bins = [[(i, 0, sizes[i]) for i in b] for b in first_fit_decreasing(sizes, capacity)]
            for pieces in close_bins(bins, capacity):
                offset = 0
                for i, start, length in pieces:
                    key, first, total, ids = items[i]
                    rows.append((key, first + start, length, _crc(ids[start: start + length]), total, sequence, offset))
                    offset += length
                sequence += 1
            items.clear()

        def add(batch):
            nonlocal sequence
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text), np.uint32(end_id))
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    rows.append((key, start, capacity, _crc(ids[start: start + capacity]), len(ids), sequence, 0))
                    sequence += 1
                if whole < len(ids):
                    items.append((key, whole, len(ids), ids[whole:].copy()))
                if len(items) >= group_items:
                    close_group()
            return written() if len(rows) >= 50_000 else None

        def written():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                                             schema=schema)
            rows.clear()
            return out

        yield from by_text_size(batches, add)
        if items:
            close_group()
        if rows:
            yield written()

    return run


def pack_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048,
                tokenizer_path: str | None = None, end_id: int = 1, group_items: int = 8192) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``max_tokens`` should be a power of two, so that a full sequence needs no padding either way.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    columns = ", ".join(f"{c} bigint" for c in _COLUMNS)
    packed = rows.repartition(F.xxhash64("id", "text")).mapInArrow(
        _pack_task(tokenizer_path, end_id, max_tokens, group_items, to_arrow_type(kind)),
        f"id {kind.simpleString()}, {columns}")
    return cut(packed).withColumnRenamed("id", id_col)
