import random
import zlib

import numpy as np
import pytest

from tidewatch.llm import group_packing, tokens
from tidewatch.llm.packing import reference_ids

PATH = __import__("public_tokenizers").path("byte_bpe_50k.json")


def check(packed, rows, size):
    """Every id in exactly one piece, sequences gapless; padding in tokens."""
    by_sequence: dict = {}
    by_doc: dict = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    padding = 0
    for places in by_sequence.values():
        places.sort()
        fill = sum(n for _, n in places)
        assert places[0][0] == 0 and 0 < fill <= size and all(n > 0 for _, n in places)
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
        padding += 0 if fill & (fill - 1) == 0 else size - fill
    for doc_id, text in rows:
        ids = reference_ids(PATH, text or "") + [1]
        at = 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    return len(by_sequence), padding


def test_every_id_once_and_no_padding(docs, rows):
    packed = group_packing.pack_groups(docs).collect()
    used, padding = check(packed, [(r["doc_id"], r["text"]) for r in rows], 2048)
    assert padding == 0 and used <= sum(r.length for r in packed) / 2048 + 12 * 8


def test_small_groups(spark):
    random.seed(3)
    texts = [(i, " a" * random.randint(0, 90)) for i in range(300)]
    packed = group_packing.pack_groups(spark.createDataFrame(texts, "doc_id long, text string"), max_tokens=64, group_items=20).collect()
    assert check(packed, texts, 64)[1] == 0


def first_fit_by_force(sizes, capacity):
    room, bins = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        if k == len(room):
            room.append(capacity)
            bins.append([])
        room[k] -= sizes[i]
        bins[k].append(i)
    return bins


def test_the_tree_finds_the_first_bin():
    rng = random.Random(1)
    for n in (1, 2, 3, 17, 200):
        sizes = [rng.randint(1, 100) for _ in range(n)]
        assert group_packing.first_fit_decreasing(sizes, 100) == first_fit_by_force(sizes, 100)
    assert group_packing.first_fit_decreasing([], 100) == []


def test_closing_keeps_every_id():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(1, 63) for _ in range(rng.randint(1, 30))]
        bins = [[(i, 0, sizes[i]) for i in b] for b in group_packing.first_fit_decreasing(sizes, 64)]
        closed = group_packing.close_bins(bins, 64)
        ids = sorted((i, start + k) for b in closed for i, start, n in b for k in range(n))
        assert ids == sorted((i, k) for i, n in enumerate(sizes) for k in range(n))
        fills = [sum(n for *_, n in b) for b in closed]
        assert all(f & (f - 1) == 0 and 0 < f <= 64 for f in fills)
        assert len(closed) <= len(bins) + 6


def test_odd_rows(odd, none, rows):
    packed = group_packing.pack_groups(odd).collect()
    assert packed[0].__fields__ == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert sum(r.doc_id == 8 and r.start == 0 for r in packed) == 2 and sum(r.doc_id is None and r.start == 0 for r in packed) == 2
    assert {r.doc_tokens for r in packed if r.doc_id in (2, 3)} == {1}
    long = [r for r in packed if r.doc_id == 5]
    assert sum(r.length for r in long) == long[0].doc_tokens > 200_000
    assert group_packing.pack_groups(none).count() == 0


@pytest.mark.parametrize("special", [True, False])
def test_ids_of_long_texts_in_parts(special):
    encode = tokens.ByteBpe(PATH, special)
    reference = tokens._reference(PATH, special)
    rng = random.Random(4)
    alphabet = ["a", "Ab", " ", "  ", "\n", "\t", "é", "漢", "12", "'s", "!", "<|endoftext|>", "　", "▁", "x" * 30, "\x1c", "\x00"]
    for _ in range(300):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 200)))
        cut = list(tokens.parts(text, 20))
        assert "".join(cut) == text
        whole = reference.encode(text, add_special_tokens=False).ids
        assert encode(text).tolist() == whole
        assert [i for part in cut for i in encode(part).tolist()] == whole
    for text in ("z" * 300_000 + " " + "y" * 300_000, " " * 600_000 + "x", "\n" * 600_000 + "one two " * 60_000):
        assert encode(text).tolist() == reference.encode(text, add_special_tokens=False).ids
