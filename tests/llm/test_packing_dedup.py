import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import packing
from tidewatch.llm.exact_dedup import distinct_rows, exact_dedup

PATH = __import__("public_tokenizers").path("byte_bpe_50k.json")


def check_packed(packed, rows, size):
    by_sequence: dict = {}
    by_doc: dict = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in by_sequence.values():
        places.sort()
        assert places[0][0] == 0 and sum(n for _, n in places) <= size
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
    for doc_id, text in rows:
        ids = packing.reference_ids(PATH, text or "") + [0]
        pieces = sorted(by_doc.pop(doc_id), key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // size)))
        assert sum(r.length for r in pieces) == len(ids) and all(r.length == size for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
    assert not by_doc
    return len(by_sequence)


def test_pack_round_trip_and_tightness(docs, rows):
    packed = packing.pack(docs.repartition(7)).collect()
    used = check_packed(packed, [(r["doc_id"], r["text"]) for r in rows], 2048)
    assert used <= 1.03 * sum(r.length for r in packed) / 2048  # seven tiny partitions of about 28 documents


def test_pack_merges_up_the_tree_and_deals_out_large_levels(spark):
    random.seed(3)
    texts = [(i, " a" * random.randint(0, 60)) for i in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(16)
    for fan_in, max_items in ((4, 200_000), (8, 60)):
        packed = packing.pack(df, max_tokens=64, near=0, fan_in=fan_in, max_items=max_items).collect()
        used = check_packed(packed, texts, 64)
        assert used <= 1.1 * sum(r.length for r in packed) / 64  # partitions of 25 pieces, half of them over half a bin


def test_no_two_bins_could_be_merged_at_any_number_of_groups(spark):
    """Small and large pieces, with groups so small that bins are dealt anew."""
    random.seed(11)
    texts = [(i, " a" * random.choice([1, 5, 20, 33, 36, 40, 50, 58])) for i in range(3000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(12)
    used = set()
    for max_items in (200_000, 400, 40):
        packed = packing.pack(df, max_tokens=64, near=0, max_items=max_items).collect()
        used.add(check_packed(packed, texts, 64))
        fill: dict = {}
        for r in packed:
            fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
        smallest = sorted(fill.values())[:2]
        assert sum(smallest) > 64
    assert max(used) <= 1.02 * min(used)


def test_pack_odd_rows(odd, none):
    packed = packing.pack(odd).collect()
    assert sum(r.doc_id is None for r in packed) == 2 and sum(r.doc_id == 8 for r in packed) == 2
    assert {r.length for r in packed if r.doc_id in (2, 3)} == {1}
    assert packing.pack(none).count() == 0


def test_tiktoken_ids_are_those_of_tokenizers():
    random.seed(5)
    encode = packing.Encoder(PATH)
    for _ in range(3000):
        text = "".join(chr(random.choice([random.randrange(0x80), random.randrange(0x2500), random.randrange(0xD800),
                                          random.randrange(0x10000, 0x30000), 0x20, 0x1D, 0x85, 0x27])) for _ in range(12))
        assert np.frombuffer(encode(text), "<u4").tolist() == packing.reference_ids(PATH, text)
    text = "a<|endoftext|>b"
    assert np.frombuffer(encode(text), "<u4").tolist() == packing.reference_ids(PATH, text)


def expected_dedup(pairs):
    groups: dict = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in pairs:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [None, "short"])
def test_exact_dedup(docs, odd, rows, none, digest):
    """With a digest of one bit nearly all texts collide: bytes tell them apart."""
    extra = {} if digest is None else {"digest": lambda t: F.crc32(t.cast("binary")) % 2}
    for df in (docs, odd):
        pairs = [(r.doc_id, r.text) for r in df.collect()]
        got = [tuple(r) for r in exact_dedup(df, **extra).collect()]
        assert sorted(got, key=str) == expected_dedup(pairs)
    assert exact_dedup(none, **extra).count() == 0


def test_distinct_rows(docs, odd, none):
    kept = distinct_rows(odd)
    assert kept.columns == odd.columns
    got = {r.text or "": r.doc_id for r in kept.collect()}
    assert len(got) == kept.count() == 7 and got["one two"] == 8 and got[""] == 3
    assert sorted(r.doc_id for r in distinct_rows(docs).collect()) == sorted(
        {t: i for i, t in sorted((r.doc_id, r.text) for r in docs.collect())}.values())
    assert distinct_rows(none).count() == 0


def test_exact_dedup_is_native(docs):
    from tests.llm.plans import assert_native

    assert_native(exact_dedup(docs))


def test_texts_with_very_long_runs():
    """Runs over which the regular expression of tiktoken overflows its stack, and
    runs of letters, digits and signs, as plain tokenizers encodes them."""
    encode = packing.Encoder(PATH)
    for text in (" " * 1_200_000 + "x", "\n" * 3_000_000 + "y", "a　" + " \t" * 700_000 + "b c", "ab" * 500_000,
                 "7" * 1_000_000, "word " * 300 + "!?" * 500_000 + " end"):
        assert packing.has_long_run(text)
        assert np.frombuffer(encode(text), "<u4").tolist() == packing.reference_ids(PATH, text)
    assert not packing.has_long_run("some ordinary words " * 100_000)
    for text in (" " * 3_999 + "x", "z" * 3_999 + " ", "\x1c!" * 3_000):  # up to the bound, by tiktoken
        assert np.frombuffer(encode(text), "<u4").tolist() == packing.reference_ids(PATH, text)


def test_added_tokens_are_read_as_plain_tokenizers_does():
    from tokenizers import Tokenizer

    plain, encode = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    for text in ("one two<|endoftext|>three", "<|endoftext|>", " <|endoftext|> <|endoftext|><|endoftext|>\n", "<|endoftext|",
                 "a<|endoftext|>" + " " * 5000 + "b"):
        ids = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == ids == packing.reference_ids(PATH, text)
    assert 50256 in np.frombuffer(encode("one two<|endoftext|>three"), "<u4")
