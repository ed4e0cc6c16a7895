import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tidewatch.llm import alignment, tokens

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of():
    """Byte-level alphabet of the published scheme: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def tokens_by_force(text, a, b, byte):
    whole = (" " + text).encode()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], []
    return list(zip(ids_a, np.cumsum([len(x) for x in bytes_a]).tolist())), list(zip(ids_b, np.cumsum([len(x) for x in bytes_b]).tolist()))


def align_by_force(rows):
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    byte = byte_of()
    docs, count = [], Counter()
    for key, text in rows:
        ta, tb = tokens_by_force(text, a, b, byte) if text else ([], [])
        ends = sorted({e for _, e in ta} & {e for _, e in tb})
        of_b = {e: y for y, e in tb}
        links = [(x, of_b[e]) for x, e in ta if e in of_b]
        groups = []
        ia = ib = 0
        for end in ends:
            ga, gb = [], []
            while ia < len(ta) and ta[ia][1] <= end:
                ga.append(str(ta[ia][0]))
                ia += 1
            while ib < len(tb) and tb[ib][1] <= end:
                gb.append(str(tb[ib][0]))
                ib += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        count.update(links)
        docs.append((key, ta, tb, groups, links))
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return sorted((-1 if key is None else key, len(ta), len(tb), len(groups), len(links), sum(count[x] == best[x[1]] for x in links),
                   sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if ta else "")
                  for key, ta, tb, groups, links in docs)


def found(frame, **kw):
    out = alignment.align(frame, **kw)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


def test_against_brute_force_on_the_table(docs, rows):
    expected = align_by_force([(r["doc_id"], r["text"]) for r in rows])
    assert found(docs.repartition(5)) == expected


def test_small_runs_merge_in_rounds(spark):
    rng = random.Random(7)
    pool = ["the ", "insurance", "é", "漢字", "▁", "  ", "\n", "<s>", "<|endoftext|>", "12345", "\x00", "ab", "!", "’", "\U0001f600"]
    rows = [(i % 60, "".join(rng.choices(pool, weights=[6, 4] + [1] * 13, k=rng.randint(0, 40)))) for i in range(90)] + [(None, "the insurance")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    expected = align_by_force(rows)
    assert any(r[1] == 0 and r[0] >= 0 for r in expected) and any(r[5] < r[4] for r in expected)
    assert found(frame, radix=3, fan=2, run_links=50) == expected


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd) == align_by_force(rows)
    assert found(none) == []


def test_long_texts_are_aligned_in_parts(spark):
    rng = random.Random(9)
    text = "".join(rng.choices(["word ", "  two", " é漢", "\n", " ", "x" * 9, ". "], k=260_000))
    assert len(list(tokens.parts(text))) > 2
    assert found(spark.createDataFrame([(1, text), (2, "word two")], "doc_id bigint, text string"), run_links=10_000) == align_by_force(
        [(1, text), (2, "word two")])
    model = tokens.piece_model(PATH_B)
    for _ in range(100):
        some = "".join(rng.choices(["word ", "  two", " é漢", "\n", " ", "▁", "x", ". "], k=60))
        ids = [i for k, part in enumerate(tokens.parts(some, 20)) for i in tokens.piece_ids(model, part, k == 0).tolist()]
        assert ids == model.encode(some)


def test_merge_adds_equal_keys():
    rng = np.random.default_rng(3)
    runs = []
    for n in (0, 1, 40, 1000, 333):
        keys = np.unique(rng.integers(0, 2000, n, dtype=np.uint64))
        runs.append((keys, rng.integers(1, 9, len(keys)).astype(np.uint64)))
    total = Counter()
    for keys, counts in runs:
        total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    keys, counts = alignment.merge_runs(runs, block=16)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == dict(total) and (np.diff(keys.astype(np.int64)) > 0).all()
