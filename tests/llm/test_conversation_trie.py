import hashlib
import random
import zlib

import numpy as np

from tidewatch.llm import conversation_trie as trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_by_force(rows):
    """Nodes of (conv_id, turn, role, text) rows, from their definition."""
    turns: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            turns.setdefault(conv, []).append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members: dict = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {n: 0 for n in members}, {n: 0 for n in members}
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children.get(n, [])), leaves[n], saved[n],
                   hashlib.sha256(",".join(str(c) for c in sorted(c for c in m if built[c] == n)).encode()).hexdigest())
                  for n, m in members.items())


def found(frame, **kw):
    out = trie.prefix_trie(frame, **kw)
    assert out.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


def made(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_against_brute_force_on_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert found(frame, shard_rows=200, id_block=7) == trie_by_force([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])


def test_long_conversations_copies_ties_and_absent_bases(spark):
    random.seed(5)
    rows = []
    for c in [*range(-130, -90), *range(0, 30), *range(150, 190), *range(300, 330)]:
        length = random.choice([1, 2, 3, 5, 8, 13, 40 if c % 7 == 0 else 4])
        path = random.choice("abc")
        rows += [(c, random.choice([None, k, k // 2]), random.choice(["user", None]), None if k == 3 else path * (k % 5)) for k in range(length)]
    rows += [(c, k, "user", "same") for c in (600, 601, 602, 655, 656) for k in range(61)]
    rows += [(None, 1, "user", "no conversation"), (700, 0, "é", "漢字" * 50_000)]
    frame = made(spark, rows)
    expected = trie_by_force(rows)
    assert any(r[1] > 50 for r in expected) and any(r[3] > 1 and r[1] > 8 for r in expected)
    for segment in (6, 9, 4096):
        assert found(frame, segment=segment, shard_rows=40, id_block=16) == expected
    assert found(frame.limit(0)) == []


def test_perfect_hash_is_minimal_and_knows_its_keys():
    rng = np.random.default_rng(1)
    key1, key2 = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    key1[:2500] = key1[0]  # equal halves
    nodes = trie.PerfectHash(key1[:4000], key2[:4000])
    slots = nodes.slots(key1, key2)
    assert sorted(slots[:4000]) == list(range(4000)) and (slots[4000:] == -1).all()
    assert trie.PerfectHash(key1[:0], key2[:0]).slots(key1, key2).max() == -1
