import random
import re

from tidewatch.llm import ngram_join
from tidewatch.llm.decontamination import contained_items, decontaminate
from tidewatch.llm.ngram_join import keep_one_per_class, near_duplicates

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text):
    words = WORD.findall((text or "").lower())
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_by_force(pairs, threshold=0.8):
    sets: dict = {}
    for i, t in pairs:
        sets.setdefault(shingle_set(t), []).append(i)
    some = [s for s in sets if s]
    parent = {s: s for s in some}
    degree = dict.fromkeys(some, 0)

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for a in range(len(some)):
        for b in range(a):
            x, y = some[a], some[b]
            if len(x & y) >= threshold * len(x | y) - 1e-9:
                degree[x] += 1
                degree[y] += 1
                parent[root(x)] = root(y)
    least: dict = {}
    for s in some:
        ids = [i for i in sets[s] if i is not None]
        if ids:
            least[root(s)] = min(least.get(root(s), ids[0]), *ids)
    return sorted(((i, least.get(root(s)), degree[s], len(sets[s])) if (s := shingle_set(t)) else (i, i, 0, 1)
                   for i, t in pairs), key=str)


def near_rows(spark, groups=4, per_group=30):
    """Groups of near copies around the threshold, with shared passages."""
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = random.sample(vocabulary, 30)
    out = []
    for _ in range(groups):
        base = random.sample(vocabulary, 120) + passage
        for _ in range(per_group):
            words = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 3, 5, 9])):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            out.append((len(out), " ".join(words)))
    return spark.createDataFrame(out, "doc_id long, text string").repartition(5), out


def test_near_duplicates_against_brute_force(spark, docs, odd, rows, none):
    df, pairs = near_rows(spark)
    for block in (256, 7):  # a small block makes every dense trie node split
        got = sorted((tuple(r) for r in near_duplicates(df, block_sets=block).collect()), key=str)
        assert got == near_by_force(pairs)
    for frame in (docs, odd):
        pairs = [(r.doc_id, r.text) for r in frame.collect()]
        assert sorted((tuple(r) for r in near_duplicates(frame).collect()), key=str) == near_by_force(pairs)
    assert near_duplicates(none).count() == 0


def test_keep_one_per_class(spark, odd):
    df, pairs = near_rows(spark, 3, 10)
    expected = sorted({c for _, c, _, _ in near_by_force(pairs)})
    kept = keep_one_per_class(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == expected
    kept = [r.doc_id for r in keep_one_per_class(odd).collect()]
    assert 10 not in kept and kept.count(None) == 2 and {1, 2, 3, 4, 5, 6, 7, 9} <= set(kept)


def test_depth_reaches_recall():
    depth = ngram_join.stop_depth(0.8)
    assert 1 - (1 - 0.8 ** depth) ** ngram_join.TREES >= ngram_join.RECALL
    assert depth == ngram_join.LEVELS or 1 - (1 - 0.8 ** (depth + 1)) ** ngram_join.TREES < ngram_join.RECALL


def test_pair_depths_reach_recall_for_every_possible_similarity():
    import numpy as np

    for threshold in (0.5, 0.8, 0.9):
        floor = ngram_join.stop_depth(threshold)
        for total in range(2, 200):
            depth = int(ngram_join.pair_depths(np.array([total]), threshold)[0])
            possible = [c / (total - c) for c in range(1, total // 2 + 1) if c >= threshold * (total - c) - 1e-9]
            least = min(possible, default=1.0)
            assert depth == max(floor, ngram_join.stop_depth(least)), (threshold, total)
    assert len(set(ngram_join.pair_depths(np.arange(2, 60), 0.8).tolist())) > 1


def test_short_texts_of_every_size_against_brute_force(spark):
    """Pairs whose sizes let their prefix stay long, and pairs whose sizes do not."""
    random.seed(8)
    pairs = []
    for n in range(1, 45):
        base = [f"s{n}x{i}" for i in range(n)]
        for _ in range(4):
            words = list(base)
            words = words[random.randrange(2):] + [f"t{random.randrange(9)}" for _ in range(random.randrange(3))]
            pairs.append((len(pairs), " ".join(words)))
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_duplicates(df).collect()), key=str) == near_by_force(pairs)


def test_rows_of_a_set_with_many_copies(spark):
    from tidewatch.llm.shared import HUB_LINKS

    size = 2 * HUB_LINKS + 5
    base = [f"word{i}" for i in range(40)]
    pairs = [(3 + i % (size // 2), " ".join(base)) for i in range(size)] + [(1, " ".join([*base, "more"])), (2, "else")]
    got = sorted(tuple(r) for r in near_duplicates(spark.createDataFrame(pairs, "doc_id long, text string")).collect())
    assert got == sorted(near_by_force(pairs))


def test_components_with_hubs(spark):
    from tidewatch.llm.shared import HUB_LINKS, components

    size = 3 * HUB_LINKS
    star = [(10_000, 10_001 + i) for i in range(size)]  # one hub
    chain = [(k, k + 1) for k in range(50, 90)] + [(90, 10_000 + size)]  # joined to the star's last leaf
    other = [(i, 200_000) for i in range(100_000, 100_000 + size)]  # a hub that is its largest node
    got = {r.node: r.label for r in components(spark.createDataFrame(star + chain + other + [(7, 7)], "a long, b long")).collect()}
    nodes = {x for e in star + chain + other for x in e}
    assert got == {x: 100_000 if x >= 100_000 else 50 for x in nodes}


def test_common_shingles_both_ways():
    import numpy as np

    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, 200)).astype(np.uint64) for _ in range(60)]
    i, j = np.triu_indices(60, 1)
    expected = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)]
    assert ngram_join.common_shingles(sets, i, j).tolist() == expected  # dense: matrix products
    assert ngram_join.common_shingles(sets, i[:3], j[:3]).tolist() == expected[:3]


def contained_by_force(pairs, items, threshold=0.8):
    out = []
    for i, t in pairs:
        have = shingle_set(t)
        for item, text in items:
            want = shingle_set(text)
            if want and len(want & have) >= threshold * len(want) - 1e-9:
                out.append((i, item, len(want & have), len(want)))
    return sorted(set(out), key=str)  # equal rows are reported once


def test_contained_items_against_brute_force(spark, docs, odd, none):
    random.seed(6)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [(k, " ".join(random.sample(vocabulary, n))) for k, n in enumerate([1, 2, 4, 5, 6, 9, 17, 40, 90])]
    items += [(100, None), (101, ""), (None, "one two"), (102, "ALPHA beta, gamma delta epsilon zeta")]
    pairs = []
    for k in range(120):
        words = random.sample(vocabulary, 200)
        item = random.choice(items[:9])[1].split()
        cut = [w if random.random() > 0.03 else "x" for w in item]
        pairs.append((k, " ".join(words[:50] + cut + words[50:])))
    pairs += [(r.doc_id, r.text) for r in odd.collect()] + [(500, items[1][1]), (501, items[2][1].upper())]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    tests = spark.createDataFrame(items + items[3:4], "item_id int, text string")
    got = [tuple(r) for r in contained_items(df, tests).select("doc_id", "item_id", "matched", "n_shingles").collect()]
    assert sorted(got, key=str) == contained_by_force(pairs, items)
    assert contained_items(none, tests).count() == 0 and contained_items(df, tests.limit(0)).count() == 0


def test_decontaminate(spark, docs, odd):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    bad = {i for i, *_ in contained_by_force(pairs, [(r.item_id, r.text) for r in items.collect()])}
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(
        i for i, _ in pairs if i not in bad)
    tests = spark.createDataFrame([(1, "one two")], "item_id int, text string")
    assert decontaminate(odd, tests).count() == odd.count() - 4


def test_two_texts_of_one_id_are_judged_apart(spark):
    near = [f"word{i}" for i in range(60)]
    rows = [(1, " ".join(near)), (2, " ".join([*near[:-1], "other"])), (2, "an unrelated text of its own about another matter"),
            (None, " ".join([*near[:-1], "third"])), (None, "a text without any id that nothing else resembles at all")]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, `first` int")
    kept = keep_one_per_class(frame)
    assert kept.columns == frame.columns and sorted(r["first"] for r in kept.collect()) == [0, 2, 3, 4]
    same = spark.createDataFrame([(7, " ".join(near), 0), (7, " ".join([*near[:-1], "other"]), 1)], "doc_id bigint, text string, n int")
    assert keep_one_per_class(same).count() == 1
