"""N-gram Jaccard join: near-duplicate documents by a MinHash LSH forest.

Two documents are linked when the Jaccard similarity of their sets of distinct
word 5-gram shingles (64-bit hashes) is at least ``threshold``.

1. One scan turns each text into its shingle set, a 128-bit key of that set, and
   MinHash values for ``TREES`` trees of ``LEVELS`` levels (16 bits a value).
   Texts of equal sets are one *class of copies*; only its representative goes
   on, so copies are never paired.
2. A tree's label is its ``LEVELS`` values in order; the sorted labels of a tree are
   its prefix trie, and the sets that share a prefix with a set stand in one run
   around it. A set starts at its longest matched prefix, and the prefix is shortened
   value by value. How far depends on the two sets (``pair_depths``): shingles are whole
   numbers, so two sets of together S shingles that reach the threshold have a smallest
   possible similarity s(S) >= threshold, and the shortening ends for them at the longest
   prefix of d values for which the predicted recall, 1 - (1 - s(S)**d)**TREES, reaches
   ``recall``. No pair needs a shorter prefix than the threshold itself gives
   (``stop_depth``): subtries below that prefix are the units that Spark shuffles.
3. Members of such a subtrie with two or more sets are sorted by label in a task; pairs
   that share a long enough prefix are compared by all of
   their MinHash values. A subtrie with more than ``BLOCK_SETS`` members is split
   into blocks, and each pair of blocks is a task group of its own. A pair is
   taken only in the first tree where it meets, so it is seen once, and it is
   dropped only if its estimated similarity lies over 5 standard errors below
   the threshold. Pairs stay inside the task as lists of places; they never
   become rows.
4. Exact verification: the sets of the members that have a partner are rebuilt
   from their texts and every remaining pair's Jaccard similarity is computed
   exactly. A group returns one row per member: its number of links and the
   smallest member it is connected to.
5. Connected components of these links give the class id, the smallest
   document id of the component.

The work on a group of m mutually similar, different texts grows with its true
links, as counting them must. Memory and group sizes are bounded by ``BLOCK_SETS``; each
member is sent to m / ``BLOCK_SETS`` pairs of blocks, so a node hands out m * m /
``BLOCK_SETS`` rows: no more than its members up to ``BLOCK_SETS`` of them.

Defined cases: null text is empty; texts without words have no shingle, link to
nothing and are classes of their own; texts of one to four words have a
single shingle; rows with a null id never become a class id unless all of their
class are null; repeated rows are copies; rows of one id with different texts are
classed apart; very long texts are hashed whole, in parts of bounded size; an empty table
gives no rows; only id and text are read, so no other column's name can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import HUB_LINKS, by_text_size, components, cut, id_text, small
from .text_arrays import Words, lowered, mix, shingles

TREES, LEVELS = 24, 7
RECALL = 0.9999
BLOCK_SETS = 2048
_U = np.uint64
_WIDTH = 2 * LEVELS
_rng = np.random.default_rng(20)
_MULTIPLY = _rng.integers(1, 1 << 63, TREES * LEVELS, dtype=np.uint64) | _U(1)
_ADD = _rng.integers(0, 1 << 63, TREES * LEVELS, dtype=np.uint64)
_PART = 1 << 14  # shingles hashed at a time: fits the processor's cache


def stop_depth(threshold: float, recall: float = RECALL, trees: int = TREES, levels: int = LEVELS) -> int:
    """The longest shared prefix whose predicted recall reaches ``recall``."""
    depth = levels
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def pair_depths(total: np.ndarray, threshold: float, recall: float = RECALL) -> np.ndarray:
    """The prefix to which two sets of together ``total`` shingles are followed:
    ``stop_depth`` of the smallest similarity at or over ``threshold`` that sizes
    of that sum allow."""
    common = np.maximum(np.ceil(threshold * total / (1 + threshold) - 1e-9), 1)
    similarity = np.minimum(common / np.maximum(total - common, 1), 1.0)
    floor = stop_depth(threshold, recall)
    enough = [(1 - (1 - recall) ** (1 / TREES)) ** (1 / d) for d in range(floor + 1, LEVELS + 1)]
    return floor + np.searchsorted(np.array(enough), similarity - 1e-9, side="right")


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words = Words(lowered(texts))
    value, _, text = shingles(words)
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    return [np.unique(value[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def set_key(values: np.ndarray) -> bytes:
    """128 bits of a set, independent of order."""
    first = mix(values).sum(dtype=_U)
    second = mix(values ^ _U(0xA5A5A5A5DEADBEEF)).sum(dtype=_U) + _U(len(values))
    return int(first).to_bytes(8, "big") + int(second).to_bytes(8, "big")


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, (sets, TREES * LEVELS) of 16 bits, big-endian."""
    out = np.zeros((len(sets), TREES * LEVELS), dtype=">u2")
    some = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(some):  # as many whole sets as fill a part, or one longer set in parts
        to, size = at, 0
        while to < len(some) and (to == at or size + len(sets[some[to]]) <= _PART):
            size += len(sets[some[to]])
            to += 1
        group = [sets[i] for i in some[at:to]]
        if size > _PART:
            pieces = [group[0][k: k + _PART] for k in range(0, size, _PART)]
            low = np.min([[(p * m + a).min() for m, a in zip(_MULTIPLY, _ADD, strict=True)] for p in pieces], axis=0)
            least = low.reshape(-1, 1)
        else:
            values = np.concatenate(group)
            first = np.r_[0, np.cumsum([len(g) for g in group])[:-1]]
            least = np.stack([np.minimum.reduceat(values * m + a, first)
                              for m, a in zip(_MULTIPLY, _ADD, strict=True)])
        out[some[at:to]] = (mix(least.astype(_U)) >> _U(48)).T.astype(">u2")
        at = to
    return out


def _features(batches):
    def rows(batch):
        sets = shingle_sets(batch.column(1))
        marks = signatures(sets)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
             pa.array([len(s) for s in sets], pa.int64()),
             pa.array([m.tobytes() if len(s) else None for s, m in zip(sets, marks, strict=True)], pa.binary()),
             batch.column(2)],
            names=["id", "node", "n", "marks", "text_key"])

    yield from by_text_size(batches, rows)


def _groups(batches, keys: list[str]):
    """Whole key groups of batches that come sorted by ``keys``."""
    rest: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        rest = part if rest is None else pa.concat_tables([rest, part])
        columns = [rest[k].to_numpy() for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if len(change):
            rest = rest.combine_chunks()
            edges = [0, *change.tolist()]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield rest.slice(a, b - a)
            rest = rest.slice(edges[-1])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _marks(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, TREES * LEVELS)


def _shared(same: np.ndarray) -> np.ndarray:
    """Leading true values along the last axis."""
    return np.where(same.all(axis=-1), LEVELS, same.argmin(axis=-1))


def _meet(threshold: float, recall: float):
    """Per subtrie (or pair of its blocks): for each member, the places of its partners."""
    values = TREES * LEVELS
    least = threshold - 5 * np.sqrt(threshold * (1 - threshold) / values)
    floor = stop_depth(threshold, recall)

    def run(batches):
        for group in _groups(batches, ["bucket", "low", "high"]):
            m = group.num_rows
            if m < 2:
                continue
            marks, n = _marks(group["marks"]), group["n"].to_numpy()
            tree, block = group["tree"].to_numpy(), group["block"].to_numpy()
            low, high = group["low"][0].as_py(), group["high"][0].as_py()
            label = marks.reshape(m, TREES, LEVELS)[np.arange(m), tree]
            beside = _shared(label[1:] == label[:-1])  # prefix shared with the next label in order
            beside[tree[1:] != tree[:-1]] = 0
            found: list[tuple[int, np.ndarray]] = []
            for i in range(m - 1):
                shared = np.minimum.accumulate(beside[i:])  # with every later label
                run_end = i + 1 + int(np.searchsorted(-shared, -floor, side="right"))
                rest = slice(i + 1, run_end)
                need = pair_depths(n[rest] + n[i], threshold, recall)
                ok = shared[:run_end - i - 1] >= need
                ok &= np.minimum(n[rest], n[i]) >= threshold * np.maximum(n[rest], n[i]) - 1e-9
                if low != high:
                    ok &= block[rest] != block[i]
                j = np.flatnonzero(ok)
                if not len(j):
                    continue
                need, j = need[j], j + i + 1
                same = marks[j] == marks[i]
                close = same.mean(axis=1) >= least
                j, need, same = j[close], need[close], same[close]
                if len(j):  # only in the first tree where the two meet
                    meets = _shared(same.reshape(len(j), TREES, LEVELS)) >= need[:, None]
                    j = j[meets.argmax(axis=1) == tree[i]]
                if len(j):
                    found.append((i, j))
            if not found:
                continue
            members = np.unique(np.concatenate([[i, *j] for i, j in found]))
            partners: list[list[int]] = [[] for _ in members]
            for i, j in found:
                partners[int(np.searchsorted(members, i))] = np.searchsorted(members, j).tolist()
            picked = group.take(pa.array(members))
            yield pa.RecordBatch.from_arrays(
                [picked[c].combine_chunks() for c in ("bucket", "low", "high")]
                + [pa.array(np.arange(len(members), dtype=np.int32)), picked["node"].combine_chunks(),
                   picked["n"].combine_chunks(), pa.array(partners, pa.list_(pa.int32()))],
                names=["bucket", "low", "high", "place", "node", "n", "partners"])

    return run


def common_shingles(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """|sets[i] & sets[j]| of the given pairs, exactly: one by one, or, where
    pairs are dense, by products of incidence matrices in parts."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    codes = np.unique(flat, return_inverse=True)[1]
    distinct = int(codes.max()) + 1 if len(codes) else 0
    if len(i) * (size.mean() * 8e-9 + 1e-5) < 2e-10 * len(sets) ** 2 * distinct + 4e-9 * len(sets) * distinct:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                         for a, b in zip(i, j, strict=True)], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    common = np.zeros((len(sets), len(sets)))
    width = 8192
    for at in range(0, distinct, width):
        a, b = np.searchsorted(codes, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], codes[a:b] - at] = 1
        common += part @ part.T
    return common[i, j].astype(np.int64)


def _verify(threshold: float):
    def run(batches):
        for group in _groups(batches, ["bucket", "low", "high"]):
            group = group.sort_by("place")
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
            partners = group["partners"].to_pylist()
            i = np.repeat(np.arange(len(sets)), [len(p) for p in partners])
            j = np.array([x for p in partners for x in p], np.int64)
            if not len(i):
                continue
            size = np.array([len(s) for s in sets])
            common = common_shingles(sets, i, j)
            ok = common >= threshold * (size[i] + size[j] - common) - 1e-9
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            links = np.bincount(np.r_[i, j], minlength=len(sets))
            root = np.arange(len(sets))
            while True:  # smallest connected place
                before = root.copy()
                np.minimum.at(root, i, root[j])
                np.minimum.at(root, j, root[i])
                root = root[root]
                if (root == before).all():
                    break
            linked = np.flatnonzero(links)
            node = group["node"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(linked)), node.take(pa.array(root[linked])), pa.array(links[linked].astype(np.int64))],
                names=["node", "root", "links"])

    return run


def _sets_of(batches):
    def rows(batch):
        sets = shingle_sets(batch.column(1))
        keys = [set_key(s) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), batch.column(2), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["node", "wanted", "shingles"])

    yield from by_text_size(batches, rows)


def _text_key(text_col: str):
    return F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def _classes(docs: DataFrame, threshold: float, id_col: str, text_col: str, recall: float, block_sets: int) -> DataFrame:
    """One row per row of ``docs``: id, text_key, first (null, id and text_key of the
    class's smallest row), n_links, n_copies."""
    kind = docs.schema[id_col].dataType.simpleString()
    depth = stop_depth(threshold, recall)
    rows = id_text(docs, id_col, text_col)
    features = cut(rows.withColumn("text_key", _text_key("text")).mapInArrow(
        _features, f"id {kind}, node binary, n bigint, marks binary, text_key string"))
    row = F.struct(F.col("id").isNull().alias("null"), "id", "text_key")
    nodes = cut(features.where("node is not null").groupBy("node").agg(
        F.min(row).alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("n").alias("n"),
        F.any_value("marks").alias("marks")))

    prefix = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)),
                         lambda t: F.xxhash64(t, F.substring(F.col("marks"), t * _WIDTH + 1, F.lit(2 * depth))))
    trie = nodes.select("node", F.posexplode(prefix).alias("tree", "bucket"))
    dense = trie.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / block_sets).cast("int")
    met = (trie.join(dense, "bucket").join(nodes.select("node", "n", "marks"), "node")
           .withColumn("block", F.pmod(F.xxhash64("node", "bucket"), blocks).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
           .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                   "block", "tree", "node", "n", "marks",
                   F.substring(F.col("marks"), F.col("tree") * _WIDTH + 1, F.lit(_WIDTH)).alias("label")))
    group = ["bucket", "low", "high"]
    pairs = cut(met.repartition(*group).sortWithinPartitions(*group, "tree", "label", "node").drop("label").mapInArrow(
        _meet(threshold, recall),
        "bucket bigint, low int, high int, place int, node binary, n bigint, partners array<int>"))

    wanted = cut(pairs.select("node").distinct().join(nodes.select("node", "first"), "node"))
    chosen = small(wanted.select(F.col("first.id").alias("wanted_id"), F.col("node").alias("wanted")))
    sets = (rows.join(chosen, rows["id"].eqNullSafe(chosen["wanted_id"])).select("id", "text", "wanted")
            .mapInArrow(_sets_of, "node binary, wanted binary, shingles binary")
            .where("node = wanted").dropDuplicates(["node"]).select("node", "shingles"))
    links = cut(pairs.join(sets, "node").select(*group, "place", "node", "partners", "shingles")
                .repartition(*group).sortWithinPartitions(*group)
                .mapInArrow(_verify(threshold), "node binary, root binary, links bigint"))

    label = components(links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    first = label.join(nodes.select("node", "first"), "node")
    of_label = first.groupBy("label").agg(F.min("first").alias("class_first"))
    linked = (first.join(of_label, "label").select("node", "class_first")
              .join(links.groupBy("node").agg(F.sum("links").alias("links")), "node"))
    result = nodes.select("node", "first", "copies").join(linked, "node", "left").select(
        "node", F.coalesce("class_first", "first").alias("first"),
        F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"), F.col("copies").alias("n_copies"))
    parts = F.ceil(F.col("n_copies") / HUB_LINKS).cast("int")  # a set of very many copies: its rows are joined in parts
    many = small(cut(nodes.select("node", F.col("copies").alias("n_copies")).where(parts > 1).select("node", parts.alias("parts"))))
    spread = features.where("node is not null").join(many, "node", "left").withColumn(
        "part", F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1))).cast("int"))
    have = (spread.join(result.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))), ["node", "part"])
            .select("id", "text_key", "first", "n_links", "n_copies"))
    none = features.where("node is null").select(
        "id", "text_key", row.alias("first"), F.lit(0).cast("bigint").alias("n_links"), F.lit(1).cast("bigint").alias("n_copies"))
    return have.unionByName(none)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
                    recall: float = RECALL, block_sets: int = BLOCK_SETS) -> DataFrame:
    """One row per row of ``docs``: id, class_id (smallest id of its connected
    near duplicates), n_links (different texts within ``threshold``), n_copies
    (rows of the same shingle set, itself included)."""
    return _classes(docs, threshold, id_col, text_col, recall, block_sets).select(
        F.col("id").alias(id_col), F.col("first.id").alias("class_id"), "n_links", "n_copies")


def keep_one_per_class(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """The smallest row (id, then hash of its text) of every class, columns unchanged.

    A row is known by its id and its text together, so two texts of one id are
    judged apart. Rows without an id always stay. Rows equal in both stand for each other and
    stay or go together (exact dedup leaves one of them).
    """
    own = F.struct(F.col("id").isNull().alias("null"), "id", "text_key")
    gone = small(cut(_classes(docs, threshold, id_col, text_col, RECALL, BLOCK_SETS).where(F.col("id").isNotNull() & (F.col("first") != own)).select(
        F.col("id").alias("__gone_id"), F.col("text_key").alias("__gone_key")).distinct()))
    return docs.join(gone, (docs[id_col] == gone["__gone_id"]) & (_text_key(text_col) == gone["__gone_key"]), "left_anti")
