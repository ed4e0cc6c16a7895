"""Conversation prefix trie on a minimal-perfect-hash node table.

Conversations are ordered by turn and rebuilt: conversation c takes the first
h = crc32(decimal c) mod 6 turns of conversation c - c % 100, then its own turns
after its first h. Every distinct sequence of first d rebuilt turns is a node.

1. *Turns.* A turn becomes 128 bits of its SHA-256 and its length; texts move no
   further. Turns are range-sorted by (conversation, turn), so a conversation of
   any length spreads over tasks, and numbered by their place in the task plus the
   turns before it. Heads are joined by base (five turns at most for each).
2. *Prefix digests.* D(d) = D(d-1) * B + turn(d), modulo 2**64 for two odd B. It is
   computed in segments of ``segment`` turns by numpy; later segments are
   shifted by what comes before them. Equal digests must agree in their last turn and
   their parent, or the run stops.
3. *Node table.* An aggregation by digest gives a node's members, their smallest id
   (its *owner*) and its children. Then shards (conversations by hundreds, one segment
   of each) build their own tables: a minimal perfect hash assigns a slot to every
   distinct digest, checked against the stored digests; the values of the nodes owned in
   the shard (one for a childless node, and saved tokens) are scattered into flat arrays
   and added up through the parent slots, deepest first. What a conversation owns in
   later segments enters at the last node of the segment.
4. A node's subtree lies on the paths of its members' owned nodes, each in one shard, so
   the sum over shards of a node's slot is its subtree's total. A frequent first turn or
   a frequent conversation weighs one row in each shard.
5. Ids that end at a node are joined within blocks of ``id_block`` ids and hashed block
   by block in ascending order, so a group of copies never lies in one task as a list.

Defined cases: rows with a null conv_id belong to no conversation and are left out;
null turns come first; null roles and texts are empty; equal turns of a
conversation are ordered by the digest of role and text, so repeated rows are turns of
their own; negative ids use the remainder towards zero; an empty table gives no rows;
a conversation left without turns is a member of the root; texts of any length count
whole. Other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, small
from .text_arrays import mix

HEAD_TURNS, BASE_STEP = 6, 100
SEGMENT, SHARD_ROWS, ID_BLOCK = 4096, 250_000, 4096
_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses modulo 2**64
_NODE = ["d1", "d2", "depth"]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i <= n."""
    out = []
    for step in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n + 1, step, _U)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _batch(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == _U else c) for c in columns.values()],
        names=list(columns))


def whole_groups(batches, keys: list[str], single: bool = False):
    """Tables of whole key groups of batches that come sorted by ``keys`` (one each if ``single``)."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
        change = (np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist()
        if rest and any(rest[-1].column(batch.schema.get_field_index(k))[-1].as_py() != c[0] for k, c in zip(keys, columns, strict=True)):
            change.insert(0, 0)
        at = 0
        for to in change if single else change[-1:]:
            rest.append(batch.slice(at, to - at))
            yield pa.Table.from_batches(rest).combine_chunks()
            rest, at = [], to
        rest.append(batch.slice(at))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


def _places(batches):
    """Places of turns within the part of their conversation that a task holds."""
    part = TaskContext.get().partitionId()
    last, before = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column(0).to_numpy()
        first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        place = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n])) + 1
        if last is not None and conv[0] == last:
            place[: first[1] if len(first) > 1 else n] += before
        last, before = conv[-1], int(place[-1])
        digest = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u8").reshape(-1, 2).astype(_U)
        yield _batch({"conv_id": conv, "part": np.full(n, part, np.int32), "place": place,
                      "t1": digest[:, 0].copy(), "t2": digest[:, 1].copy(), "chars": batch.column(2).to_numpy()})


def _runs(table: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(first row of every group, place of every row in its group from 0)."""
    columns = [table[k].to_numpy() for k in keys]
    n = table.num_rows
    first = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])
    return first, np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))


def _prefixes(longest: int):
    """Digests of the prefixes within a segment, and of their parents."""
    def run(batches):
        tables = [_powers(base, longest + 1) for base in _BASES]
        for table in whole_groups(batches, ["conv_id", "seg"]):
            first, place = _runs(table, ["conv_id", "seg"])
            out = {c: table[c].to_numpy() for c in ("conv_id", "seg")}
            out["depth"] = place + 1
            for k, (up, down) in enumerate(tables, 1):
                turn = table[f"t{k}"].to_numpy().view(_U)
                sums = np.r_[_U(0), np.cumsum(turn * down[place])]
                digest = (sums[1:] - np.repeat(sums[first], np.diff(np.r_[first, len(place)]))) * up[place]
                out[f"d{k}"] = digest
                out[f"p{k}"] = np.where(place > 0, np.r_[_U(0), digest[:-1]], _U(0))
                out[f"t{k}"] = turn
            out["chars"] = table["chars"].to_numpy()
            end = np.zeros(len(place), bool)
            end[np.r_[first[1:], len(place)] - 1] = True
            out["end"] = end
            yield _batch({c: out[c] for c in _PATH_COLUMNS})

    return run


_PATH_COLUMNS = ["conv_id", "seg", "depth", "d1", "d2", "p1", "p2", "t1", "t2", "chars", "end"]
_PATH_SQL = "conv_id bigint, seg bigint, depth bigint, d1 bigint, d2 bigint, p1 bigint, p2 bigint, t1 bigint, t2 bigint, chars bigint, end boolean"


def _segment_offsets(batches):
    """Turns and digest before every later segment of a conversation (its segments come in order)."""
    conv, turns, state = None, 0, [0, 0]
    for batch in batches:
        rows = []
        for c, seg, depth, *digest in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if c != conv:
                conv, turns, state = c, 0, [0, 0]
            else:
                rows.append((c, seg, turns, *(s - (1 << 64) if s >> 63 else s for s in state)))
            state = [(s * pow(base, depth, 1 << 64) + d) % (1 << 64) for s, base, d in zip(state, _BASES, digest, strict=True)]
            turns += depth
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                             names=["conv_id", "seg", "turns", "o1", "o2"])


def _shifted(longest: int):
    def run(batches):
        tables = [_powers(base, longest + 1)[0] for base in _BASES]
        for batch in batches:
            column = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
            depth = column["depth"]
            for k, up in enumerate(tables, 1):
                before = column[f"o{k}"].view(_U)
                column[f"d{k}"] = column[f"d{k}"].view(_U) + before * up[depth]
                column[f"p{k}"] = column[f"p{k}"].view(_U) + before * up[depth - 1]
            column["depth"] = depth + column["turns"]
            yield _batch({c: column[c] for c in _PATH_COLUMNS})

    return run


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys, with the keys kept by slot.

    Level by level, keys that are alone in their place of a bit field stay there and
    the others go on to the next field; a slot is the rank of a key's place.
    """

    def __init__(self, key1: np.ndarray, key2: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, taken = np.arange(len(key1)), 0
        while len(left):
            size = 2 * len(left) + 1
            place = self._place(key1[left], key2[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((alone, taken + np.cumsum(alone) - 1))
            taken += int(alone.sum())
            left = left[~alone[place]]
        self.key1, self.key2 = np.zeros(len(key1), _U), np.zeros(len(key1), _U)
        slot = self._slots(key1, key2)
        self.key1[slot], self.key2[slot] = key1, key2
        if not (np.array_equal(self.key1[slot], key1) and np.array_equal(self.key2[slot], key2)):
            raise ValueError("two digests share a slot")

    @staticmethod
    def _place(key1, key2, level: int, size: int) -> np.ndarray:
        return (mix(mix(key1 + _U(level * 0x9E3779B97F4A7C15 % (1 << 64))) ^ key2) % _U(size)).astype(np.int64)

    def _slots(self, key1: np.ndarray, key2: np.ndarray) -> np.ndarray:
        slot, left = np.full(len(key1), -1, np.int64), np.arange(len(key1))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(key1[left], key2[left], level, len(alone))
            hit = alone[place]
            slot[left[hit]] = rank[place[hit]]
            left = left[~hit]
        return slot

    def slots(self, key1: np.ndarray, key2: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 for keys that the table does not hold."""
        slot = self._slots(key1, key2)
        if not len(self.key1):
            return slot
        same = (slot >= 0) & (self.key1[slot] == key1) & (self.key2[slot] == key2)
        return np.where(same, slot, -1)


def distinct_keys(key1: np.ndarray, key2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key2, key1))
    key1, key2 = key1[order], key2[order]
    new = np.r_[True, (key1[1:] != key1[:-1]) | (key2[1:] != key2[:-1])] if len(key1) else np.zeros(0, bool)
    return key1[new], key2[new]


def _subtree_sums(batches):
    """Partial subtree sums of the nodes of every shard. A value follows its path row."""
    for table in whole_groups(batches, ["shard", "seg"], single=True):
        column = {n: table[n].to_numpy() for n in ("depth", "kind", "leaves", "saved")}
        key = {n: table[n].to_numpy().view(_U) for n in ("d1", "d2", "p1", "p2")}
        path = column["kind"] == 0
        nodes = PerfectHash(*distinct_keys(key["d1"][path], key["d2"][path]))
        slot = np.full(len(path), -1, np.int64)
        slot[path] = nodes.slots(key["d1"][path], key["d2"][path])
        depth, parent = np.zeros(len(nodes.key1), np.int64), np.full(len(nodes.key1), -1, np.int64)
        depth[slot[path]] = column["depth"][path]
        parent[slot[path]] = np.where(column["depth"][path] > 0, nodes.slots(key["p1"][path], key["p2"][path]), -1)
        of_value = slot[np.maximum.accumulate(np.where(path, np.arange(len(path)), 0))][~path]
        sums = {n: np.zeros(len(depth), np.int64) for n in ("leaves", "saved")}
        for n, total in sums.items():
            np.add.at(total, of_value, column[n][~path])
        order = np.argsort(-depth, kind="stable")
        edges = np.flatnonzero(np.r_[True, depth[order][1:] != depth[order][:-1], True])
        for at, to in zip(edges[:-1], edges[1:], strict=True):  # deepest first
            level = order[at:to]
            level = level[parent[level] >= 0]
            for total in sums.values():
                np.add.at(total, parent[level], total[level])
        some = (sums["leaves"] != 0) | (sums["saved"] != 0)
        yield _batch({"d1": nodes.key1[some], "d2": nodes.key2[some], "depth": depth[some],
                      "leaves": sums["leaves"][some], "saved": sums["saved"][some]})


def _end_hashes(batches):
    """SHA-256 of every node's blocks of ids, which come in order."""
    key, state = None, None
    for batch in batches:
        rows = []
        for *node, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if node != key:
                if state is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if rows:
            yield _ends_batch(rows)
    if state is not None:
        yield _ends_batch([(*key, state.hexdigest())])


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(),) * 3 + (pa.string(),), strict=True)],
        names=[*_NODE, "ends_sha256"])


def _ranked_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, t1, t2, chars) of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    written = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = cut(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.substring(F.unhex(F.sha2(written.cast("binary"), 256)), 1, 16).alias("digest"),
        F.length(text).cast("bigint").alias("chars")))
    order = ["conv_id", "turn", "digest"]
    placed = cut(turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "chars").mapInArrow(
        _places, "conv_id bigint, part int, place bigint, t1 bigint, t2 bigint, chars bigint"))
    counts = placed.groupBy("conv_id", "part").agg(F.max("place").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first conversation of a part can have begun before it: a row for each part at most.
    before = small(cut(counts.withColumn("before", F.sum("n").over(earlier)).where("before is not null").drop("n")))
    return placed.join(before, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "t1", "t2", "chars")


def _paths(ranked: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """(conversations, a row for every rebuilt turn with its prefix digest)."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS
    convs = ranked.where("pos = 1").select("conv_id", head.alias("h"))
    base = ranked.where((F.col("conv_id") % BASE_STEP == 0) & (F.col("pos") < HEAD_TURNS)).withColumnRenamed("conv_id", "base")
    heads = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE_STEP).join(base, "base").where("pos <= h").select(
        "conv_id", F.lit(0).cast("bigint").alias("seg"), F.lit(0).alias("kind"), "pos", "t1", "t2", "chars")
    own = ranked.where(F.col("pos") > head).select(
        "conv_id", F.floor((F.col("pos") - 1) / F.lit(segment)).alias("seg"), F.lit(1).alias("kind"), "pos", "t1", "t2", "chars")
    local = cut(heads.unionByName(own).repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "kind", "pos")
                .mapInArrow(_prefixes(segment + HEAD_TURNS), _PATH_SQL))
    late = local.where("seg > 0")
    if late.isEmpty():
        return convs, local
    ends = local.where("end").select("conv_id", "seg", "depth", "d1", "d2")
    spans = ends.join(ends.where("seg > 0").select("conv_id").distinct(), "conv_id", "left_semi")
    offsets = (spans.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
               .mapInArrow(_segment_offsets, "conv_id bigint, seg bigint, turns bigint, o1 bigint, o2 bigint"))
    # A later segment without an earlier row of its conversation begins at the root.
    shifted = late.join(offsets, ["conv_id", "seg"], "left").fillna(0, ["turns", "o1", "o2"]).mapInArrow(
        _shifted(segment + HEAD_TURNS), _PATH_SQL)
    return convs, cut(local.where("seg = 0").unionByName(shifted))


def _nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: digest, depth, parent digest, owner and its segment, members, children, length."""
    zero = F.lit(0).cast("bigint")
    root = convs.select("conv_id", zero.alias("seg"), *(zero.alias(c) for c in _PATH_COLUMNS[2:-1]))
    grouped = paths.drop("end").unionByName(root).groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("conv_id", "seg")).alias("owner"), F.max("chars").alias("chars"),
        *(f(c).alias(f"{n}_{c}") for c in ("p1", "p2", "t1", "t2") for n, f in (("low", F.min), ("high", F.max))))
    same = F.lit(True)
    for c in ("p1", "p2", "t1", "t2"):
        same = same & (F.col(f"low_{c}") == F.col(f"high_{c}"))
    members = F.when(same, F.col("members")).otherwise(F.raise_error(F.lit("two prefixes share a digest")).cast("bigint"))
    nodes = cut(grouped.select(*_NODE, F.col("low_p1").alias("p1"), F.col("low_p2").alias("p2"), "owner.conv_id", "owner.seg",
                               members.alias("n_convs"), "chars"))
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    return cut(nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))))


def _subtree_totals(paths: DataFrame, convs: DataFrame, nodes: DataFrame, shard_rows: int) -> DataFrame:
    """(node, n_leaves, saved_tokens)."""
    zero = F.lit(0).cast("bigint")
    value = nodes.select("conv_id", "seg", "depth", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
                         ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")).where("leaves <> 0 or saved <> 0")
    later = value.where("seg > 0").groupBy("conv_id", "seg").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    ends = paths.where("end").select("conv_id", "seg", "depth")
    ends = ends.join(paths.where("seg > 0").select("conv_id").distinct(), "conv_id", "left_semi")
    after = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.join(later, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", "depth", *(F.sum(c).over(after).alias(c) for c in ("leaves", "saved"))).where("leaves <> 0 or saved <> 0")
    keys = ("d1", "d2", "p1", "p2")
    steps = paths.select("conv_id", "seg", "depth", *keys).unionByName(
        convs.select("conv_id", *(zero.alias(c) for c in ("seg", "depth", *keys))))
    shards = max(1, -(-steps.count() // shard_rows))
    rows = steps.withColumns({"kind": F.lit(0), "leaves": zero, "saved": zero}).unionByName(
        value.unionByName(carried.fillna(0, ["leaves", "saved"])).withColumns({"kind": F.lit(1), **{c: zero for c in keys}}))
    shard = F.pmod(F.xxhash64(F.floor(F.col("conv_id") / F.lit(BASE_STEP))), F.lit(shards))
    return (rows.withColumn("shard", shard).repartition("shard", "seg").sortWithinPartitions("shard", "seg", "conv_id", "depth", "kind")
            .mapInArrow(_subtree_sums, "d1 bigint, d2 bigint, depth bigint, leaves bigint, saved bigint")
            .groupBy(*_NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))


def _ends(paths: DataFrame, convs: DataFrame, id_block: int) -> DataFrame:
    """(node, ends_sha256) of the nodes at which a conversation ends."""
    zero = F.lit(0).cast("bigint")
    last = paths.where("end").select("conv_id", *_NODE).unionByName(
        convs.select("conv_id", *(zero.alias(c) for c in _NODE))).groupBy("conv_id").agg(
        F.max_by(F.struct(*_NODE), "depth").alias("node")).select("conv_id", "node.*")
    blocks = last.groupBy(*_NODE, F.floor(F.col("conv_id") / F.lit(id_block)).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return (blocks.repartition(*_NODE).sortWithinPartitions(*_NODE, "block").select(*_NODE, "ids")
            .mapInArrow(_end_hashes, "d1 bigint, d2 bigint, depth bigint, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, shard_rows: int = SHARD_ROWS, id_block: int = ID_BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, paths = _paths(_ranked_turns(conversations), segment)
    convs = cut(convs.select("conv_id"))
    nodes = _nodes(paths, convs)
    totals = _subtree_totals(paths, convs, nodes, shard_rows)
    ends = _ends(paths, convs, id_block)
    # The nodes that a conversation owns are the deepest part of its path: only the first has another owner's parent.
    top = nodes.groupBy("conv_id").agg(F.min_by(F.struct(*_NODE, "p1", "p2"), "depth").alias("top")).select("top.*").where("depth > 0")
    owner = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))
    parents = top.join(owner, ["p1", "p2", "depth"]).select(*_NODE, "above")
    zero = F.lit(0).cast("bigint")
    return (nodes.join(parents, _NODE, "left").join(totals, _NODE, "left").join(ends, _NODE, "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
