"""Cross-tokenizer alignment with corpus-wide link counts by external spill counting.

Tokenizer A (byte-level BPE) reads a blank and the text, tokenizer B (sentencepiece)
the text, which puts the same blank in front. Byte offsets where an A and a B token
both end cut the tokens into groups, and the two tokens that end there are linked.
The count of an id pair is the number of links of the whole corpus that hold it; a
link is *best* if its count is the highest of its B id.

1. One scan encodes and aligns the texts, a few MB at a time, in numpy. It gives a
   row for every document and collects (pair, document, links) records. Every
   ``run_links`` links they are sorted and written as a *run*, radix-partitioned by
   B id: a row for each radix, with zstd columns for its distinct pairs, their counts
   and the documents of each pair.
2. The runs' (pair, count) columns go to their radix, where a k-way merge by a heap
   of block ends adds up equal pairs. Pairs are ordered by B id first, so a B id's
   pairs lie together and its maximum is read off as they pass. With more than
   ``fan`` runs, groups of runs are merged first, in rounds.
3. The merged counts stream back: they meet the runs of their radix (dealt over
   salted tasks) and answer each pair of a run; the answers meet the run's documents
   and become sums for each document.

A pair weighs one entry in a run however often it is linked, so a frequent token
makes no task larger; what moves is compressed. Tasks hold one run (``run_links``
links), ``fan`` blocks, or the distinct pairs of one radix, which the vocabularies bound.

Defined cases: null and empty texts, and those whose joined token bytes differ from
blank + text for A or B (such as texts with U+2581), have no tokens: zeros and the
empty string. Very long texts are encoded and aligned in parts, cut where both
tokenizers begin a new token. Equal counts are all best. Repeated rows and ids are
counted row by row; a null id is kept. An empty table gives no rows. Other columns
are never read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_text_size, cut, id_text
from .text_arrays import raw
from .tokens import ByteBpe, byte_strings, parts, piece_ids, piece_model, piece_strings

RADIX, FAN, RUN_LINKS, RUN_DOCS = 64, 64, 1 << 20, 1 << 22
_ID_BITS, _DOC_BITS = 20, 22  # ids of a vocabulary, documents of a run
_U = np.uint64
_BATCH_BYTES = 1 << 20
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def packed(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values as zstd: byte planes, so that small values cost little."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, as differences."""
    return packed(np.diff(keys, prepend=_U(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=_U)


class Aligner:
    """Both tokenizers of a task and their tables."""

    def __init__(self, path_a: str, path_b: str):
        self.encode_a = ByteBpe(path_a, special=False)
        self.model = piece_model(path_b)
        self.bytes_a, self.bytes_b = byte_strings(path_a), piece_strings(self.model)
        self.size_a, self.size_b = (np.diff(raw_bytes(t)[1]) for t in (self.bytes_a, self.bytes_b))
        most = max(len(self.bytes_a), len(self.bytes_b))
        if most > 1 << _ID_BITS:
            raise ValueError("a vocabulary has more ids than a pair holds")
        self.written = pa.array([f"{i}{end}" for i in range(most) for end in ",|;"], pa.large_string())

    def encoded(self, text: str) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of every part of a text; nothing if bytes are not kept."""
        out = []
        for k, part in enumerate(parts(text)):
            a = self.encode_a(" " + part if k == 0 else part)
            b = piece_ids(self.model, part, k == 0)
            own = (" " + part if k == 0 else part).encode()
            for table, ids in ((self.bytes_a, a), (self.bytes_b, b)):
                if raw_bytes(table.take(pa.array(ids)))[0].tobytes() != own:
                    return []
            out.append((a, b))
        return out

    def aligned(self, pairs: list[tuple[np.ndarray, np.ndarray]]):
        """(links of each pair of id lists, its written groups, A and B ids of every link)."""
        a, b = (np.concatenate([p[side] for p in pairs]) for side in (0, 1))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.minimum(np.searchsorted(end_a, end_b), len(end_a) - 1)
        meet_b = np.flatnonzero(end_a[at] == end_b)
        meet_a = at[meet_b]
        ends = end_b[meet_b]
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        # A group is written as its A ids, then its B ids: places in that order.
        index = np.empty(len(a) + len(b), np.int64)
        last_a = np.zeros(len(a), np.int64)
        last_a[meet_a] = 1
        last_b = np.zeros(len(b), np.int64)
        last_b[meet_b] = 2
        before = np.r_[0, meet_b + 1]  # B tokens of the groups before each group
        index[np.arange(len(a)) + before[group_a]] = a.astype(np.int64) * 3 + last_a
        index[np.arange(len(b)) + meet_a[group_b] + 1] = b.astype(np.int64) * 3 + last_b
        data, offsets = raw_bytes(self.written.take(pa.array(index)))
        tokens = np.cumsum([0, *(len(p[0]) + len(p[1]) for p in pairs)])
        text_ends = np.cumsum([0, *(len(p[1]) for p in pairs)])
        n_links = np.diff(np.searchsorted(meet_b, text_ends))
        written = [data[offsets[s]: offsets[e] - 1] for s, e in zip(tokens[:-1], tokens[1:], strict=True)]
        return n_links, written, a[meet_a], b[meet_b]


def raw_bytes(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large binary or large string array."""
    return raw(values.view(pa.large_string()) if pa.types.is_large_binary(values.type) else values)


def radix_order(b: np.ndarray, radix: int) -> np.ndarray:
    """B ids renumbered so that those of one radix (id mod ``radix``) lie together."""
    return (b % radix) * (-(-(1 << _ID_BITS) // radix)) + b // radix


class _Runs:
    """Collects links of a task's documents; rows of whole runs come out."""

    def __init__(self, radix: int, run_links: int):
        self.radix, self.run_links, self.number = radix, run_links, TaskContext.get().partitionId() << 32
        self.keys: list[np.ndarray] = []
        self.size, self.first_doc = 0, 0

    def add(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple]:
        """Links of documents numbered ``doc`` in the task (ascending)."""
        out = []
        for at in range(0, len(doc), self.run_links):
            part = slice(at, at + self.run_links)
            if self.keys and (self.size + len(doc[part]) > self.run_links
                              or int(doc[part][-1]) - self.first_doc >= RUN_DOCS):
                out += self.flush()
            if not self.keys:
                self.first_doc = int(doc[part][0])
            pair = (radix_order(b[part].astype(_U), self.radix) << _U(_ID_BITS)) | a[part].astype(_U)
            self.keys.append((pair << _U(_DOC_BITS)) | (doc[part] - self.first_doc).astype(_U))
            self.size += len(doc[part])
        return out

    def flush(self) -> list[tuple]:
        """(run, radix, first document, pairs, counts, documents of each pair, documents, links)."""
        if not self.keys:
            return []
        keys = np.sort(np.concatenate(self.keys))
        self.keys, self.size = [], 0
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        links = np.diff(np.r_[first, len(keys)])
        pair, doc = keys[first] >> _U(_DOC_BITS), keys[first] & _U((1 << _DOC_BITS) - 1)
        start = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        pairs, counts = pair[start], np.add.reduceat(links, start)
        docs = np.diff(np.r_[start, len(pair)])
        width = -(-(1 << _ID_BITS) // self.radix)
        edges = np.searchsorted(pairs, (np.arange(self.radix + 1) * width).astype(_U) << _U(_ID_BITS))
        start = np.r_[start, len(pair)]
        out = []
        for r in range(self.radix):
            s, e = edges[r], edges[r + 1]
            if s < e:
                records = slice(start[s], start[e])
                out.append((self.number, r, self.first_doc, packed_keys(pairs[s:e]), packed(counts[s:e]),
                            packed(docs[s:e]), packed(doc[records]), packed(links[records])))
        self.number += 1
        return out


_RUN = [("run", pa.int64()), ("radix", pa.int32()), ("first_doc", pa.int64()),
        *((c, pa.binary()) for c in ("pairs", "counts", "docs", "doc", "links"))]
_RUN_SQL = "run bigint, radix int, first_doc bigint, pairs binary, counts binary, docs binary, doc binary, links binary"


def _encode_task(path_a: str, path_b: str, radix: int, run_links: int, id_type: pa.DataType):
    schema = pa.schema([("task", pa.int64()), ("number", pa.int64()), ("id", id_type),
                        *((c, pa.int64()) for c in _COUNTS), ("groups_sha256", pa.string()), *_RUN])
    own, runs_own = schema.names[:8], [n for n, _ in _RUN]

    def table(rows: list[tuple], names: list[str], task: int) -> pa.RecordBatch:
        columns = dict(zip(names, zip(*rows, strict=True), strict=True))
        columns["task"] = [task] * len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(rows), f.type) for f in schema],
            schema=schema)

    def run(batches):
        aligner, runs = Aligner(path_a, path_b), _Runs(radix, run_links)
        task, number = TaskContext.get().partitionId(), 0
        spilled: list[tuple] = []

        def links_of(pairs, doc: np.ndarray):
            n_links, written, a, b = aligner.aligned(pairs)
            spilled.extend(runs.add(np.repeat(doc, n_links), a, b))
            return n_links, written

        def add(batch):
            nonlocal number
            rows: list[tuple] = []
            short, places = [], []

            def finish():
                if short:
                    n_links, written = links_of(short, np.array([rows[p][1] for p in places]))
                    for p, (a, b), n, groups in zip(places, short, n_links.tolist(), written, strict=True):
                        rows[p] = (*rows[p][:3], len(a), len(b), n, n, hashlib.sha256(groups).hexdigest())
                short.clear()
                places.clear()

            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pairs = aligner.encoded(text) if text else []
                if len(pairs) > 1:  # a long text, part by part: each begins a new group
                    finish()
                    whole, n_all = hashlib.sha256(), 0
                    for k, pair in enumerate(pairs):
                        n_links, written = links_of([pair], np.array([number]))
                        whole.update((b";" if k else b"") + written[0].tobytes())
                        n_all += int(n_links[0])
                    rows.append((task, number, key, sum(len(p[0]) for p in pairs), sum(len(p[1]) for p in pairs),
                                 n_all, n_all, whole.hexdigest()))
                else:
                    if pairs:
                        short.append(pairs[0])
                        places.append(len(rows))
                    rows.append((task, number, key, 0, 0, 0, 0, ""))
                number += 1
            finish()
            return table(rows, own, task) if rows else None

        for batch in by_text_size(batches, add):
            yield batch
            while spilled:
                yield table([spilled.pop()], runs_own, task)
        for row in runs.flush():
            yield table([row], runs_own, task)

    return run


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], block: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """k-way merge of ascending (keys, counts): equal keys are added up.

    The heap holds the last key of every run's next block. Everything up to the
    smallest of them is at hand, so it is taken from all runs and added at once.
    """
    def block_end(r: int) -> int:
        keys = runs[r][0]
        return int(keys[min(at[r] + block, len(keys)) - 1])

    at = [0] * len(runs)
    heap = [(block_end(r), r) for r in range(len(runs)) if len(runs[r][0])]
    heapq.heapify(heap)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    while heap:
        bound = heap[0][0]
        while heap and heap[0][0] == bound:
            heapq.heappop(heap)
        taken = []
        for r, (keys, counts) in enumerate(runs):
            if at[r] < len(keys) and int(keys[at[r]]) <= bound:
                to = int(np.searchsorted(keys, _U(bound), "right"))
                taken.append((keys[at[r]: to], counts[at[r]: to]))
                ended = to >= min(at[r] + block, len(keys))
                at[r] = to
                if ended and to < len(keys):
                    heapq.heappush(heap, (block_end(r), r))
        keys, where = np.unique(np.concatenate([t[0] for t in taken]), return_inverse=True)
        sums = np.zeros(len(keys), _U)
        np.add.at(sums, where, np.concatenate([t[1] for t in taken]).astype(_U))
        out.append((keys, sums))
    if not out:
        return np.zeros(0, _U), np.zeros(0, _U)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def best_of_b(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 where a pair's count is the highest of its B id (ties included)."""
    side = keys >> _U(_ID_BITS)
    first = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
    most = np.maximum.reduceat(counts, first)
    return (counts == np.repeat(most, np.diff(np.r_[first, len(keys)]))).astype(_U)


def _merge_task(fan: int, last: bool):
    """Merges the runs of each (radix, part), ``fan`` at a time."""
    def merged(key: tuple[int, int], runs: list) -> pa.RecordBatch:
        keys, counts = merge_runs(runs)
        best = packed(best_of_b(keys, counts)) if last else None
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([packed_keys(keys)], pa.binary()),
             pa.array([packed(counts)], pa.binary()), pa.array([best], pa.binary())],
            names=["radix", "part", "pairs", "counts", "best"])

    def run(batches):
        current, runs = None, []
        for batch in batches:
            for radix, part, pairs, counts in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if current != (radix, part):
                    if runs:
                        yield merged(current, runs)
                    current, runs = (radix, part), []
                runs.append((unpacked_keys(pairs), unpacked(counts)))
                if len(runs) >= fan:
                    runs = [merge_runs(runs)]
        if runs:
            yield merged(current, runs)

    return run


def _answer_task(batches):
    """Counts of every run's pairs. A radix's merged pairs come first (``run`` null)."""
    keys = counts = best = None
    for batch in batches:
        rows: list[tuple] = []
        for radix, run, pairs, count, flag in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            if run is None:
                keys, counts, best = unpacked_keys(pairs), unpacked(count), unpacked(flag)
                continue
            at = np.searchsorted(keys, unpacked_keys(pairs))
            rows.append((run, radix, packed(counts[at]), packed(best[at])))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                names=["run", "radix", "counts", "best"])


def _sum_task(batches):
    """Sums for each document of a run; its answers come before its documents, radix by radix."""
    state: dict = {}

    def rows_of_run() -> pa.RecordBatch:
        some = np.flatnonzero(state["sum"])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some), state["run"] >> 32)), pa.array(some + state["first"]),
             pa.array(state["n_best"][some].astype(np.int64)), pa.array(state["sum"][some].astype(np.int64))],
            names=["task", "number", "n_best", "count_sum"])

    for batch in batches:
        for run, first, counts, best, docs, doc, links in zip(*(batch.column(c).to_pylist() for c in (0, 3, 4, 5, 6, 7, 8)), strict=True):
            if state and state["run"] != run:
                yield rows_of_run()
                state = {}
            if not state:
                state = {"run": run, "n_best": np.zeros(0, _U), "sum": np.zeros(0, _U)}
            if docs is None:
                state["answer"] = unpacked(counts), unpacked(best)
                continue
            each, doc, links = unpacked(docs).astype(np.int64), unpacked(doc).astype(np.int64), unpacked(links)
            state["first"] = first
            if len(doc) and int(doc.max()) >= len(state["sum"]):
                for name in ("n_best", "sum"):
                    state[name] = np.concatenate([state[name], np.zeros(int(doc.max()) + 1 - len(state[name]), _U)])
            count, flag = (np.repeat(x, each) for x in state["answer"])
            np.add.at(state["n_best"], doc, links * flag)
            np.add.at(state["sum"], doc, links * count)
    if state:
        yield rows_of_run()


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
          path_b: str | None = None, radix: int = RADIX, fan: int = FAN, run_links: int = RUN_LINKS) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import public_tokenizers
    from pyspark.sql.pandas.types import to_arrow_type

    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["id"].dataType
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    made = cut(rows.mapInArrow(_encode_task(path_a, path_b, radix, run_links, to_arrow_type(kind)),
                               f"task bigint, number bigint, id {kind.simpleString()}, {counts}, groups_sha256 string, {_RUN_SQL}"))
    texts = made.where("run is null").select("task", "number", "id", *_COUNTS, "groups_sha256")
    runs = made.where("run is not null").select(*[n for n, _ in _RUN])

    merge_sql = "radix int, part bigint, pairs binary, counts binary, best binary"
    number = runs.select("run").distinct().count()
    some, left = runs.select("radix", F.col("run").alias("part"), "pairs", "counts"), number
    while left > fan:  # groups of runs first
        left = -(-left // fan)
        some = cut(some.withColumn("part", F.pmod(F.xxhash64("part", F.lit(left)), F.lit(left)))
                   .repartition("radix", "part").sortWithinPartitions("radix", "part")
                   .mapInArrow(_merge_task(fan, False), merge_sql)).drop("best")
    merged = cut(some.withColumn("part", F.lit(0).cast("bigint")).repartition("radix").sortWithinPartitions("radix")
                 .mapInArrow(_merge_task(fan, True), merge_sql))

    salts = max(1, -(-number // 256))
    tables = merged.select("radix", F.lit(None).cast("bigint").alias("run"), "pairs", "counts", "best",
                           F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    asked = runs.select("radix", "run", "pairs", F.lit(None).cast("binary").alias("counts"),
                        F.lit(None).cast("binary").alias("best"), F.pmod(F.xxhash64("run"), F.lit(salts)).cast("int").alias("salt"))
    answers = (tables.unionByName(asked).repartition("radix", "salt").sortWithinPartitions("radix", "salt", "run")
               .mapInArrow(_answer_task, "run bigint, radix int, counts binary, best binary"))

    none = F.lit(None).cast("binary")
    both = answers.select("run", "radix", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("first_doc"), "counts", "best",
                          none.alias("docs"), none.alias("doc"), none.alias("links")).unionByName(
        runs.select("run", "radix", F.lit(1).alias("kind"), "first_doc", none.alias("counts"), none.alias("best"), "docs", "doc", "links"))
    sums = (both.repartition("run").sortWithinPartitions("run", "radix", "kind")
            .mapInArrow(_sum_task, "task bigint, number bigint, n_best bigint, count_sum bigint")
            .groupBy("task", "number").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    zero = F.lit(0).cast("bigint")
    return texts.join(sums, ["task", "number"], "left").select(
        F.col("id").alias(id_col), *_COUNTS, F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
