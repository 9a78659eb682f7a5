"""Best-fit decreasing packing of token sequences into windows of fixed capacity.

Documents longer than a window are first cut into full windows and a rest. Rests are packed by
decreasing length, each into the open window with the least room that still holds it. Which rest
of a length goes where does not matter, so the packing is planned on the histogram of lengths: a
segment tree over remaining capacities holds the open windows of each capacity as runs, and a
whole run of equal rests is placed at once. The plan is the packing that one pass over all sorted
rests would find, yet the driver sees at most ``capacity`` counts and works on runs.

Rests then take their places in parallel: each has a rank among the rests of its length, from its
rank in its own task (written with it) and the counts of the tasks before, and looks its rank up
in the plan. No row is moved for ranking.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.llm import textops as tx
from orbitlens.llm.tokenize import Vocabulary, encode, id_type
from orbitlens.session import materialize

CAPACITY = 1024
END_ID = 0


class CapacityTree:
    """A segment tree over capacities 0..n; leaves count open windows, inner nodes their sums."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, windows: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += windows
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The least capacity >= need with an open window."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan(lengths: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, ranks, first window, offset) of a best-fit decreasing packing; number of windows.

    Ranks of a run take consecutive windows, all at the same offset.
    """
    tree, open_runs = CapacityTree(capacity), {}
    runs, windows = [], 0
    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            room = tree.tightest(length)
            if room is None:  # nothing open holds it: open as many windows as the rests of this length need
                room, n = capacity, -(-left // (capacity // length))
                first, windows = windows, windows + n
            else:
                first, n = open_runs[room].pop()
                tree.add(room, -n)
            # a window just used has the least room, so it takes rests of this length while they fit
            per = room // length
            full = min(n, left // per)
            over = left - full * per if full < n else 0
            for at, used, filled in ((first, full, per), (first + full, 1 if over else 0, over)):
                for j in range(filled if used else 0):
                    runs.append((length, rank, used, at, capacity - room + j * length))
                    rank += used
                if used:
                    tree.add(room - filled * length, used)
                    open_runs.setdefault(room - filled * length, []).append((at, used))
            spare = n - full - (1 if over else 0)
            if spare:
                tree.add(room, spare)
                open_runs.setdefault(room, []).append((first + n - spare, spare))
            left -= full * per + over
    return runs, windows


def _pieces(capacity: int, end_id: int, vocabulary: Vocabulary, with_ids: bool):
    """A row per piece, with its rank among the task's pieces of the same length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column("text")):
                ids, cut = encode(data, bounds, vocabulary)
                ids = np.insert(ids, cut[1:], end_id)
                cut = cut + np.arange(len(cut))
                sizes = np.diff(cut)
                n = -(-sizes // capacity)
                doc = np.repeat(np.arange(hi - lo), n)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = number * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                order = np.argsort(length, kind="stable")
                at = np.concatenate([[0], np.cumsum(np.bincount(length, minlength=capacity + 1))])
                rank = np.empty(len(doc), np.int64)
                rank[order] = np.arange(len(doc)) - at[length[order]] + seen[length[order]]
                seen += np.diff(at)
                wide = ids.astype("<u4").tobytes()
                begin = cut[doc] + start
                crc = np.fromiter((zlib.crc32(wide[4 * b:4 * e]) for b, e in zip(begin.tolist(), (begin + length).tolist())),
                                  np.int64, len(doc))
                arrays = [batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)), *map(
                    pa.array, (start, length, crc, sizes[doc], np.full(len(doc), task, np.int32), rank))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank"]
                if with_ids:
                    narrow, width = ids.tobytes(), ids.itemsize
                    arrays.append(pa.array([narrow[width * b:width * e] for b, e in zip(begin.tolist(), (begin + length).tolist())],
                                           pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def cut_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id",
                  text: str = "text", vocabulary: Vocabulary | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents, written once to the shared folder.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, task, rank and, on request, ids (little-endian, 16 bits
    for vocabularies of up to 65,536 ids). A null or empty text is its end id alone.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, rank bigint"
              + (", ids binary" if with_ids else ""))
    chosen = vocabulary or Vocabulary.byte_bpe_50k()
    return materialize(slim.mapInArrow(_pieces(capacity, end_id, chosen, with_ids), schema), "pieces")


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id (gapless from 0 in all) and offset; full windows come first."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    sofar = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(sofar), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = histogram.pop(capacity, 0)
    runs, _ = plan(histogram, capacity)
    # at most a run per pair of a length and a capacity: bounded by the window, not by the data
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    for length, rank, _, first, offset in runs:
        by_length.setdefault(length, []).append((rank, first, offset))
    packed = spark.sparkContext.broadcast({
        k: tuple(np.array(x, np.int64) for x in zip(*sorted(v))) for k, v in by_length.items()})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = rank.copy(), np.zeros(len(rank), np.int64)
            for size in np.unique(length[length < capacity]).tolist():
                own = np.flatnonzero(length == size)
                ranks, firsts, offsets = packed.value[size]
                at = np.searchsorted(ranks, rank[own], "right") - 1
                sequence[own] = full + firsts[at] + rank[own] - ranks[at]
                offset[own] = offsets[at]
            names = [c for c in batch.schema.names if c not in ("task", "rank", "before")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kept = [f for f in pieces.schema.fields if f.name not in ("task", "rank")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return pieces.join(before, ["length", "task"]).select(*[f.name for f in kept], "task", "rank", "before").mapInArrow(
        place, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
         vocabulary: Vocabulary | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Defined cases: null text counts as empty, whose only id is the end id; repeated rows are documents of their
    own; ties of length are broken by place in the input; very long texts make many full windows; an empty table
    gives no rows; further columns are not looked at.
    """
    return assign(cut_documents(docs, capacity, end_id, doc_id, text, vocabulary), capacity)


def _matrix(capacity: int, width: int):
    """The rows of the id matrix from the pieces of each sequence, which come together and in order."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        order = np.lexsort((table["offset"].to_numpy(), table["sequence_id"].to_numpy()))
        sequence, length = table["sequence_id"].to_numpy()[order], table["length"].to_numpy()[order]
        ids = table["ids"]
        cuts = np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1])) if len(sequence) else np.empty(0, np.int64)
        rows = []
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(sequence)]):
            rows.append(_row(int(sequence[a]), [ids[int(i)].as_py() for i in order[a:b]], length[a:b], capacity, width))
        return pa.Table.from_pylist(rows, MATRIX)

    return run


MATRIX = pa.schema([("sequence_id", pa.int64()), ("input_ids", pa.binary()), ("n_tokens", pa.int32()),
                    ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary())])
MATRIX_SQL = "sequence_id bigint, input_ids binary, n_tokens int, cu_seqlens array<int>, position_ids binary"


def _row(sequence: int, parts: list[bytes], lengths: np.ndarray, capacity: int, width: int) -> dict:
    used = int(lengths.sum())
    places = np.concatenate([np.arange(n, dtype="<u2") for n in lengths] + [np.zeros(capacity - used, "<u2")])
    return {"sequence_id": sequence, "input_ids": b"".join(parts) + bytes(width * (capacity - used)), "n_tokens": used,
            "cu_seqlens": [0, *np.cumsum(lengths).tolist()], "position_ids": places.tobytes()}


def pack_matrices(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id",
                  text: str = "text", vocabulary: Vocabulary | None = None) -> DataFrame:
    """One row per sequence: sequence_id, input_ids (capacity ids, little-endian, zero padding), n_tokens,
    cu_seqlens (cumulative segment lengths from 0), position_ids (16 bits each, starting anew with every segment).

    Full windows become rows where they are; only rests move, to the task of their sequence. Cases as in ``pack``.
    """
    vocabulary = vocabulary or Vocabulary.byte_bpe_50k()
    pieces = cut_documents(docs, capacity, end_id, doc_id, text, vocabulary, with_ids=True).drop("doc_id", "start", "ids_crc32", "doc_tokens")
    width = np.dtype(id_type(vocabulary)).itemsize
    placed = assign(pieces, capacity)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(s, [ids], np.array([capacity]), capacity, width) for s, ids in zip(
                batch.column("sequence_id").to_pylist(), batch.column("ids").to_pylist())]
            yield from pa.Table.from_pylist(rows, MATRIX).to_batches()

    full = placed.where(F.col("length") == capacity).mapInArrow(whole, MATRIX_SQL)
    # a group of 64 sequences is one call; it holds 64 windows of ids at most
    rests = (placed.where(F.col("length") < capacity).withColumn("__group", F.expr("sequence_id div 64"))
             .groupBy("__group").applyInArrow(_matrix(capacity, width), MATRIX_SQL))
    return full.union(rests)


def write_shards(matrices: DataFrame, path: str, shards: int) -> None:
    """The matrix rows as Parquet, in ``shards`` ranges of sequence_id, sorted inside each."""
    (matrices.repartitionByRange(shards, "sequence_id").sortWithinPartitions("sequence_id")
     .write.mode("overwrite").parquet(path))
