"""Links of large hub groups, without comparing their members pair by pair.

Documents of one template share buckets though they stay below the limit, so a group may have very many members that
are not linked to its hub. For these:

1. Twins. Members that agree in three bands at once are compared with the least of them. This links most of what
   is nearly equal; its components need no comparison among themselves.
2. Prefixes. Shingles of a group are ordered by how often they stand in one of its chunks, rare ones first (any
   order is right; this one is cheap to know and parts documents well). Of two linked sets, the smaller one's first
   ``n - ceil(2tn / (1 + t)) + 1`` shingles and the larger one's first ``n - ceil(tn) + 1`` have one in common. So
   only members that share such a shingle meet. What a template gives all its documents comes last, and documents
   that hold enough of their own never meet; members linked to the hub do not meet each other.
3. Pairs that meet are screened by their odd sketches and confirmed on the full sets.

The pairs of step 2 grow with the documents that share a rare shingle, not with the square of the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlens.llm.components import connected
from orbitlens.session import materialize

TWIN_BANDS = 3


def differing(left: str, right: str) -> Column:
    """Bits in which two sketches differ."""
    counts = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(counts, F.lit(0), lambda a, x: a + x)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def confirmed(pairs: DataFrame, members: DataFrame, percent: int, most: int) -> DataFrame:
    """The links (a, b) among distinct pairs; members (node, sketch, shingles) are one row a node."""
    sketches = members.select("node", "sketch")
    near = (pairs.join(sketches.toDF("a", "sketch_a"), "a").join(sketches.toDF("b", "sketch_b"), "b")
            .where(differing("sketch_a", "sketch_b") <= most).select("a", "b"))
    sets = members.select("node", "shingles")
    both = near.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(percent), "a bigint, b bigint")


def twins(alone: DataFrame, keys: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that agree in several bands, each with the least of its bucket."""
    banded = alone.select("node").distinct().join(keys.select("node", "keys"), "node")
    runs = F.transform(F.sequence(F.lit(0), F.floor(F.size("keys") / TWIN_BANDS).cast("int") - 1), lambda i: F.xxhash64(
        i, F.array_join(F.slice("keys", i * TWIN_BANDS + 1, TWIN_BANDS), ",")))
    rows = banded.select("node", F.explode(runs).alias("bucket"))
    first = rows.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(first, "bucket").where("a < node").select("a", F.col("node").alias("b")).distinct()


def _common(table: pa.Table) -> pa.Table:
    """The shingles that several members of a chunk have, with their number."""
    flat = np.frombuffer(b"".join(table["shingles"].to_pylist()), np.uint64)
    tokens, counts = np.unique(flat, return_counts=True)
    often = counts > 1
    return pa.table({"hub": table["hub"].slice(0, 1), "tokens": pa.array([tokens[often].tobytes()], pa.binary()),
                     "counts": pa.array([counts[often].astype(np.int64).tobytes()], pa.binary())})


ENTRIES = "hub bigint, token bigint, node bigint, size bigint, part bigint, alone boolean, first boolean"


def _prefixes(percent: int):
    """(hub, token, node, size, part, alone, first): a chunk's prefixes; ``first`` marks the shorter one."""
    def run(members: pa.Table, order: pa.Table) -> pa.Table:
        members, order = members.combine_chunks(), order.combine_chunks()
        sets = [np.frombuffer(x, np.uint64) for x in members["shingles"].to_pylist()]
        size = np.array([len(x) for x in sets], np.int64)
        flat = np.concatenate([np.empty(0, np.uint64), *sets])
        owner = np.repeat(np.arange(len(sets)), size)
        often = np.zeros(len(flat), np.int64)
        if len(order):
            tokens = np.frombuffer(order["tokens"][0].as_py(), np.uint64)
            counts = np.frombuffer(order["counts"][0].as_py(), np.int64)
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, flat), len(tokens) - 1)
                often = np.where(tokens[at] == flat, counts[at], 0)
        by = np.lexsort((flat, often, owner))
        flat, owner = flat[by], owner[by]
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        n = size[owner]
        first = place < n + (-2 * percent * n) // (100 + percent) + 1
        kept = place < n + (-percent * n) // 100 + 1
        rows = owner[kept]
        columns = [members[c].to_numpy()[rows] for c in ("hub", "node", "part", "alone")]
        return pa.table({"hub": columns[0], "token": flat[kept].view(np.int64), "node": columns[1], "size": n[kept],
                         "part": columns[2], "alone": columns[3].astype(bool), "first": first[kept]})

    return run


def meetings(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) that share a prefix shingle, of different parts, not both linked to the hub.

    members: hub, node, chunk, chunks, shingles, part, alone.
    """
    sample = members.where("chunk = 0").groupBy("hub").applyInArrow(_common, "hub bigint, tokens binary, counts binary")
    chunks = members.select("hub", "chunk").distinct()
    # new columns on both sides, as both stem from the same frame
    order = chunks.join(sample, "hub").select(*[F.col(c).alias(c) for c in ("hub", "chunk", "tokens", "counts")])
    sets = members.select(*[F.col(c).alias(c) for c in ("hub", "chunk", "node", "shingles", "part", "alone")])
    entries = materialize(sets.groupBy("hub", "chunk").cogroup(order.groupBy("hub", "chunk")).applyInArrow(
        _prefixes(percent), ENTRIES), "prefixes")
    short = entries.where("first").select("hub", "token", F.col("node").alias("a"), F.col("size").alias("size_a"),
                                          F.col("part").alias("part_a"), F.col("alone").alias("alone_a"))
    smaller = (F.col("size_a") < F.col("size")) | ((F.col("size_a") == F.col("size")) & (F.col("a") < F.col("node")))
    apart = smaller & (F.col("part") != F.col("part_a"))
    met = short.where("alone_a").join(entries, ["hub", "token"]).where(apart).select("a", F.col("node").alias("b"))
    other = short.where("not alone_a").join(entries.where("alone"), ["hub", "token"]).where(apart).select("a", F.col("node").alias("b"))
    return met.union(other).distinct()


def large_links(large: DataFrame, alone: DataFrame, classes: DataFrame, percent: int, most: int) -> DataFrame:
    """Links (a, b) of the members of large groups beyond those with their hubs.

    large: hub, node, sketch, shingles, chunk, chunks; alone: (hub, node) of members not linked to the hub.
    """
    nodes = materialize(large.select("node", "sketch", "shingles").dropDuplicates(["node"]), "large-nodes")
    near = materialize(confirmed(twins(alone, classes), nodes, percent, most), "twins")
    parts = connected(near).withColumnRenamed("root", "part")
    marked = large.join(alone.withColumn("alone", F.lit(True)), ["hub", "node"], "left").join(parts, "node", "left")
    mine = F.when(F.col("alone"), F.coalesce("part", "node")).otherwise(F.col("hub"))
    members = marked.select("hub", "node", "chunk", "chunks", "shingles", mine.alias("part"), F.coalesce("alone", F.lit(False)).alias("alone"))
    groups = alone.select("hub").distinct()
    pairs = materialize(meetings(members.join(groups, "hub", "left_semi"), percent), "meetings")
    return near.union(confirmed(pairs, nodes, percent, most))
