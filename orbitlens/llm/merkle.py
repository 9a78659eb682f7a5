"""A Merkle manifest of a data set: a proof for every row, from bitmap ranks and slot arrays.

1. Leaves. A row's leaf is the hash of its fields, each with its length in front. Rows belong to the tree
   of their group; leaves of a tree ascend by id.
2. Bitmaps. The ids of a group are bits of 64-bit words; 16 words make a block, of which only words that
   hold a row are kept. A block carries the row counts before each of its words, and the rows of its group
   before the block, a running total over blocks (not rows) that runs bucket by bucket.
3. Ranks. A row finds its block by an equi-join, its word by the popcount of the block's mask, and its place
   by the popcount of the bits below its own: a leaf's coordinate, without sorting leaves. Where a word holds an
   id twice, bits cannot tell; the rows of these words alone are numbered by a bucketed row number.
4. Levels. Nodes are keyed by (tree, index div 8**4). Such a group lays its digests into an array by slot and
   reduces four levels at once; a tree of n leaves takes log4096(n) rounds. The subroots, in order of their
   groups, are the leaves of the last tree.
5. Proofs go the other way: a group gets the path of its own node and gives its children theirs. A leaf's path
   is hashed, and folded with the leaf to be checked, where it stands.

No group exceeds 4096 nodes, 16 words, or what a bucket holds, whatever a tree's size. The driver sees the root
and one number a round.

Defined cases: a null field is ``-``; null ids come first, null groups are a group of their own before all others;
rows with equal ids lie side by side in order of their leaves, so equal rows share a leaf and have a proof each; empty
and very long texts are hashed whole; one row alone is its tree's root; an empty table gives no rows; further
columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlens.operators import ordered
from orbitlens.session import materialize

FANOUT = 8
#: levels reduced in one group, so a group holds FANOUT ** LEVELS nodes at most
LEVELS = 4
GROUP = FANOUT ** LEVELS
WORDS = 16
#: the word of null ids lies before all others
NULL_WORD = -(1 << 57) - WORDS


@dataclass
class Manifest:
    """Trees of a data set: nodes by round, subroots with their places, and the root (None for an empty table)."""

    leaves: DataFrame
    rounds: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None


def field(column: Column) -> Column:
    """A value with its length in bytes in front; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """The lowercase hex sha256 of the fields."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _bits_below(bits: Column, at: Column) -> Column:
    """How many of the bits below bit ``at`` are set."""
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), at))
    return F.bit_count(bits.bitwiseAND(lower))


def ranked(leaves: DataFrame) -> DataFrame:
    """The leaves (tree, doc, leaf, ...) with ``index`` (from 0, in its tree) and ``width`` (leaves of the tree)."""
    word = F.coalesce(F.shiftright("doc", 6), F.lit(NULL_WORD))
    place = F.coalesce(F.col("doc"), F.lit(0)).bitwiseAND(F.lit(63)).cast("int")
    rows = leaves.withColumns({"word": word, "bit": place})
    words = rows.groupBy("tree", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count("*").alias("n"))
    # a block gathers the words of one number div 16: at most 16 of them
    entry = F.struct(F.col("word").bitwiseAND(F.lit(WORDS - 1)).cast("int").alias("w"), "bits", "n")
    blocks = words.groupBy("tree", F.shiftright("word", 4).alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("words"), F.sum("n").alias("n"))
    blocks = materialize(blocks, "bitmaps")
    running = ordered.scan(
        ordered.order_frame(blocks.select("tree", "block", "n"), ["tree", "block"]), upto=("sum", F.col("n")))
    running = materialize(running, "directory")
    trees = running.groupBy("tree").agg(F.min(F.col("upto") - F.col("n")).alias("first"), F.sum("n").alias("width"))
    before = F.transform("words", lambda e, i: F.aggregate(
        F.slice("words", 1, i), F.lit(0).cast("bigint"), lambda a, x: a + x["n"]))
    mask = F.aggregate("words", F.lit(0).cast("bigint"), lambda a, e: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), e["w"])))
    directory = blocks.join(running.select("tree", "block", "upto"), ["tree", "block"]).join(trees, "tree").select(
        "tree", "block", "words", before.alias("before"), mask.alias("mask"), "width",
        (F.col("upto") - F.col("n") - F.col("first")).alias("offset"))
    found = rows.withColumn("block", F.shiftright("word", 4)).join(directory, ["tree", "block"])
    w = F.col("word").bitwiseAND(F.lit(WORDS - 1)).cast("int")
    found = found.withColumn("at", _bits_below(F.col("mask"), w)).select(
        *rows.columns, "width", F.get("words", F.col("at")).alias("e"),
        (F.col("offset") + F.get("before", F.col("at"))).alias("start"))
    crowded = F.col("e.n") > F.bit_count("e.bits")
    below = _bits_below(F.col("e.bits"), F.col("bit"))
    kept = leaves.columns
    alone = found.where(~crowded).select(*kept, "width", (F.col("start") + below).alias("index"))
    many = materialize(found.where(crowded).select(*kept, "width", "word", "start", F.coalesce("doc", F.lit(0)).alias("place")), "crowded")
    numbered = ordered.number_within(many, ["tree", "word"], ["place", "leaf", "row"], "number")
    return alone.union(numbered.select(*kept, "width", (F.col("start") + F.col("number") - 1).alias("index")))


def depth(width: int) -> int:
    """Levels until one node remains."""
    levels = 0
    while width > 1:
        width, levels = -(-width // FANOUT), levels + 1
    return levels


def slots(table: pa.Table, column: str, first: int) -> list:
    """Values of a group laid out by index."""
    out = [None] * len(table)
    for i, value in zip(table["index"].to_pylist(), table[column].to_pylist()):
        out[i - first] = value
    return out


def reduce_levels(nodes: list[str], levels: int) -> list[list[str]]:
    """The slot arrays of a group, its own nodes first; the last one has a single node."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def paths(arrays: list[list[str]], above: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """Per node of the lowest array: what stands left and right of it in its run, level by level up to the root."""
    tails = [above]
    for below in reversed(arrays[:-1]):
        here = []
        for i in range(len(below)):
            run = i - i % FANOUT
            left, right = "".join(below[run:i]), "".join(below[i + 1:run + FANOUT])
            here.append([(left, right), *tails[i // FANOUT]])
        tails = here
    return tails


NODES = "tree string, index bigint, width bigint, digest string"


def _reduce(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    tree, group = key[0].as_py(), key[1].as_py()
    width = table["width"][0].as_py()
    levels = min(LEVELS, depth(width))
    top = reduce_levels(slots(table, "digest", group * GROUP), levels)[-1]
    return pa.table({"tree": [tree], "index": pa.array([group], pa.int64()), "digest": top,
                     "width": pa.array([-(-width // FANOUT ** levels)], pa.int64())}).select(["tree", "index", "width", "digest"])


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes and what becomes of them, round by round, until every tree has one node."""
    out = [nodes]
    while (out[-1].agg(F.max("width")).first()[0] or 0) > 1:
        grouped = out[-1].select("tree", "index", "width", "digest").groupBy("tree", F.expr(f"index div {GROUP}").alias("group"))
        out.append(materialize(grouped.applyInArrow(_reduce, NODES), "nodes"))
    return out


def build(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), doc_id: str = "doc_id",
          group: str = "lang", carried: dict[str, Column] | None = None) -> Manifest:
    """The trees of all rows. ``carried`` columns of the rows stay with the leaves (see :func:`prove`)."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    more = [c.alias(n) for n, c in (carried or {}).items()]
    leaves = materialize(docs.select(
        tree.alias("tree"), F.col(doc_id).cast("bigint").alias("doc"), leaf([F.col(c) for c in fields]).alias("leaf"),
        F.monotonically_increasing_id().alias("row"), *more), "leaves")
    placed = materialize(ranked(leaves).withColumn("digest", F.col("leaf")).drop("row"), "ranks")
    rounds = _rounds(placed)
    subroots = rounds[-1].groupBy("tree").agg(F.max("digest").alias("subroot"))  # one node a tree is left
    places = ordered.with_row_number(materialize(subroots, "subroots"), ["tree"], "number")
    total = places.count()
    top = materialize(places.select(
        F.lit("").alias("tree"), (F.col("number") - 1).alias("index"), F.lit(total).cast("bigint").alias("width"),
        F.col("subroot").alias("digest"), F.col("tree").alias("group")), "top")
    tops = _rounds(top)
    last = tops[-1].select("digest").head(1)
    return Manifest(placed, rounds, top.select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "index"), tops,
                    last[0][0] if last else None)


PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
PATH_SQL = "array<struct<left: string, right: string>>"


def _members(nodes: pa.Table, above: pa.Table) -> list[list[tuple[str, str]]]:
    """The paths of a group's nodes, by slot."""
    levels = min(LEVELS, depth(nodes["width"][0].as_py()))
    first = min(nodes["index"].to_pylist()) // GROUP * GROUP
    tail = [(x["left"], x["right"]) for x in above["path"][0].as_py()]
    return paths(reduce_levels(slots(nodes, "digest", first), levels), tail)


def _hand_down(nodes: pa.Table, above: pa.Table) -> pa.Table:
    found = _members(nodes, above)
    order = [found[i % GROUP] for i in nodes["index"].to_pylist()]
    return pa.table({"tree": nodes["tree"], "index": nodes["index"],
                     "path": pa.array([[{"left": a, "right": b} for a, b in p] for p in order], PATH)})


def _down(rounds: list[DataFrame], paths_of: DataFrame, below: int = 0) -> DataFrame:
    """(tree, index, path) of the nodes of round ``below``, from the paths of the last round's single nodes."""
    for nodes in reversed(rounds[below:-1]):
        children = nodes.select("tree", "index", "width", "digest").groupBy("tree", F.expr(f"index div {GROUP}"))
        parents = paths_of.select("tree", "index", "path").groupBy("tree", "index")
        paths_of = children.cogroup(parents).applyInArrow(_hand_down, f"tree string, index bigint, path {PATH_SQL}")
    return paths_of


def _folded(root: str, checked: str, kind: str):
    def run(leaves: pa.Table, above: pa.Table) -> pa.Table:
        found = _members(leaves, above) if len(leaves) else []
        proofs, folded = [], []
        for i, own, other in zip(leaves["index"].to_pylist(), leaves["leaf"].to_pylist(), leaves[checked].to_pylist()):
            path = found[i % GROUP]
            proofs.append(digest([a + b for a, b in path]))
            node = other or own
            for left, right in path:
                node = digest((left, node, right))
            folded.append(node)
        subroot = above["subroot"][0].as_py() if len(above) else None
        n = len(leaves)
        return pa.table({
            "doc_id": leaves["doc"], "leaf": leaves["leaf"], "subroot": pa.array([subroot] * n, pa.string()),
            "root": pa.array([root] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()), "verified": pa.array([x == root for x in folded], pa.bool_())})

    return run


def prove(manifest: Manifest, checked: str) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``checked`` is a carried column with the leaf to be checked; null means the leaf itself.
    """
    out = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    none = F.array().cast(PATH_SQL)
    top = manifest.top[-1].select("tree", "index", none.alias("path"))
    subpaths = _down(manifest.top, top).select("index", "path")
    trees = materialize(manifest.subroots.join(subpaths, "index").select("tree", "subroot", "path"), "subpaths")
    rounds = manifest.rounds
    start = trees.select("tree", F.lit(0).cast("bigint").alias("index"), "path")
    if len(rounds) == 1:  # every tree is one leaf
        above = start
    else:
        above = _down(rounds, start, below=1)
    above = above.join(trees.select("tree", "subroot"), "tree")
    leaves = rounds[0].groupBy("tree", F.expr(f"index div {GROUP}"))
    return leaves.cogroup(above.groupBy("tree", "index")).applyInArrow(_folded(manifest.root, checked, out), out)
