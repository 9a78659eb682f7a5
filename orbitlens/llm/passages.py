"""Substring removal by repeated-phrase automata.

A window of ``window`` words is removed from a document if the same window starts in a document
with a smaller doc_id. Removed words are those that a removed window covers.

1. Copies. Of equal texts the one with the least doc_id goes on; the others are wholly removed. Rows of one text are
   told apart from others by a salted join, so a text that a third of all rows have is no hot key.
2. Anchors. Of every window's k-word phrases the one with the least hash is its anchor, so equal
   windows have equal anchors. Counting anchors over all documents (about two for every nine
   positions) leaves the few that occur more than once.
3. Confirmation. Windows whose anchor recurs are counted themselves, with their least and largest
   doc_id. Those of two documents or more recur; the least doc_id owns them. Counts are combined
   within tasks before they move, so a window that a third of all documents hold is no hot key.
4. Shards. Documents are dealt to blocks of a few megabytes. The anchor phrases of confirmed windows that stand in a
   block's texts are its shard: each is compiled into the block's Aho-Corasick automaton once, and each confirmed
   window is listed once for a block, with its owner.
5. Automata. Every document streams through the automaton of its block. Where a phrase is reported, the windows
   around it are looked up among the confirmed ones: what the automata report is what is removed. No
   automaton is larger than what its block can match.

Windows are compared by 64-bit hashes, phrases by their text.

Defined cases: null text counts as empty; texts with fewer words than a window keep all words; a very long text is a
slice of its own and is read whole; documents with equal doc_id do not remove each other's words; null doc_ids
come after all others; repeated rows are judged alike; an empty table gives no rows; an input column named like
an output column is replaced, any other is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import bitmap
from orbitlens.llm import textops as tx
from orbitlens.llm.decontaminate import kept_grams, text_key
from orbitlens.session import materialize

WINDOW = 13
PHRASE = 6
#: a text's rows are joined under so many keys
SALTS = 16
BLOCK_BYTES = 4 << 20
#: windows of an anchor in one row
ANCHOR_WINDOWS = 1024
#: smaller slices than elsewhere: several passes share an executor's memory
SLICE = 1 << 20
LAST = (1 << 63) - 1


class Parsed:
    """Words, anchors and windows of a slice of documents."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, window: int, k: int):
        self.words = tx.find_words(data, bounds)
        self.hashes = self.words.hashes()
        self.window, self.k = window, k
        at, _ = self.words.windows(k)
        self.gram_at, self.grams = at, tx.window_hashes(self.hashes, at, k, 300 + k)
        self.at, self.owner = self.words.windows(window)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word positions and hashes of the anchor phrases."""
        where = kept_grams(self.grams, self.gram_at, self.window - self.k + 1)
        return where, self.grams[np.searchsorted(self.gram_at, where)]

    def windows(self, at: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the windows at the given word positions."""
        return tx.window_hashes(self.hashes, self.at if at is None else at, self.window, 400 + self.window)

    def anchor_of(self, at: np.ndarray) -> np.ndarray:
        """The anchor hashes of the windows at the given word positions."""
        first = np.searchsorted(self.gram_at, at)  # the phrases of a window follow each other
        least = self.grams[first].copy()
        for j in range(1, self.window - self.k + 1):
            np.minimum(least, self.grams[first + j], out=least)
        return least

    def near(self, phrases_at: np.ndarray) -> np.ndarray:
        """Start positions of the windows of one document that hold a phrase at one of the positions."""
        marks = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(marks, np.maximum(phrases_at - (self.window - self.k), 0), 1)
        np.add.at(marks, phrases_at + 1, -1)
        inside = np.cumsum(marks)[:-1] > 0
        return self.at[inside[self.at]]

    def phrase(self, at: int) -> bytes:
        """The words of the phrase at a word position, joined by one space."""
        w = self.words
        return b" ".join(w.data[x:y].tobytes() for x, y in zip(w.starts[at:at + self.k], w.ends[at:at + self.k]))


def _arrow(names: list[str], arrays: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)


def _suspected(batch: pa.RecordBatch, bits) -> np.ndarray:
    """Rows whose text may have a copy; rows without a key have been looked at."""
    key = batch.column("__key1")
    return bitmap.contains(bits.value, pc.fill_null(key, 0).to_numpy().view(np.uint64)) & key.is_valid().to_numpy(zero_copy_only=False)


def _single(batches: Iterator[pa.RecordBatch], bits) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(~_suspected(batch, bits)))
        pa.default_memory_pool().release_unused()


def _only_suspected(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_suspected(batch, bits)))

    return run


def _count_anchors(window: int, k: int, copies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _single(batches, copies):
            for _, _, data, bounds in tx.slices(batch.column("text"), SLICE):
                _, anchors = Parsed(data, bounds, window, k).anchors()
                values, counts = np.unique(anchors, return_counts=True)
                yield _arrow(["anchor", "n"], [tx.signed(values), counts.astype(np.int64)])

    return run


def _recurring_windows(window: int, k: int, copies, bits):
    """Windows whose anchor recurs, with their anchor and the least and largest doc_id of the slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _single(batches, copies):
            for lo, hi, data, bounds in tx.slices(batch.column("text"), SLICE):
                p = Parsed(data, bounds, window, k)
                where, anchors = p.anchors()
                at = p.near(where[bitmap.contains(bits.value, anchors)])
                if not len(at):
                    continue
                own = p.anchor_of(at)
                ok = bitmap.contains(bits.value, own)
                at, own = at[ok], own[ok]
                ids = batch.column("__doc").slice(lo, hi - lo).to_numpy()[p.words.owners()[at]]
                h = p.windows(at)
                order = np.lexsort((ids, h))
                h, ids, own = h[order], ids[order], own[order]
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
                last = np.append(first[1:], len(h))[:len(first)] - 1
                yield _arrow(["window", "anchor", "least", "most"], [tx.signed(h[first]), tx.signed(own[first]), ids[first], ids[last]])

    return run


def _phrases(window: int, k: int, copies, bits):
    """The anchor phrases of each block that the bitmap lets through, once per slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _single(batches, copies):
            for lo, hi, data, bounds in tx.slices(batch.column("text"), SLICE):
                p = Parsed(data, bounds, window, k)
                where, anchors = p.anchors()
                ok = bitmap.contains(bits.value, anchors)
                where, anchors = where[ok], anchors[ok]
                blocks = batch.column("__block").slice(lo, hi - lo).to_numpy()[p.words.owners()[where]]
                order = np.lexsort((anchors, blocks))
                where, anchors, blocks = where[order], anchors[order], blocks[order]
                new = np.ones(len(where), bool)
                new[1:] = (anchors[1:] != anchors[:-1]) | (blocks[1:] != blocks[:-1])
                texts = pa.array([p.phrase(i) for i in where[new].tolist()], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[new]), pa.array(tx.signed(anchors[new])), texts], ["block", "anchor", "phrase"])

    return run


class Automaton:
    """The anchor phrases of a block, and the hashes and owners of the confirmed windows around them."""

    def __init__(self, phrases: list[str], hashes: np.ndarray, owners: np.ndarray, window: int, k: int):
        self.window, self.k = window, k
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for phrase in phrases:
            self.machine.add_word(f" {phrase} ", 1)
        order = np.argsort(hashes)
        self.hashes, self.owners = hashes[order], owners[order]
        if len(self.machine):
            self.machine.make_automaton()

    def removed(self, p: Parsed, doc_ids: np.ndarray) -> np.ndarray:
        """Which words of the slice are covered by a window that a smaller doc_id owns."""
        gone = np.zeros(len(p.hashes) + 1, np.int64)
        if len(self.machine) and len(p.at):
            found = []
            w = p.words
            for d in range(len(w.first) - 1):
                a, b = int(w.first[d]), int(w.first[d + 1])
                if b - a < self.window:
                    continue
                pieces = w.data[w.starts[a]:w.ends[b - 1]].tobytes().split()
                plain = (b" " + b" ".join(pieces) + b" ").decode()
                ends = [end for end, _ in self.machine.iter(plain)]
                if ends:
                    spaces = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le"), np.uint32) == 32)[1:]
                    found.append(a + np.searchsorted(spaces, np.array(ends)) - (self.k - 1))
            if found and len(self.hashes):
                at = p.near(np.concatenate(found))
                h = p.windows(at)
                place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                hit = (self.hashes[place] == h) & (self.owners[place] < doc_ids[w.owners()[at]])
                np.add.at(gone, at[hit], 1)
                np.add.at(gone, at[hit] + self.window, -1)
        return np.cumsum(gone)[:-1] > 0


def _cleaned(table: pa.Table, drop: list[str], parts: Iterator[tuple[Parsed, np.ndarray, np.ndarray]]) -> pa.Table:
    """The table with n_words, n_removed, kept_words and cut_text from (parsed slice, its bounds, removed words)."""
    n_words, n_removed, kept, cut = [], [], [], []
    for p, bounds, gone in parts:
        w = p.words
        n_words.append(w.counts)
        n_removed.append(tx.sums(gone.astype(np.int64), w.first))
        for d in range(len(bounds) - 1):
            a, b = int(w.first[d]), int(w.first[d + 1])
            out = gone[a:b]
            whole = w.data[bounds[d]:bounds[d + 1]]
            pieces = whole.tobytes().split()
            kept.append(b" ".join(compress(pieces, (~out).tolist()) if out.any() else pieces))
            if out.any():  # a removed word goes with the space behind it
                ends = np.append(w.starts[a + 1:b], bounds[d + 1])
                mask = np.zeros(len(whole) + 1, np.int64)
                np.add.at(mask, w.starts[a:b][out] - bounds[d], 1)
                np.add.at(mask, ends[out] - bounds[d], -1)
                whole = whole[np.cumsum(mask)[:-1] == 0]
            cut.append(whole.tobytes())
    join = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64())
    out = table.drop_columns(drop).append_column("n_words", join(n_words)).append_column("n_removed", join(n_removed))
    for name, values in (("kept_words", kept), ("cut_text", cut)):
        out = out.append_column(name, pa.array(values, pa.large_binary()).cast(pa.large_string()).cast(pa.string()))
    return out


def _clean(window: int, k: int):
    """A block's documents, cleaned by its automaton."""
    def run(docs: pa.Table, shard: pa.Table) -> pa.Table:
        docs, shard = docs.combine_chunks(), shard.combine_chunks()
        # an empty shard has no chunks
        pairs = shard["windows"].combine_chunks().flatten().flatten() if len(shard) else [pa.array([], pa.int64())] * 2
        hashes, owners = (x.to_numpy() for x in pairs)
        machine = Automaton(pc.unique(shard["phrase"]).to_pylist(), hashes.view(np.uint64), owners, window, k)
        ids = docs["__doc"].to_numpy()

        def parts():
            for lo, hi, data, bounds in tx.slices(docs["text"], SLICE):
                p = Parsed(data, bounds, window, k)
                yield p, bounds, machine.removed(p, ids[lo:hi])

        return _cleaned(docs, EXTRA, parts())

    return run


def _all_gone(texts: pa.ChunkedArray, window: int, k: int):
    """Parsed slices of which all words of texts that have a window are removed."""
    for _, _, data, bounds in tx.slices(texts, SLICE):
        p = Parsed(data, bounds, window, k)
        yield p, bounds, np.repeat(p.words.counts >= window, p.words.counts)


def _copies_gone(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            yield from _cleaned(table, EXTRA, _all_gone(table["text"], window, k)).to_batches()

    return run


EXTRA = ["__doc", "__key1", "__key2", "__block"]


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                   k: int = PHRASE) -> DataFrame:
    """All rows with n_words, n_removed, kept_words (joined by one space) and cut_text (the text without removed words)."""
    spark = docs.sparkSession
    added = ["n_words", "n_removed", "kept_words", "cut_text"]
    docs = docs.drop(*added)
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_blocks = max(math.ceil(total / BLOCK_BYTES), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    key1, key2 = text_key(F.col(text))
    # texts take part, so that rows of one id are spread; equal texts have left a single row by then
    block = F.pmod(F.xxhash64(number, key1), F.lit(n_blocks)).cast("long")
    others = [F.col(c) for c in docs.columns if c not in (doc_id, text)]
    # columns of any name beside the text travel as one
    whole = docs.select(F.struct(F.col(doc_id).alias("id"), *others).alias("row"), F.col(text).alias("text"),
                        number.alias("__doc"), key1.alias("__key1"), key2.alias("__key2"), block.alias("__block"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema.fields)
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.drop(*EXTRA).schema.fields)
    out += ", n_words bigint, n_removed bigint, kept_words string, cut_text string"

    equal = (whole.groupBy("__key1", "__key2").agg(F.min("__doc").alias("__least"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    copies = bitmap.build(equal, "__key1")
    salted = equal.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
    doubtful = materialize(whole.mapInArrow(_only_suspected(copies), kinds).withColumn("__salt", salt)
                           .join(salted, ["__key1", "__key2", "__salt"], "left").select(*whole.columns, "__least"), "copies")
    later = F.col("__doc") > F.col("__least")
    firsts = doubtful.where(~F.coalesce(later, F.lit(False))).drop("__least").withColumn("__key1", F.lit(None).cast("long"))
    later_copies = doubtful.where(later).drop("__least").mapInArrow(_copies_gone(window, k), out)
    stream = whole.union(firsts.select(*whole.columns))  # every pass leaves out what it finds in the bitmap of copies

    slim = stream.select("__doc", "__key1", "__block", "text")
    anchors = (slim.mapInArrow(_count_anchors(window, k, copies), "anchor bigint, n bigint")
               .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"))
    recurring = _recurring_windows(window, k, copies, bitmap.build(anchors, "anchor"))
    confirmed = materialize(
        slim.mapInArrow(recurring, "window bigint, anchor bigint, least bigint, most bigint").groupBy("window")
        .agg(F.min("anchor").alias("anchor"), F.min("least").alias("owner"), F.max("most").alias("most"))
        .where("owner < most").drop("most"), "confirmed")

    known = bitmap.build(confirmed.select("anchor").distinct(), "anchor")
    standing = materialize(
        slim.mapInArrow(_phrases(window, k, copies, known), "block bigint, anchor bigint, phrase string")
        .groupBy("block", "anchor").agg(F.min("phrase").alias("phrase")), "phrases")
    # the windows of an anchor are one row; of an anchor with very many, those of one owner, which its document bounds
    per_anchor = confirmed.groupBy("anchor").agg(F.count("*").alias("n"))
    hot = per_anchor.where(F.col("n") > ANCHOR_WINDOWS).select("anchor")
    pair = F.collect_list(F.struct("window", "owner")).alias("windows")
    few = confirmed.join(hot, "anchor", "left_anti").groupBy("anchor").agg(pair)
    many = confirmed.join(hot, "anchor").groupBy("anchor", "owner").agg(pair).drop("owner")
    shards = standing.join(few.union(many), "anchor").select("block", "phrase", "windows")
    dealt = stream.mapInArrow(lambda batches: _single(batches, copies), kinds)
    cleaned = dealt.groupBy("__block").cogroup(shards.groupBy("block")).applyInArrow(_clean(window, k), out)
    rows = cleaned.union(later_copies)
    columns = [F.col("text") if c == text else F.col("row")["id" if c == doc_id else c].alias(c) for c in docs.columns]
    named = [c.alias(n) for c, n in zip(columns, docs.columns)]
    return rows.select(*named, *added)
