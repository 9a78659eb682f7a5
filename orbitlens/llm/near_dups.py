"""Near-duplicate detection: MinHash bands, odd sketches, exact confirmation, components.

1. Each document's set of word shingles gives ``BANDS * ROWS`` MinHash samples. Bands of them are
   bucket keys; all of them are folded into an odd sketch, a bitmap whose bits are flipped once per
   sample. The XOR of two sketches has a bit for each (non-cancelling) sample that differs, so its
   population count estimates high similarities far better than matching samples would.
2. Documents with the same words form a class; one stands for all.
3. Documents of a bucket are not paired up. Each bucket names a hub, its member with the most
   bucket mates overall, and a member joins the groups of its hubs. Two documents of one bucket
   share its hub's group, so every candidate pair lies in a group.
4. In a group, every member is compared with the hub. Members linked to it are settled: they need
   no comparison among themselves. In a group of up to ``CHUNK`` members the others are compared with all members;
   in a larger one they meet by the prefixes of their sets (see ``large_groups``). A comparison looks at the odd
   sketches first and confirms on the full sets. A group returns the links that join parts not yet joined.
5. Components of the confirmed links.

At the limit of similarity 0.85 a pair is missed by all bands with a chance of 2e-8 and by the
sketch with less; links are exact otherwise (64-bit shingle hashes).

Defined cases: null, empty and wordless texts have no shingles and are linked with nothing; a text
with fewer words than a shingle has its whole word sequence as the only one; repeated rows are
copies like others; null doc_ids come last and form components by their links only; texts of any length are read
whole, a very long one as a slice of its own; of equal weights the hub is the node of the least number, which
decides nothing; an empty table gives no rows; `keep_first` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import bitmap
from orbitlens.llm import textops as tx
from orbitlens.llm.components import connected
from orbitlens.llm.decontaminate import text_key
from orbitlens.llm.large_groups import differing, large_links
from orbitlens.session import materialize

BANDS, ROWS = 24, 4
SKETCH_BITS = 256
CHUNK = 256
#: copies of a text that are joined by its hash
HOT_COPIES = 256
#: a sketch estimate this far below the limit cannot belong to a link (over six standard deviations)
SLACK = 0.25


class Shingles:
    """Shingle hashes of a slice of documents, with repeats, and the slice's content hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, k: int):
        words = tx.find_words(data, bounds, lower=True)
        h = words.hashes()
        counts = words.counts
        at, owner = words.windows(k)
        hashes = tx.window_hashes(h, at, k, 1000 + k)
        for n in range(1, k):  # shorter texts: one shingle of all words
            short = np.flatnonzero(counts == n)
            if len(short):
                whole = tx.window_hashes(h, words.first[short], n, 2000 + n)
                hashes, owner = np.concatenate([hashes, whole]), np.concatenate([owner, short])
        if (counts[counts > 0] < k).any():
            order = np.argsort(owner, kind="stable")
            hashes, owner = hashes[order], owner[order]
        self.hashes, self.counts = hashes, counts
        self.bounds = np.searchsorted(owner, np.arange(len(counts) + 1))
        place = np.arange(len(h)) - np.repeat(words.first[:-1], counts)
        mixed = tx.mix(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        length = counts.astype(np.uint64)
        self.content = tx.mix(tx.sums(mixed, words.first) + length), tx.sums(tx.mix(mixed), words.first) ^ length

    def sets(self) -> list[np.ndarray]:
        """Sorted distinct hashes of each document."""
        return [np.unique(self.hashes[a:b]) for a, b in zip(self.bounds[:-1], self.bounds[1:])]


def minhashes(hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """n samples for each range of hashes (rows of empty ranges are of no use)."""
    filled = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, n), np.uint32)
    if not len(filled):
        return out
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    c = tx.constants(2 * n, 3)
    starts = bounds[:-1][filled]
    for i in range(n):
        source = low if i % 2 else high
        out[filled, i] = np.minimum.reduceat((source * np.uint32(c[i] & np.uint64(0xFFFFFFFF))) ^ np.uint32(c[n + i] >> np.uint64(32)), starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A bucket key for each band; bands do not share keys."""
    c = tx.constants(ROWS + 1, 4)
    out = np.empty((len(samples), BANDS), np.uint64)
    for b in range(BANDS):
        out[:, b] = c[ROWS:] * np.array([b + 1], np.uint64)
        for r in range(ROWS):
            out[:, b] = tx.mix(out[:, b] + samples[:, b * ROWS + r].astype(np.uint64) * c[r])
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps, SKETCH_BITS / 64 words a document: each (sample number, value) flips one bit."""
    n = samples.shape[1]
    marks = tx.mix(samples.astype(np.uint64) + (np.arange(1, n + 1, dtype=np.uint64) << np.uint64(32)))
    bit = (marks % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.zeros((len(samples), SKETCH_BITS), np.uint8)
    rows = np.arange(len(samples))
    for i in range(n):
        odd[rows, bit[:, i]] ^= 1
    return np.packbits(odd, axis=1).view(np.uint64)


def differing_bits(percent: int) -> int:
    """Sketch bits that may differ at most if the estimate is to reach the limit less SLACK."""
    low = percent / 100 - SLACK
    return int(SKETCH_BITS / 2 * (1 - math.exp((low - 1) * 4 * BANDS * ROWS / SKETCH_BITS)))


def _lists(rows: np.ndarray) -> pa.Array:
    """The rows of a uint64 matrix as lists of longs."""
    flat = pa.array(tx.signed(np.ascontiguousarray(rows)).reshape(-1))
    return pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(pa.list_(pa.int64()))


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column("text")):
                s = Shingles(data, bounds, k)
                samples = minhashes(s.hashes, s.bounds, BANDS * ROWS)
                keys = _lists(band_keys(samples))
                sketch = _lists(odd_sketches(samples))
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).slice(lo, hi - lo) for c in ("rid", "doc_id", "key1", "key2")],
                    pa.array([len(x) for x in s.sets()], pa.int64()), pa.array(tx.signed(s.content[0])),
                    pa.array(tx.signed(s.content[1])), keys, sketch,
                ], ["rid", "doc_id", "key1", "key2", "n_shingles", "c1", "c2", "keys", "sketch"])

    return run


def _sets(k: int, bits):
    """Sets of the documents whose content the bitmap lets through, one per content and slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in tx.slices(batch.column("text")):
                s = Shingles(data, bounds, k)
                first = np.sort(np.unique(s.content[0], return_index=True)[1])
                first = first[bitmap.contains(bits.value, s.content[0][first])]
                values = [np.unique(s.hashes[s.bounds[i]:s.bounds[i + 1]]).tobytes() for i in first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tx.signed(s.content[0][first])), pa.array(tx.signed(s.content[1][first])),
                     pa.array(values, pa.large_binary()).cast(pa.binary())], ["c1", "c2", "shingles"])

    return run


class _Parts:
    """Union-find over the documents of one block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


class _Members:
    """Documents of a block: ids, sketches and sorted sets laid end to end."""

    def __init__(self, table: pa.Table):
        self.node = table["node"].to_numpy()
        sets = table["shingles"].to_pylist()
        self.sizes = np.array([len(x) // 8 for x in sets], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        self.flat = np.frombuffer(b"".join(sets), np.uint64)
        self.sketch = table["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(sets), -1)

    def one(self, i: int) -> np.ndarray:
        return self.flat[self.bounds[i]:self.bounds[i + 1]]

    def linked(self, values: np.ndarray, sketch: np.ndarray, among: np.ndarray, percent: int) -> np.ndarray:
        """Which of ``among`` are linked with the set ``values``."""
        size = self.sizes[among]
        near = 100 * np.minimum(size, len(values)) >= percent * np.maximum(size, len(values))
        near &= np.bitwise_count(self.sketch[among] ^ sketch).sum(axis=1) <= differing_bits(percent)
        among = among[near]
        if not len(among):
            return among
        flat = np.concatenate([self.one(i) for i in among])
        at = np.minimum(np.searchsorted(values, flat), len(values) - 1)
        common = np.add.reduceat((values[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(self.sizes[among])[:-1]]))
        union = self.sizes[among] + len(values) - common
        return among[100 * common >= percent * union]


SIGNED = ("rid bigint, doc_id bigint, key1 bigint, key2 int, n_shingles bigint, c1 bigint, c2 bigint, "
          "keys array<bigint>, sketch array<bigint>")
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edge_table(edges: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())}, EDGES)


def _near_hub(percent: int):
    """Links with the hub, and in a group of one chunk links of the others; b = a marks a document not linked to its hub."""
    def run(key, table: pa.Table) -> pa.Table:
        hub = key[0].as_py()
        m, large = _Members(table), table["chunks"][0].as_py() > 1
        everyone = np.arange(len(m.node))
        h = int(np.flatnonzero(m.node == hub)[0])
        parts, edges = _Parts(len(m.node)), []
        settled = set(m.linked(m.one(h), m.sketch[h], everyone[everyone != h], percent).tolist()) | {h}
        for i in sorted(settled - {h}):
            parts.join(h, i)
            edges.append((hub, int(m.node[i])))
        for i in everyone:
            if i in settled:
                continue
            edges.append((int(m.node[i]), int(m.node[i])))
            if large:
                continue
            apart = np.array([j for j in everyone if parts.find(j) != parts.find(i)], np.int64)
            for j in m.linked(m.one(i), m.sketch[i], apart, percent).tolist():
                if parts.join(i, j):
                    edges.append((int(m.node[i]), int(m.node[j])))
        return _edge_table(edges)

    return run


def find_links(classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between class representatives, enough to connect every component.

    classes: node, c1, c2, keys, sketch, one row per class.
    """
    bands = classes.select("node", F.explode("keys").alias("bucket"))
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("mates")).where("mates > 1")
    shared = materialize(bands.join(sizes, "bucket"), "buckets")
    weight = shared.groupBy("node").agg(F.sum("mates").alias("weight"))
    weighed = shared.join(weight, "node")
    hubs = weighed.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("node")).alias("node"))).alias("top"))
    members = materialize(
        shared.join(hubs.select("bucket", (-F.col("top.node")).alias("hub")), "bucket").select("hub", "node").distinct(),
        "members")
    groups = members.groupBy("hub").agg(F.count("*").alias("size"))
    groups = materialize(groups, "sizes")
    # members of large groups take their size from a short list of hubs; no join on the hub has a hot key then
    big = groups.where(F.col("size") > CHUNK)
    sized = members.join(big, "hub").unionByName(
        members.join(big.select("hub"), "hub", "left_anti").join(groups.where(F.col("size") <= CHUNK), "hub"))
    rows = sized.join(classes.select("node", "c1", "c2", "sketch"), "node")
    # a hub and a single mate whose sketches are too far apart need no confirmation; this is the bulk of chance buckets
    mate = rows.where("size = 2 and hub <> node").select("hub", F.col("sketch").alias("other"))
    apart = (rows.where("size = 2 and hub = node").join(mate, "hub")
             .where(differing("sketch", "other") > differing_bits(percent)).select("hub"))
    rows = rows.join(apart, "hub", "left_anti")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    rows = rows.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    rows = materialize(rows.drop("size"), "groups")
    wanted = bitmap.build(rows, "c1")
    sets = (docs.select("text").mapInArrow(_sets(k, wanted), "c1 bigint, c2 bigint, shingles binary")
            .dropDuplicates(["c1", "c2"]))
    groups = materialize(rows.join(sets, ["c1", "c2"]).drop("c1", "c2"), "groups")

    # the hub stands in every chunk of its group
    everywhere = F.when(F.col("hub") == F.col("node"), F.expr("sequence(0, chunks - 1)")).otherwise(F.array("chunk"))
    schema = "a bigint, b bigint"
    near = materialize(
        groups.withColumn("chunk", F.explode(everywhere)).groupBy("hub", "chunk").applyInArrow(
            lambda key, t: _with_hub(key, _near_hub(percent)(key, t)), f"hub bigint, {schema}"), "links")
    links = near.where("a <> b").select("a", "b")

    large = groups.where("chunks > 1")
    alone = materialize(near.where("a = b").select("hub", F.col("a").alias("node")).distinct().join(
        large.select("hub", "node"), ["hub", "node"], "left_semi"), "alone")
    if not alone.head(1):
        return links
    return links.union(large_links(large, alone, classes, percent, differing_bits(percent)))


def _with_hub(key, table: pa.Table) -> pa.Table:
    return table.add_column(0, "hub", pa.array([key[0].as_py()] * len(table), pa.int64()))


def find_components(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
                    ) -> DataFrame:
    """One row per document: doc_id, key1 and key2 (of its text), n_shingles, component_id (least doc_id), kept (its
    doc_id is that), stays (one row of each component)."""
    slim = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).cast("long").alias("doc_id"),
                       *text_key(F.col(text)), F.col(text).alias("text"))
    signed = materialize(slim.mapInArrow(_sign(k), SIGNED), "signatures")
    full = signed.where("n_shingles > 0")
    classes = materialize(full.groupBy("c1", "c2").agg(F.min("rid").alias("node"), F.min("doc_id").alias("least"),
                                                        F.count("*").alias("copies")), "classes")
    heads = classes.join(full.select(F.col("rid").alias("node"), "keys", "sketch"), "node")
    roots = connected(find_links(heads, slim, k, percent))
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = materialize(rooted.join(least, "root").select("c1", "c2", "component", "root", "copies"), "components")
    # rows of texts with very many copies meet a short list of their own, the others no hot key
    hot, rest = named.where(F.col("copies") > HOT_COPIES).drop("copies"), named.where(F.col("copies") <= HOT_COPIES).drop("copies")
    rows = signed.drop("keys", "sketch")
    many, few = rows.join(hot, ["c1", "c2"]), rows.join(hot.select("c1", "c2"), ["c1", "c2"], "left_anti").where("n_shingles > 0")
    none = [F.lit(None).cast("bigint").alias(c) for c in ("component", "root")]
    out = (many.unionByName(few.join(rest, ["c1", "c2"]))
           .unionByName(rows.where("n_shingles = 0").select("*", *none)))
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    # the one row of a component that stays is told by its own number, not by the component's
    stays = out.where("kept and root is not null").groupBy("root").agg(F.min("rid").alias("rid"))
    out = out.join(stays.select("rid", F.lit(True).alias("first")), "rid", "left")
    return out.select("doc_id", "key1", "key2", "n_shingles", "component_id", "kept",
                      (F.col("root").isNull() | F.coalesce("first", F.lit(False))).alias("stays"))


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of near duplicates (least doc_id), columns unchanged."""
    keys = ["__id", "__key1", "__key2"]
    found = find_components(docs, k, percent, doc_id, text)
    rows = (found.groupBy("doc_id", "key1", "key2")
            .agg(F.count("*").alias("__all"), F.sum(F.col("stays").cast("int")).alias("__stay")).where("__stay > 0")
            .toDF(*keys, "__all", "__stay"))
    id_column = F.col(doc_id).cast("long").alias("__id")
    marked = docs.select("*", id_column, *[c.alias(n) for c, n in zip(text_key(F.col(text)), keys[1:])])
    same = [marked[n].eqNullSafe(rows[n]) for n in keys]
    both = marked.join(rows, same).select(*[marked[c] for c in marked.columns], "__all", "__stay")
    whole = both.where("__all = __stay")
    repeated = both.where("__all > __stay").dropDuplicates(keys)
    return whole.union(repeated).select(*docs.columns)
