"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words of digits, letters and bytes above 0x7F. Of every
``window`` consecutive words, the least hash among its k-word grams is kept, the rightmost on ties.
The choice depends on the window alone, so a window shared by a document and an item has the same
kept gram in both: joining the kept grams finds every shared span of ``window`` words or more. A
joined gram is confirmed word by word and extended to both sides, and counts if the span reaches
``window`` words. Items with fewer words are one gram of their own length, looked up at every
position.

One pass over the documents writes their candidates: kept grams that a bitmap of the
benchmark's grams lets through, with the words around. What is joined is that table, so its size
follows the shared text, and frequent grams are one row per place, on a join the engine can split.

Defined cases: null or wordless texts have no words and no hits; wordless items match nothing;
repeated rows are judged one by one; very long texts are read whole; where windows tie for the least hash any
choice finds the same spans; items of equal id count once, items without id hit but are
not listed; an empty benchmark leaves every document clean. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import bitmap
from orbitlens.llm import textops as tx
from orbitlens.session import materialize

WINDOW, GRAM = 10, 5
CANDIDATE = "array<struct<k:int,p:int,fp:bigint,before:string,gram:string,after:string>>"


def kept_grams(grams: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Positions (among all words) of the grams that are least in a run of ``span`` grams of one document.

    ``at`` holds the word positions of the grams; a break in it ends a document.
    """
    n = len(at) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least, where = grams[:n].copy(), np.arange(n)
    for j in range(1, span):
        smaller = grams[j : j + n] <= least
        np.minimum(least, grams[j : j + n], out=least)
        where[smaller] = np.flatnonzero(smaller) + j
    inside = at[span - 1 :] - at[:n] == span - 1
    return np.unique(at[where[inside]])


def _phrase(words: tx.Words, lo: int, hi: int) -> str:
    return b" ".join(words.data[s:e].tobytes() for s, e in zip(words.starts[lo:hi], words.ends[lo:hi])).decode()


def _candidates(words: tx.Words, hashes: np.ndarray, window: int, k: int, lengths: list[int],
                bits: np.ndarray | None) -> list[list[tuple]]:
    """Per document: the grams that pass the bitmap; without one, the grams an item is known by."""
    out: list[list[tuple]] = [[] for _ in range(len(words.first) - 1)]
    first, counts, owner = words.first, words.counts, words.owners()

    def add(positions, grams_at, grams, size, around):
        fps = grams[np.searchsorted(grams_at, positions)]
        if bits is not None:
            ok = bitmap.contains(bits, fps)
            positions, fps = positions[ok], fps[ok]
        for p, fp in zip(positions.tolist(), tx.signed(fps).tolist()):
            d = owner[p]
            lo, hi = max(first[d], p - around), min(first[d + 1], p + size + around)
            out[d].append((size, p - int(first[d]), fp, _phrase(words, lo, p), _phrase(words, p, p + size),
                           _phrase(words, p + size, hi)))

    at, _ = words.windows(k)
    grams = tx.window_hashes(hashes, at, k, 100 + k)
    add(kept_grams(grams, at, window - k + 1), at, grams, k, window - k)
    for size in lengths:
        at, at_owner = words.windows(size)
        grams = tx.window_hashes(hashes, at, size, 200 + size)
        if bits is None:
            whole = counts[at_owner] == size
            at, grams = at[whole], grams[whole]
        add(at, at, grams, size, 0)
    return out


def _scan(window: int, k: int, lengths: list[int], bits):
    kind = pa.list_(pa.struct([("k", pa.int32()), ("p", pa.int32()), ("fp", pa.int64()), ("before", pa.string()),
                               ("gram", pa.string()), ("after", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if bits is None else bits.value
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column("text")):
                words = tx.find_words(data, bounds, alnum=True)
                found = _candidates(words, words.hashes(), window, k, lengths, table)
                rows = [[dict(zip(("k", "p", "fp", "before", "gram", "after"), c)) for c in one] for one in found]
                names = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in names]
                    + [pa.array(words.counts, pa.int64()), pa.array(rows, kind)], [*names, "n_words", "found"])

    return run


def _list(words: str) -> Column:
    return F.when(F.col(words) == "", F.array().cast("array<string>")).otherwise(F.split(words, " "))


def _run_length(a: Column, b: Column) -> Column:
    """Equal leading words of two lists."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(first > 0, first - 1).otherwise(F.size(a)).cast("int")


def _scanned(df: DataFrame, window: int, k: int, lengths: list[int], bits) -> DataFrame:
    """The columns of ``df`` but the text, with n_words and found."""
    kept = [f for f in df.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return df.mapInArrow(_scan(window, k, lengths, bits), f"{schema}, n_words bigint, found {CANDIDATE}")


def text_key(text: Column) -> list[Column]:
    """96 bits that stand for a whole text; what is found depends on the text alone."""
    return [F.xxhash64(text).alias("key1"), F.hash(text).alias("key2")]


KEY = ["key1", "key2"]
ADDED = (*KEY, "n_words", "found", "spans", "n_hit", "items", "contaminated")


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
              window: int = WINDOW, k: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """The documents without their text, with ``key1, key2`` of it and ``n_words``; and the hits:
    key1, key2, item_id, start, end of shared word spans."""
    known = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    short = F.col("n_words") < window
    items = materialize(
        _scanned(known, window, k, list(range(1, window)), None)
        .select("item_id", "n_words", F.explode("found").alias("f"))
        .where(F.when(short, F.col("f.k") == F.col("n_words")).otherwise(F.col("f.k") == k))
        .select("item_id", short.alias("short"), "f.k", "f.fp", "f.gram", F.col("f.before").alias("item_before"),
                F.col("f.after").alias("item_after")), "items")
    lengths = sorted(r["k"] for r in items.where("short").select("k").distinct().collect())
    bits = bitmap.build(items, "fp")

    whole = F.col(text)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "text", *ADDED)]
    slim = docs.select(*others, *text_key(whole), whole.alias("text"))
    base = materialize(_scanned(slim, window, k, lengths, bits), "candidates")
    found = base.where(F.size("found") > 0).select(*KEY, F.explode("found").alias("f")).select(*KEY, "f.*")
    left = _run_length(F.reverse(_list("before")), F.reverse(_list("item_before")))
    right = _run_length(_list("after"), _list("item_after"))
    joined = found.join(items, ["fp", "k", "gram"]).withColumns({
        "left": F.when(F.col("short"), F.lit(0)).otherwise(left),
        "right": F.when(F.col("short"), F.lit(0)).otherwise(right)})
    # a long item's gram may have as many words as a short item: what was looked up for one serves both
    enough = F.when(F.col("short"), F.lit(True)).otherwise(F.col("left") + F.col("k") + F.col("right") >= window)
    hits = joined.where(enough).select(
        *KEY, "item_id", (F.col("p") - F.col("left")).alias("start"),
        (F.col("p") + F.col("k") + F.col("right")).alias("end"))
    return base.drop("found"), hits


def covered(spans: Column) -> Column:
    """Words in the union of [start, end) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.sort_array(spans), zero,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end")),
        lambda a: a["n"])


def report(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
           window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """The documents without their text, with n_words, n_hit, items (ids as sorted strings) and contaminated."""
    base, hits = find_hits(docs, benchmark, text, item_id, window, k)
    spans = hits.groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    items = (hits.select(*KEY, F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy(*KEY).agg(F.sort_array(F.collect_list("item")).alias("items")))
    none = F.array().cast("array<string>")
    return (base.join(spans.join(items, KEY), KEY, "left").withColumns({
        "n_hit": F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long"),
        "items": F.coalesce("items", none), "contaminated": F.col("spans").isNotNull()}).drop(*KEY, "spans"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """The rows without a hit, columns unchanged."""
    _, hits = find_hits(docs.select(text), benchmark, text, item_id, window, k)
    dirty = hits.select(*KEY).distinct()
    keys = [c.alias(f"__{n}") for c, n in zip(text_key(F.col(text)), KEY)]
    return (docs.select("*", *keys).join(dirty.toDF(*[f"__{n}" for n in KEY]), [f"__{n}" for n in KEY], "left_anti")
            .select(*docs.columns))
