"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a byte-context trie of depth ``DEPTH``, learnt from the training documents. A text is
its bytes and an end symbol; contexts reach back over the start of a text into start symbols.

* Top contexts count symbols; a shorter context counts a symbol once for each longer context it
  was seen in (update exclusion).
* Escapes follow method C: a context with ``n`` counts of ``t`` distinct symbols predicts a symbol
  counted ``c`` times by ``c / (n + t)`` and escapes to the next shorter one by ``t / (n + t)``.
* Symbol exclusion: after an escape, the symbols of the longer context are taken out of the
  counts. These are always among the symbols of the shorter one, so what is left of ``n`` and
  ``t`` depends on the two contexts only and is computed once for each. Below the empty context all
  symbols not yet excluded are equally likely.

The probability of a symbol is thus a function of its context and itself, an (order + 1)-gram. It
is computed by joins for every distinct gram of the corpus. Scoring looks up the most frequent
grams (at most ``HEAD`` of them, none rarer than ``RARE``) in a broadcast table and sends the rest, a row per document and
gram, to a join. So the trie may be of any size; only the head is of fixed size.

The unigram base score counts words in the same passes and uses the same split of head and tail.

Defined cases: null text counts as empty, which is an end symbol alone; repeated rows are scored
and learnt like others; very long texts are scored whole, a slice of their own; grams of equal number may stand in
the head or go by the join, with the same result; without training texts every symbol is equally likely; an empty
table gives no rows; further columns are not looked at, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import textops as tx
from orbitlens.session import materialize

DEPTH = 6
START, END = 0xFE, 0xFF  # bytes that UTF-8 does not use
SYMBOLS = 256
HEAD = 1 << 21
#: grams and words seen less often than this are looked up by joins at every corpus size
RARE = 4
#: bytes of text worked on at once, so that what a task holds stays small and near its caches
SLICE = 1 << 18
#: grams or words counted at once, and distinct ones a task gathers before it passes them on
RUN, GATHER = 1 << 19, 1 << 21
#: keys and counts travel in packed blocks, one for each of 2**BLOCK_BITS shares of the keys
BLOCK_BITS, CODEC = 11, "zstd"
GRAM, WORD = 0, 1


def grams(data: np.ndarray, bounds: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of every text: its gram (depth context bytes and itself); bounds of the texts."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    wide = bounds + np.arange(n + 1) * (depth + 1)
    out = np.full(wide[-1], START, np.uint64)
    out[np.arange(len(data)) + np.repeat(np.arange(n) * (depth + 1) + depth, sizes)] = data
    out[wide[1:] - 1] = END
    key = out[depth:].copy()
    for j in range(1, depth + 1):
        key |= out[depth - j: len(out) - j] << np.uint64(8 * j)
    return key[out[depth:] != START], bounds + np.arange(n + 1)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The distinct values of parts, sorted, each with the sums of its weights; takes the parts, so they aren't held twice."""
    columns = [list(x) for x in zip(*parts)]
    parts.clear()

    def taken(column: list[np.ndarray]) -> np.ndarray:
        whole = np.concatenate(column)
        column.clear()
        return whole

    values = taken(columns[0])
    order = np.argsort(values, kind="stable")
    values = values[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    values = values[first]
    return values, *(np.add.reduceat(taken(w)[order], first) for w in columns[1:])


def _share(keys: np.ndarray, bits: int) -> np.ndarray:
    """The upper bits of a multiplicative hash."""
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


class _Gathered:
    """Counts of 64-bit keys, run by run, merged and passed on in blocks."""

    def __init__(self, kind: int, learnt: bool):
        self.kind, self.learnt, self.parts, self.size, self.waiting, self.held = kind, learnt, [], 0, [], 0

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.held += len(values)
        if self.held >= RUN:
            self._count()

    def _count(self) -> None:
        found, n = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.held = [], 0
        self.parts.append((found, n.astype(np.int64)))
        self.size += len(found)

    def take(self, least: int) -> Iterator[pa.RecordBatch]:
        """Passes on what was gathered, if it is more than ``least``."""
        if self.held and not least:
            self._count()
        if self.size <= least:
            return
        values, n = _merged(self.parts)
        if len(values) <= least // 2:
            self.parts, self.size = [(values, n)], len(values)
            return
        self.parts, self.size = [], 0
        share = _share(values, BLOCK_BITS).astype(np.uint16)
        order = np.argsort(share, kind="stable")
        values, n = values[order], n[order].view(np.uint64)
        sizes = np.bincount(share, minlength=1 << BLOCK_BITS)
        found, ends = np.flatnonzero(sizes), np.cumsum(sizes)
        blocks = [pa.compress(np.concatenate([values[hi - size:hi], n[hi - size:hi]]), CODEC, asbytes=True)
                  for hi, size in zip(ends[found], sizes[found])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(np.full(len(found), self.kind, np.int32)),
             pa.array(np.full(len(found), self.learnt)), pa.array(sizes[found]), pa.array(blocks, pa.binary())],
            ["share", "kind", "learnt", "size", "block"])


BLOCKS = "share int, kind int, learnt boolean, size bigint, block binary"


def _gather(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = {(kind, learnt): _Gathered(kind, learnt) for kind in (GRAM, WORD) for learnt in (True, False)}
        for batch in batches:
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            for lo, hi, data, bounds in tx.slices(batch.column("text"), SLICE):
                out = held[lo:hi]
                found, cut = grams(data, bounds, depth)
                of_held = np.repeat(out, np.diff(cut))
                words = tx.find_words(data, bounds, lower=True)
                hashes, word_held = words.hashes(), out[words.owners()]
                for learnt in (True, False):
                    parts[GRAM, learnt].add(found[of_held != learnt])
                    parts[WORD, learnt].add(hashes[word_held != learnt])
                for part in parts.values():
                    yield from part.take(GATHER)
        for part in parts.values():
            yield from part.take(0)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of whole shares, in any order, as (kind, key, learnt, seen) with one row a key."""
    parts = {kind: [] for kind in (GRAM, WORD)}
    pending = dict.fromkeys(parts, 0)
    for batch in batches:
        for kind, learnt, size, block in zip(*(batch.column(x) for x in ("kind", "learnt", "size", "block"))):
            kind, size = kind.as_py(), size.as_py()
            keys, n = np.frombuffer(pa.decompress(block.as_buffer(), 16 * size, CODEC), np.uint64).reshape(2, size)
            n, held = n.view(np.int64), parts[kind]
            held.append((keys, n if learnt.as_py() else np.zeros(size, np.int64), n))
            pending[kind] += size
            if pending[kind] >= max(RUN, len(held[0][0])):
                held.append(_merged(held))
                pending[kind] = 0
    for kind, held in parts.items():
        if held:
            keys, learnt, seen = _merged(held)
            for i in range(0, len(keys), 1 << 18):
                k = keys[i:i + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), kind, np.int32)), pa.array(tx.signed(k)), pa.array(learnt[i:i + (1 << 18)]),
                     pa.array(seen[i:i + (1 << 18)])], ["kind", "key", "learnt", "seen"])


def _low(name: str, k: int) -> Column:
    """The gram of order k at the end of a longer one."""
    return F.col(name).bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))


def gram_scores(counts: DataFrame, depth: int) -> DataFrame:
    """(key, seen, value) with the natural-log probability of every gram; counts: key, learnt, seen."""
    level = {depth: counts.where("learnt > 0").select("key", F.col("learnt").alias("c"))}
    for k in range(depth - 1, -1, -1):
        level[k] = materialize(level[k + 1].groupBy(_low("key", k).alias("key")).agg(F.count("*").alias("c")), f"order{k}")
    node = {}
    for k in range(depth + 1):
        rows = level[k].withColumn("ctx", F.shiftrightunsigned("key", 8))
        if k:
            shorter = level[k - 1].select(F.col("key").alias("low"), F.col("c").alias("low_c"))
            rows = rows.withColumn("low", _low("key", k - 1)).join(shorter, "low")
        else:
            rows = rows.withColumn("low_c", F.lit(0))
        node[k] = rows.groupBy("ctx").agg(F.sum("c").alias("n"), F.count("*").alias("t"), F.sum("low_c").alias("e"))

    # bottom up over the grams that training has not seen in full: p, the log probability from this order on; c, n, t of
    # the gram and its context; r, the log probability below this order once its context has escaped
    new = {depth: counts.where("learnt = 0").select("key")}
    for k in range(depth - 1, -1, -1):
        new[k] = new[k + 1].select(_low("key", k).alias("key")).distinct()
    below = None
    for k in range(depth + 1):
        rows = (new[k].join(level[k], "key", "left") if k < depth else new[k].withColumn("c", F.lit(None).cast("long")))
        rows = rows.withColumn("ctx", F.shiftrightunsigned("key", 8)).join(node[k], "ctx", "left")
        if below is None:
            r, shorter_p = -F.log(SYMBOLS - F.coalesce("t", F.lit(0)).cast("double")), F.log(F.lit(1.0 / SYMBOLS))
        else:
            rows = rows.withColumn("low", _low("key", k - 1)).join(below, "low")
            n, t = F.col("low_n") - F.col("e"), F.col("low_t") - F.col("t")
            # of no use, and possibly 0 / 0, where the context itself has the symbol
            r = (F.when(F.col("low_c") > 0, F.log(F.try_divide(F.col("low_c"), n + t)))
                 .when(t > 0, F.log(F.try_divide(t, n + t)) + F.col("low_r")).otherwise(F.col("low_r")))
            shorter_p = F.col("low_p")
        rows = rows.withColumn("r", r)
        p = (F.when(F.col("n").isNull(), shorter_p)
             .when(F.col("c") > 0, F.log(F.col("c") / (F.col("n") + F.col("t"))))
             .otherwise(F.log(F.col("t") / (F.col("n") + F.col("t"))) + F.col("r")))
        rows = rows.select("key", p.alias("p"), "c", "n", "t", "r")
        below = rows.select(*[F.col(x).alias("low" if x == "key" else f"low_{x}") for x in rows.columns])
        if k < depth:
            below = materialize(below, f"below{k}")
    unseen = below.select(F.col("low").alias("key"), F.col("low_p").alias("value"))
    top = node[depth]
    learnt = (level[depth].withColumn("ctx", F.shiftrightunsigned("key", 8)).join(top, "ctx")
              .select("key", F.log(F.col("c") / (F.col("n") + F.col("t"))).alias("value")))
    return learnt.union(unseen).join(counts.select("key", "seen"), "key")


class _Table:
    """Values of 64-bit keys, searched in the arrays of a head as they travel, in the order of the keys' hashes; only the
    first place for each share of the hashes is added, so a task holds the head once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        n = len(keys)
        self.keys, self.values, self.bits = keys, values, max(1, (2 * n - 1).bit_length())
        self.first = np.zeros((1 << self.bits) + 1, np.int32)
        for i in range(0, n, RUN):
            share = _share(keys[i:i + RUN], self.bits).astype(np.int64)
            self.first[share[0] + 1:share[-1] + 2] += np.bincount(share - share[0]).astype(np.int32)
        np.cumsum(self.first, out=self.first)
        np.minimum(self.first, max(0, n - 1), out=self.first)

    def look_up(self, wanted: np.ndarray) -> np.ndarray:
        """Values of keys, nan where the table has none."""
        if not len(self.keys):
            return np.full(len(wanted), np.nan)
        hashes = _share(wanted, 64)
        at = self.first[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64)
        found = self.keys[at]
        out = np.where(found == wanted, self.values[at], np.nan)
        rest = np.flatnonzero(_share(found, 64) < hashes)
        at = at[rest] + 1
        while len(rest):
            rest, at = rest[at < len(self.keys)], at[at < len(self.keys)]
            found, sought = self.keys[at], hashes[rest]
            hit = found == wanted[rest]
            out[rest[hit]] = self.values[at[hit]]
            on = _share(found, 64) < sought
            rest, at = rest[on], at[on] + 1
        return out


def split_head(scored: DataFrame, head: int) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame]:
    """The keys seen RARE times or more, the most frequent ``head`` at most, in the order of their hashes, with their
    values; the others as (key, value)."""
    power = F.floor(F.log2(F.col("seen").cast("double"))).cast("int")
    sizes = {r["power"]: r["n"] for r in scored.groupBy(power.alias("power")).agg(F.count("*").alias("n")).collect()}
    least, total = 1 << 62, 0
    for p in sorted(sizes, reverse=True):
        if total + sizes[p] > head or 1 << p < RARE:
            break
        least, total = 1 << p, total + sizes[p]
    got = scored.where(F.col("seen") >= least).select("key", "value").toArrow()
    keys = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(_share(keys, 64))
    return (keys[order], got["value"].to_numpy()[order]), scored.where(F.col("seen") < least).select("key", "value")


def _rest(values: np.ndarray, missing: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Per document, the (key, times) of the keys that the head does not have."""
    where = np.flatnonzero(missing)
    doc = np.searchsorted(bounds, where, "right") - 1
    kind = pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())]))
    if not len(where):
        return pa.array([[]] * (len(bounds) - 1), kind)
    keys = tx.signed(values[where])
    order = np.lexsort((keys, doc))
    doc, keys = doc[order], keys[order]
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1])))
    times = np.diff(np.append(first, len(doc)))
    rows = pa.StructArray.from_arrays([pa.array(keys[first]), pa.array(times.astype(np.int64))], ["key", "times"])
    offsets = np.searchsorted(doc[first], np.arange(len(bounds)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), rows)


REST = "array<struct<key:bigint,times:bigint>>"


def _score(depth: int, gram_head: Broadcast, word_head: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent_grams, frequent_words = _Table(*gram_head.value), _Table(*word_head.value)
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column("text"), SLICE):
                found, cut = grams(data, bounds, depth)
                value = frequent_grams.look_up(found)
                words = tx.find_words(data, bounds, lower=True)
                hashes = words.hashes()
                count = frequent_words.look_up(hashes)
                no_gram, no_word = np.isnan(value), np.isnan(count)
                known = np.where(no_word, 0, count)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo),
                    pa.array(words.counts.astype(np.int64)), pa.array(tx.sums(np.where(no_gram, 0, value), cut)),
                    pa.array(tx.sums(np.where(no_word, 0, np.log10(known + 0.1)), words.first)),
                    pa.array(tx.sums((known > 0).astype(np.int64), words.first)),
                    _rest(found, no_gram, cut), _rest(hashes, no_word, words.first)],
                    ["doc_id", "held_out", "n_words", "value", "base", "known", "grams", "words"])

    return run


def _tail(base: DataFrame, column: str, table: DataFrame, value: Column, name: str) -> DataFrame:
    """rid and the sum over a document's tail keys."""
    rows = base.where(F.size(column) > 0).select("rid", F.explode(column).alias("x")).select("rid", "x.key", "x.times")
    return rows.join(table, "key", "left").groupBy("rid").agg(
        F.sum(value * F.col("times")).alias(name),
        F.sum(F.when(F.col("value") > 0, F.col("times")).otherwise(0)).alias(f"{name}_known"))


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH,
          head: int = HEAD) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    The model learns from the rows that are not held out. n_tokens counts words and one end.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"),
                       F.col(text).alias("text"))
    counts = materialize(
        slim.select("held_out", "text").mapInArrow(_gather(depth), BLOCKS).repartition("share")
        .mapInArrow(_merge, "kind int, key bigint, learnt bigint, seen bigint"), "counts")
    of_words = counts.where(F.col("kind") == WORD)
    ends = slim.where(~F.col("held_out")).count()
    words = of_words.where("learnt > 0").agg(F.sum("learnt").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = (words["n"] or 0) + ends, words["v"] + (1 if ends else 0)
    scored = materialize(gram_scores(counts.where(F.col("kind") == GRAM).drop("kind"), depth), "grams")
    gram_head, gram_tail = split_head(scored, head)
    word_head, word_tail = split_head(of_words.select("key", "seen", F.col("learnt").cast("double").alias("value")), head)
    shared = spark.sparkContext.broadcast
    kind = slim.schema["doc_id"].dataType.simpleString()
    base = materialize(
        slim.mapInArrow(_score(depth, shared(gram_head), shared(word_head)),
                        f"doc_id {kind}, held_out boolean, n_words bigint, value double, base double, known bigint, "
                        f"grams {REST}, words {REST}").withColumn("rid", F.monotonically_increasing_id()), "scores")
    more = _tail(base, "grams", gram_tail, F.col("value"), "g")
    words_more = _tail(base, "words", word_tail, F.log10(F.coalesce("value", F.lit(0.0)) + 0.1), "w")
    out = base.drop("grams", "words").join(more, "rid", "left").join(words_more, "rid", "left")
    space = math.log10(tokens + 0.1 * (distinct + 1))
    end = math.log10(ends + 0.1)
    zero = F.lit(0)
    return out.select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("w_known", zero) + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("w", F.lit(0.0)) + end - (F.col("n_words") + 1) * space).alias("base_score"),
        ((F.col("value") + F.coalesce("g", F.lit(0.0))) / math.log(10)).alias("score"))
