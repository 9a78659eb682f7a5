"""Document quality by Bradley-Terry pairwise ranking.

Every document is described by style features of its whole text. A linear score is learnt from
preference pairs (a document labelled 1 is preferred to one labelled 0): the Bradley-Terry model
gives the preference the probability sigmoid(score difference), so the loss is logistic loss on
feature differences. The cut between the classes is a quantile of the scores: the share of label 0
among the labelled documents, so that the same share falls below it. Scores are then moved and
squashed to 0..1 with the cut at ``CUT``.

The fit uses a bounded sample: at most ``SAMPLE`` labelled documents of each class, drawn by a hash
of the id, and ``STEPS * BATCH`` pairs of them. All documents are scored from a feature table that
one pass over the texts writes.

Defined cases: null text counts as empty, whose features are all zero, and is scored like others; null ids
and null labels take no part in the fit; repeated rows are judged alike; very long texts are described whole; equal
features get equal scores, and a score at the cut counts as label 1; input columns called ``features``, ``score`` or
``predicted`` are replaced, others are kept; with one class or no labels at all every
document gets the score CUT, which counts as label 1; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import textops as tx
from orbitlens.session import materialize

SAMPLE = 10_000
STEPS, BATCH = 1500, 2048
BINS = 12
CUT = 0.3

#: groups of bytes whose shares are features
GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"!", b"?", b".", b",",
          b"@/:", b"()[]{}", b"'\"", b"-_", b"=+~^\\`;", b"\n", b" \t"]


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of float32 features for each document."""
    n = len(bounds) - 1
    group = np.zeros(256, np.int64)
    for i, members in enumerate(GROUPS):
        group[list(members)] = i + 1
    group[128:] = len(GROUPS) + 1
    n_groups = len(GROUPS) + 2
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    shares = np.bincount(owner * n_groups + group[data], minlength=n * n_groups).reshape(n, n_groups)
    words = tx.find_words(data, bounds)
    h, counts, first = words.hashes(), words.counts, words.first
    of = words.owners()

    def per_word(flags: np.ndarray) -> np.ndarray:
        return tx.sums(flags.astype(np.int64), first) / np.maximum(counts, 1)

    def repeated(values: np.ndarray, whose: np.ndarray) -> np.ndarray:
        """Share of a document's values that equal another of its values."""
        order = np.lexsort((values, whose))
        v, w = values[order], whose[order]
        same = (v[1:] == v[:-1]) & (w[1:] == w[:-1])
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        total = np.bincount(w, minlength=n)
        return np.bincount(w, weights=twice, minlength=n) / np.maximum(total, 1)

    before = np.zeros(len(h), bool)
    if len(h) > 1:
        before[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    length = words.ends - words.starts
    last = data[words.ends - 1] if len(h) else np.empty(0, np.uint8)
    initial = data[words.starts] if len(h) else np.empty(0, np.uint8)
    second = data[np.minimum(words.starts + 1, max(len(data) - 1, 0))] if len(h) else np.empty(0, np.uint8)
    at, whose = words.windows(3)
    threes = repeated(tx.window_hashes(h, at, 3, 71), whose) if len(at) else np.zeros(n)
    at, whose = words.windows(5)
    fives = repeated(tx.window_hashes(h, at, 5, 72), whose) if len(at) else np.zeros(n)
    upper = (initial >= 65) & (initial <= 90)
    columns = [
        np.log1p(counts), np.log1p(sizes), tx.sums(length, first) / np.maximum(counts, 1),
        per_word(before), repeated(h, of) if len(h) else np.zeros(n), threes, fives,
        per_word(last == 46), per_word(last == 44), per_word(last == 33), per_word(last == 124),
        per_word(upper), per_word(upper & (second >= 65) & (second <= 90)), per_word(length == 1), per_word(length > 12),
        shares[:, GROUPS.index(b"\n") + 1] / np.maximum(counts, 1),
    ]
    share = np.sqrt(shares[:, 1:] / np.maximum(sizes, 1)[:, None])
    return np.concatenate([np.stack(columns, axis=1), share], axis=1).astype(np.float32)


N_FEATURES = 16 + len(GROUPS) + 1


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = None
    for batch in batches:
        names = names or [c for c in batch.schema.names if c != "text"]
        for lo, hi, data, bounds in tx.slices(batch.column("text")):
            rows = features(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(lo, hi - lo) for c in names] + [pa.array([r.tobytes() for r in rows], pa.binary())],
                [*names, "features"])


@dataclass(frozen=True)
class Ranker:
    """Bin edges (features x edges), a weight for each feature and bin, and the cut of the raw scores."""

    edges: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for i in range(x.shape[1]):
            out += self.weights[i][np.searchsorted(self.edges[i], x[:, i], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + math.log(CUT / (1 - CUT)), -500, 500)))


def fit_pairs(good: np.ndarray, bad: np.ndarray, share_bad: float, seed: int = 5, ridge: float = 1e-3) -> Ranker:
    """Stochastic gradient (Adam) on preference pairs drawn from both samples."""
    both = np.concatenate([good, bad])
    edges = np.stack([np.quantile(both[:, i], np.linspace(0, 1, BINS + 1)[1:-1]) for i in range(both.shape[1])])
    # quantiles of all rows and of the rare class: both shapes get bins
    rare = np.stack([np.quantile(bad[:, i], np.linspace(0, 1, BINS // 2 + 1)[1:-1]) for i in range(both.shape[1])])
    edges = np.sort(np.concatenate([edges, rare], axis=1), axis=1)
    n, m = edges.shape[0], edges.shape[1] + 1

    def bins(x):
        return np.stack([np.searchsorted(edges[i], x[:, i], "right") + i * m for i in range(n)], axis=1)

    a, b = bins(good), bins(bad)
    rng = np.random.default_rng(seed)
    w, first, second = np.zeros(n * m), np.zeros(n * m), np.zeros(n * m)
    for step in range(1, STEPS + 1):
        i, j = rng.integers(0, len(a), BATCH), rng.integers(0, len(b), BATCH)
        margin = w[a[i]].sum(axis=1) - w[b[j]].sum(axis=1)
        pull = 1 / (1 + np.exp(np.clip(margin, -50, 50))) / BATCH
        grad = np.bincount(b[j].ravel(), np.repeat(pull, n), n * m) - np.bincount(a[i].ravel(), np.repeat(pull, n), n * m)
        grad += ridge * w / len(w)
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        rate = 0.05 * (1 - step / (STEPS + 1))
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    found = Ranker(edges, w.reshape(n, m), 0.0)
    scores = np.concatenate([found.raw(good), found.raw(bad)])
    weight = np.concatenate([np.full(len(good), (1 - share_bad) / len(good)), np.full(len(bad), share_bad / len(bad))])
    order = np.argsort(scores)
    at = int(np.searchsorted(np.cumsum(weight[order]), share_bad))
    low, high = scores[order[max(at - 1, 0)]], scores[order[min(at, len(order) - 1)]]
    return Ranker(edges, w.reshape(n, m), float((low + high) / 2))


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of the documents with ``features``, written once."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "features", "text")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", features binary"
    return materialize(docs.select(*[f.name for f in kept], F.col(text).alias("text")).mapInArrow(_describe, schema), "features")


def fit(described: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE
        ) -> Ranker | None:
    """A ranker from labelled rows; None without both classes."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("__id"), F.col(label).alias("__label"))
    counts = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    place = F.pmod(F.xxhash64(F.lit(23), "__id"), F.lit(1 << 30))
    limit = F.when(F.col("__label") == 1, F.lit(int(min(1, sample / counts[1]) * (1 << 30)))).otherwise(
        F.lit(int(min(1, sample / counts[0]) * (1 << 30))))
    drawn = known.where(place < limit)
    got = described.join(drawn, described[doc_id] == drawn["__id"]).select("__label", "features").toArrow()
    x = np.frombuffer(b"".join(got["features"].to_pylist()), np.float32).reshape(-1, N_FEATURES)
    y = got["__label"].to_numpy()
    if not (y == 1).any() or not (y == 0).any():
        return None
    return fit_pairs(x[y == 1], x[y == 0], counts[0] / (counts[0] + counts[1]))


def score(described: DataFrame, ranker: Ranker | None) -> DataFrame:
    """The rows with ``score`` and ``predicted`` instead of the features."""
    if ranker is None:
        return described.withColumns({"score": F.lit(CUT), "predicted": F.lit(1)}).drop("features")
    shared = described.sparkSession.sparkContext.broadcast(ranker)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("features").to_pylist()), np.float32).reshape(-1, N_FEATURES)
            s = shared.value.score(x)
            names = [c for c in batch.schema.names if c not in ("features", "score", "predicted")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                [*names, "score", "predicted"])

    kept = [f for f in described.schema.fields if f.name not in ("features", "score", "predicted")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score double, predicted int"
    return described.mapInArrow(run, schema)
