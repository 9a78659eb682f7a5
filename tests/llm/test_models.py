"""Tokens, packing, PPM scores, quality ranks and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from orbitlens.llm import packing, pairwise_quality, ppm, queries_models
from orbitlens.llm import textops as tx
from orbitlens.llm.tokenize import Vocabulary, encode

SF = "/root/testdata/sf0.001"
ODD = ["", "a", "don't 'S 's we'll  'll've'd x're", "  two  spaces \n\n new\tline ", "!'s 's' ''s", "1234 12a b3", "é É ñ œ ß ﬁ",
       " nb  sp", "ends in space ", " \n", "emoji 😀😀 x", "中文 字", "͸ unassigned", "ẞ new capital", "a\x00b\x85c", "x'", "'", "'l", "'re'"]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(texts, limit=tx.SLICE_BYTES):
    out = []
    for _, _, data, bounds in tx.slices(pa.array(texts, pa.string()), limit):
        ids, cut = encode(data, bounds, Vocabulary.byte_bpe_50k())
        out += [ids[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])]
    return out


def test_ids_equal_the_tokenizer(spark, tokenizer):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ODD
    want = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert ids_of(texts) == want
    assert ids_of(texts, 50) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'sStlrevd  \n\t1!é中  😀"), max_size=14), min_size=1, max_size=4))
def test_ids_of_odd_texts(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    global _TOKENIZER
    try:
        t = _TOKENIZER
    except NameError:
        t = _TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert ids_of(texts) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


SPECIAL = ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "  <|endoftext|>  ", "<|endoftext", "|>", "x<|endoftext|>\u0378 <|endoftext|>",
           "<|endoftext|>don't<|endoftext|>'s"]


def test_ids_of_added_tokens(tokenizer):
    texts = SPECIAL + ODD + SPECIAL
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [50256] and ids_of(texts) == want and ids_of(texts, 20) == want


@pytest.mark.parametrize("unit", [" ", "\n", "a", "7", "!", "é", "\t ", "\u0378", " \u1e9e", "<|endoftext|>"])
def test_ids_of_runs_of_two_megabytes(tokenizer, unit):
    text = "x" + unit * (2_000_000 // len(unit.encode())) + "y z"
    assert ids_of(["before", text, None]) == [tokenizer.encode(t, add_special_tokens=False).ids for t in ("before", text, "")]


def test_ids_wider_than_sixteen_bits(tmp_path, spark):
    """A vocabulary with an id above 65,535 gives 32-bit ids and matrices of that width."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    known = spec["model"]["vocab"]
    known |= {f"unused{i}": i for i in range(50257, 70000)}
    spec["added_tokens"].append({**spec["added_tokens"][0], "id": 70000, "content": "<|wide|>"})
    path = tmp_path / "wide.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    base = Vocabulary.byte_bpe_50k()
    wide = Vocabulary(base.ranks, base.pattern, str(path))
    docs = spark.createDataFrame([(1, "a <|wide|> b"), (2, None)], "doc_id long, text string")
    row, = packing.pack_matrices(docs, capacity=16, vocabulary=wide).collect()
    ids = np.frombuffer(row["input_ids"], "<u4")
    assert len(ids) == 16 and 70000 in ids.tolist() and row["n_tokens"] == 6


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= n]
        if fit:
            i = min(fit, key=lambda i: rooms[i])
            rooms[i] -= n
        else:
            rooms.append(capacity - n)
    return Counter(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=60))
def test_plan_is_best_fit_decreasing(lengths):
    runs, windows = packing.plan(Counter(lengths), 16)
    used, seen = defaultdict(list), Counter()
    for length, rank, n, first, offset in runs:
        for i in range(n):
            used[first + i].append((offset, length))
            seen[length, rank + i] += 1
    assert seen == Counter((n, r) for n, c in Counter(lengths).items() for r in range(c))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 16
    assert sorted(used) == list(range(windows))
    rooms = Counter(16 - sum(n for _, n in parts) for parts in used.values())
    assert rooms == plain_best_fit(lengths, 16)


def packed_docs(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "déjà", "x1"], k=rng.choice([0, 3, 40, 400, 700, 3000])))) for i in range(60)]
    rows += [(100, None), (None, "no id"), (207, "same id"), (207, "same id")]
    return rows, spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, length string").repartition(3)


def test_packing_round_trip(spark, tokenizer):
    rows, df = packed_docs(spark)
    out = packing.pack(df).toPandas()
    ids = {}
    for doc, text in rows:
        ids[doc] = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    for doc, mine in out[out.doc_id.notna() & (out.doc_id != 207)].groupby("doc_id"):
        mine = mine.sort_values("start")
        assert mine.start.tolist() == np.cumsum([0, *mine.length])[:-1].tolist() and mine.length.sum() == len(ids[doc])
        for r in mine.itertuples():
            assert r.doc_tokens == len(ids[doc])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[doc][r.start:r.start + r.length], "<u4").tobytes())
    assert set(out.doc_id.dropna()) == {d for d, _ in rows if d is not None} and len(out[out.doc_id == 207]) == 2
    for _, mine in out.groupby("sequence_id"):
        mine = mine.sort_values("offset")
        assert mine.offset.tolist() == np.cumsum([0, *mine.length])[:-1].tolist() and mine.length.sum() <= 1024
    assert sorted(out.sequence_id.unique()) == list(range(out.sequence_id.nunique()))
    assert packing.pack(df.limit(0)).count() == 0


def test_matrices(spark, tokenizer):
    rows, df = packed_docs(spark)
    found = Counter()
    for r in packing.pack_matrices(df).collect():
        ids, places = np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == len(places) == 1024 and r["cu_seqlens"][-1] == r["n_tokens"] and not ids[r["n_tokens"]:].any()
        for a, b in zip(r["cu_seqlens"][:-1], r["cu_seqlens"][1:]):
            assert places[a:b].tolist() == list(range(b - a))
            found[tuple(ids[a:b].tolist())] += 1
    want = Counter()
    for _, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.update(tuple(ids[i:i + 1024]) for i in range(0, len(ids), 1024))
    assert found == want


class PlainPPM:
    def __init__(self, texts, depth):
        self.depth, self.count = depth, [defaultdict(Counter) for _ in range(depth + 1)]
        for t in texts:
            s = [ppm.START] * depth + list((t or "").encode()) + [ppm.END]
            for i in range(depth, len(s)):
                self.count[depth][tuple(s[i - depth:i])][s[i]] += 1
        for k in range(depth - 1, -1, -1):
            for ctx, symbols in self.count[k + 1].items():
                for x in symbols:
                    self.count[k][ctx[1:]][x] += 1

    def symbol(self, ctx, x):
        p, out = 1.0, set()
        for k in range(self.depth, -1, -1):
            seen = self.count[k].get(tuple(ctx[len(ctx) - k:]))
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in out}
            n, t = sum(left.values()), len(left)
            if x in left:
                return p * left[x] / (n + t)
            if t:
                p *= t / (n + t)
            out |= set(seen)
        return p / (ppm.SYMBOLS - len(out))

    def score(self, text):
        s = [ppm.START] * self.depth + list((text or "").encode()) + [ppm.END]
        return sum(math.log10(self.symbol(s[i - self.depth:i], s[i])) for i in range(self.depth, len(s)))


@pytest.mark.parametrize("head", [0, 40, 1 << 20])
def test_ppm_equals_plain(spark, head):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abc dé", weights=[5, 3, 1, 2, 1, 1], k=rng.randint(0, 60))) for _ in range(60)] + [None, "", "zzz new", "abab" * 30]
    rows = [(i, t, i % 5 == 0 or i > 60) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, out boolean").repartition(3)
    got = {r["doc_id"]: r for r in ppm.score(df, F.col("out"), depth=3, head=head).collect()}
    learn = [t for _, t, out in rows if not out]
    model = PlainPPM(learn, 3)
    c = Counter(w for t in learn for w in (t or "").encode().lower().split())
    ends, n, v = len(learn), sum(c.values()) + len(learn), len(c) + 1
    for i, t, out in rows:
        w = (t or "").encode().lower().split()
        base = sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in [*[c[y] for y in w], ends])
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out, len(w) + 1, sum(c[y] > 0 for y in w) + 1, n)
        assert r["base_score"] == pytest.approx(base, abs=1e-6) and r["score"] == pytest.approx(model.score(t), abs=1e-6)
    total = sum(model.symbol([97, 98, 32], x) for x in range(256))
    assert total == pytest.approx(1)
    assert ppm.score(df.limit(0), F.col("out")).count() == 0


def test_ppm_without_training_texts(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in ppm.score(df, F.lit(True)).collect()}
    assert got[1]["score"] == pytest.approx(-3 * math.log10(256)) and got[2]["n_known"] == 0


def test_quality_rank_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = queries_models.op2_quality_rank(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = out[out.held_out]
    right = held.predicted == held.quality
    assert len(held) > 30 and right.mean() > 0.9
    assert ((out.score >= 0.3) == (out.predicted == 1)).all() and out.score.between(0, 1).all()


def test_quality_rank_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "Some words here.", "x")], "doc_id long, text string, score string")
    described = pairwise_quality.describe(docs)
    assert pairwise_quality.score(described, None).select("predicted").distinct().count() == 1
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (7, None)], "doc_id long, quality int")
    ranker = pairwise_quality.fit(described, labels)
    assert pairwise_quality.score(described, ranker).count() == 4
    assert pairwise_quality.fit(described, labels.where("quality = 1")) is None
    assert pairwise_quality.score(pairwise_quality.describe(docs.limit(0)), None).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.toPandas().set_index("doc_id")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == before.reset_index().columns.tolist(), name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/t-{name}"
        out.write.parquet(path)
        left = docs.count()
        docs = spark.read.parquet(path)
        assert 0 < docs.count() <= left
    after = docs.toPandas().set_index("doc_id")
    assert after.index.is_unique and (after.text.str.len() == after.n_chars).all()
    for doc, text in after.text.items():
        it = iter(before.text[doc].split())
        assert all(w in it for w in text.split())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == len(after)
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()


def test_ppm_table_finds_what_a_dict_finds():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 300, 5000):
        keys = np.unique(np.concatenate([np.arange(n // 2), rng.integers(0, 1 << 64, n - n // 2, dtype=np.uint64)]).astype(np.uint64))
        keys = keys[np.argsort(ppm._share(keys, 64))]
        table, known = ppm._Table(keys, np.arange(len(keys)) + 0.5), dict(zip(keys.tolist(), np.arange(len(keys)) + 0.5))
        wanted = np.concatenate([keys, np.arange(n + 3, dtype=np.uint64), rng.integers(0, 1 << 64, 500, dtype=np.uint64), [np.uint64(2**64 - 1)]])
        found = table.look_up(wanted)
        assert [None if math.isnan(x) else x for x in found.tolist()] == [known.get(k) for k in wanted.tolist()]


def peak_mb(run):
    import tracemalloc

    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_ppm_tasks_hold_little():
    """Counting and scoring 8 MB of texts takes the memory of a slice and of the tables, not of several megabytes of text."""
    from types import SimpleNamespace

    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"abcdefghijklmnop    ", np.uint8)
    texts = [letters[rng.integers(0, len(letters), 4000)].tobytes().decode() for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "held_out": [i % 10 == 0 for i in range(len(texts))], "text": texts})
    empty = SimpleNamespace(value=(np.empty(0, np.uint64), np.empty(0)))
    assert peak_mb(lambda: [None for _ in ppm._score(6, empty, empty)(iter([batch]))]) < 80


def test_ppm_counts_travel_in_blocks():
    """Ten times the same texts leave a task as few packed rows, which come back as one row a key."""
    texts = ["ab ba", "", None, "abab zz"] * 10
    held = [False, False, True, True] * 10
    batch = pa.RecordBatch.from_pydict({"held_out": held, "text": pa.array(texts, pa.string())})
    blocks = list(ppm._gather(2)(iter([batch, batch])))
    rows = [r for b in ppm._merge(iter(blocks)) for r in b.to_pylist()]
    assert len({(r["kind"], r["key"]) for r in rows}) == len(rows) and sum(b.num_rows for b in blocks) <= sum(1 + (0 < r["learnt"] < r["seen"]) for r in rows)
    want, learnt = Counter(), Counter()
    for t, out in zip(texts * 2, held * 2):
        s = bytes([ppm.START] * 2) + (t or "").encode() + bytes([ppm.END])
        for i in range(2, len(s)):
            key = s[i] | s[i - 1] << 8 | s[i - 2] << 16
            want[key] += 1
            learnt[key] += not out
    assert {r["key"]: (r["learnt"], r["seen"]) for r in rows if r["kind"] == ppm.GRAM} == {k: (learnt[k], n) for k, n in want.items()}
    assert sum(r["seen"] for r in rows if r["kind"] == ppm.WORD) == 2 * 10 * (2 + 2)


def test_ppm_tasks_hold_the_head_once():
    """Look-ups add no second copy, but at most half more than its own size in passing, to a head of the largest size."""
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 56, ppm.HEAD, dtype=np.uint64))
    keys = keys[np.argsort(ppm._share(keys, 64))]
    values = np.arange(len(keys)) + 0.5
    found = []
    assert peak_mb(lambda: found.append(ppm._Table(keys, values).look_up(keys[::97]))) < 1.5 * (keys.nbytes + values.nbytes) / 1e6
    assert np.array_equal(found[0], values[::97])


def test_ppm_counting_holds_little():
    """Counting 8 MB of texts of hardly any repeated gram, and bringing the counts together, doesn't hold them over and over."""
    rng = np.random.default_rng(6)
    letters = np.frombuffer(b"abcdefghijklmnop    ", np.uint8)
    texts = [letters[rng.integers(0, len(letters), 4000)].tobytes().decode() for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"held_out": [False] * len(texts), "text": texts})
    blocks = []
    assert peak_mb(lambda: blocks.extend(ppm._gather(6)(iter([batch])))) < 150
    parts = [b.filter(pa.array(b.column("share").to_numpy() % 4 == 0)) for b in blocks]
    rows = []
    assert peak_mb(lambda: rows.extend(b.num_rows for b in ppm._merge(iter(parts)))) < 115
    assert sum(rows) > 1_000_000
