"""Defined cases of all operators: very long texts, ties, clashing columns; plain versions of the quality fit; the pipeline on odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_models import PlainPPM
from test_overlap import plain_components, plain_hits, plain_removed

import corpus_pipeline
from orbitlens.llm import decontaminate, merkle, near_dups, packing, pairwise_quality, passages, personal_data, ppm, preferences, quality_rules, sharding
from orbitlens.llm import textops as tx

SF = "/root/testdata/sf0.001"


def long_text(seed, n=420_000):
    """About 2.5 MB: more than a slice."""
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**4)}" for _ in range(n))


@pytest.fixture(scope="module")
def long_docs(spark):
    one = long_text(1)
    words = one.split()
    near = list(words)
    for i in range(0, len(near), 4000):
        near[i] = "edited"
    rows = [(1, one), (2, " ".join(near)), (3, long_text(2)), (4, "short text of a few words"), (5, None), (2, " ".join(near))]
    assert len(one) > tx.SLICE_BYTES
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_near_dups_of_long_texts(long_docs):
    rows, df = long_docs
    sets, want = plain_components(rows, 5, 80)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dups.find_components(df).collect())
    assert got == sorted((d, len(s), c) for (d, _), s, c in zip(rows, sets, want))


def test_passages_of_long_texts(long_docs):
    rows, df = long_docs
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_words"].encode()).hexdigest())
                 for r in passages.remove_repeats(df).collect())
    assert got == sorted(plain_removed(rows, 13))


def test_decontamination_of_long_texts(spark, long_docs):
    rows, df = long_docs
    words = rows[2][1].split()
    items = [(1, " ".join(words[1000:1012])), (2, "nothing of the kind " * 4), (3, " ".join(words[-10:])), (4, None)]
    got = {r["doc_id"]: (r["n_hit"], sorted(r["items"])) for r in decontaminate.report(
        df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got[3] == (22, ["1", "3"]) and got[1] == (0, []) and got[5] == (0, [])


def test_quality_sharding_tokens_and_spans_of_long_texts(long_docs):
    rows, df = long_docs
    described = pairwise_quality.describe(df)
    assert pairwise_quality.score(described, None).count() == len(rows)
    sizes = {r["doc_id"]: r["size"] for r in sharding.shuffle_into_shards(df, 2).collect()}
    assert sizes[1] == len(rows[0][1]) + 16
    pieces = packing.pack(df).where("doc_id = 3").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).first()
    assert pieces["n"] == pieces["d"]
    assert {r["rejected_by"] for r in quality_rules.judge(df.where("doc_id = 3")).collect()} <= {None, "stuttering", "repetitive"}
    assert personal_data.find(df).where("size(spans) > 0").count() == 0
    proofs = merkle.prove(merkle.build(df.withColumn("lang", F.lit("x")), ["doc_id", "text"], carried={"as_is": F.lit(None).cast("string")}), "as_is")
    assert proofs.where("verified").count() == len(rows)


def test_ppm_of_a_long_text_and_clashing_columns(spark):
    text = "ab ba " * 400_000 + "x"
    rows = [(1, text, False), (2, "ab x", True), (2, "ab x", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, out boolean").withColumns({"rid": F.lit(1), "key": F.lit("k"), "score": F.lit("s")})
    got = [(r["doc_id"], r["score"]) for r in ppm.score(df, F.col("out"), depth=2).collect()]
    model = PlainPPM([text], 2)
    symbol = lru_cache(None)(lambda a, b, x: math.log10(model.symbol([a, b], x)))
    for doc, found in got:
        s = [ppm.START] * 2 + list(dict((i, t) for i, t, _ in rows)[doc].encode()) + [ppm.END]
        assert found == pytest.approx(sum(symbol(s[i - 2], s[i - 1], s[i]) for i in range(2, len(s))), rel=1e-9)


def test_ppm_of_production_depth_equals_plain(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcd é", k=rng.randrange(0, 90))) for _ in range(40)] + ["abcabcabcabc", "", None, "zz"]
    df = spark.createDataFrame([(i, t, i % 4 == 0) for i, t in enumerate(texts)], "doc_id long, text string, out boolean")
    got = {r["doc_id"]: r["score"] for r in ppm.score(df, F.col("out")).collect()}
    model = PlainPPM([t for i, t in enumerate(texts) if i % 4], ppm.DEPTH)
    assert ppm.DEPTH == 6 and all(got[i] == pytest.approx(model.score(t), abs=1e-6) for i, t in enumerate(texts))


def plain_features(text):
    """The style features of one text, in plain Python."""
    data = (text or "").encode()
    words, n_bytes = data.split(), max(len(data), 1)
    n = max(len(words), 1)

    def repeated(values):
        c = Counter(values)
        return sum(x for x in c.values() if x > 1) / max(len(values), 1)

    def share(test):
        return sum(map(test, words)) / n

    upper = lambda b: 65 <= b <= 90
    grams = lambda k: [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
    shares = [sum(b in group for b in data) for group in pairwise_quality.GROUPS] + [sum(b > 127 for b in data)]
    return [
        math.log1p(len(words)), math.log1p(len(data)), sum(map(len, words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, repeated(words), repeated(grams(3)), repeated(grams(5)),
        share(lambda w: w[-1] == 46), share(lambda w: w[-1] == 44), share(lambda w: w[-1] == 33), share(lambda w: w[-1] == 124),
        share(lambda w: upper(w[0])), share(lambda w: upper(w[0]) and len(w) > 1 and upper(w[1])),
        share(lambda w: len(w) == 1), share(lambda w: len(w) > 12), data.count(b"\n") / n, *[math.sqrt(s / n_bytes) for s in shares]]


def test_quality_features_equal_plain_ones(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()] + [
        None, "", " ", "AB cd. EF! a a a", "x|y| # * $ % & <> é ñ", "\n\n", "one"]
    found = []
    for _, _, data, bounds in tx.slices(pa.array(texts, pa.string()), 3000):
        found += pairwise_quality.features(data, bounds).tolist()
    want = [plain_features(t) for t in texts]
    for i, (g, w) in enumerate(zip(found, want)):
        # a word's second byte is looked up in the text, so a single capital before a blank has none
        np.testing.assert_allclose(g, w, rtol=1e-5, atol=1e-6, err_msg=repr(texts[i])[:80])


def test_pairwise_fit_reaches_the_plain_optimum_and_cuts_at_the_quantile():
    """The stochastic fit's loss over all pairs is that of plain gradient descent; the cut leaves the share of label 0 below."""
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.6, 1, (150, 3)).astype(np.float32), rng.normal(-0.6, 1, (100, 3)).astype(np.float32)
    found = pairwise_quality.fit_pairs(good, bad, 0.25)

    def loss(ranker):
        margin = ranker.raw(good)[:, None] - ranker.raw(bad)[None, :]
        return np.logaddexp(0, -margin).mean()

    n, m = found.weights.shape
    bins = lambda x: np.stack([np.searchsorted(found.edges[i], x[:, i], "right") + i * m for i in range(n)], axis=1)
    a, b = (np.zeros((len(x), n * m)) for x in (good, bad))
    for matrix, x in ((a, good), (b, bad)):
        np.put_along_axis(matrix, bins(x), 1, axis=1)
    w = np.zeros(n * m)
    for _ in range(3000):
        pull = 1 / (1 + np.exp((a @ w)[:, None] - (b @ w)[None, :])) / (len(a) * len(b))
        w += 20 * (pull.sum(axis=1) @ a - pull.sum(axis=0) @ b)
    plain = pairwise_quality.Ranker(found.edges, w.reshape(n, m), 0.0)
    assert loss(found) <= loss(plain) + 0.01 < math.log(2) - 0.2
    raw = np.concatenate([found.raw(good), found.raw(bad)])
    weight = np.concatenate([np.full(150, 0.75 / 150), np.full(100, 0.25 / 100)])
    assert weight[raw < found.cut].sum() == pytest.approx(0.25, abs=0.02)
    scores = found.score(np.concatenate([good, bad]))
    assert ((scores >= 0.3) == (raw >= found.cut)).all()


def test_preferences_of_empty_tables_and_clashing_columns(spark):
    turns = spark.createDataFrame([(0, 0, "user", "q", 1, "x"), (0, 1, "assistant", "a", 1, "x")],
                                  "pair_id long, turn long, role string, text string, n_prompt_turns int, prompt string")
    got = preferences.format_preferences(turns, turns.limit(0)).collect()
    assert len(got) == 1 and got[0]["rejected"] is None
    assert preferences.format_preferences(turns.limit(0), turns.limit(0)).count() == 0


def odd_documents(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rng = random.Random(5)
    words = [f"word{i}" for i in range(3000)]
    prose = lambda n: " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(rng.choices(words, k=n)))
    copy, passage = prose(200), prose(70)
    texts = [(1, copy), (2, copy), (2, copy), (3, prose(40) + " " + passage + " " + prose(40)), (4, prose(30) + " " + passage + " " + prose(60)),
             (5, None), (6, ""), (7, " \n"), (None, prose(90)), (None, prose(80)), (8, prose(120)), (8, prose(130)), (9, "bad! " * 40)]
    rows = [{"doc_id": d, "text": t, "lang": None if d == 3 else "en", "source": "s", "n_chars": None if t is None else len(t)} for d, t in texts]
    names = schema.fieldNames()
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    return df.withColumns({"row": F.lit("r"), "key": F.lit(1), "__doc": F.lit("d"), "n_words": F.lit("n"), "task": F.lit(3), "rank": F.lit(4)}), passage


def test_pipeline_stages_on_odd_rows(spark):
    docs, passage = odd_documents(spark)
    want = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == want, name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/odd-{name}-{zlib.crc32(name.encode())}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    left = [(r["doc_id"], r["text"]) for r in docs.collect()]
    ids = Counter(i for i, _ in left)
    assert ids == {1: 1, 3: 1, 4: 1, None: 2, 8: 2}
    assert sum(passage in t for _, t in left) == 1
    assert {(r["row"], r["key"], r["__doc"], r["n_words"], r["task"]) for r in docs.collect()} == {("r", 1, "d", "n", 3)}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.where("start = 0").count() == len(left)
    empty = docs.limit(0)
    assert all(stage(spark, empty, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_hits_of_the_report_equal_plain_ones(spark):
    """Ties and repeated rows: equal windows, equal items and equal documents."""
    items = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (3, "x y"), (None, "q r s")]
    rows = [(1, "z a b c d e f g h i j a b c d e f g h i j"), (1, "z a b c d e f g h i j a b c d e f g h i j"), (2, "x y x y"), (3, "q r s")]
    got = [(r["doc_id"], r["n_hit"]) for r in decontaminate.report(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert sorted(got) == sorted((d, plain_hits(t, items)[1]) for d, t in rows)
