"""Words, quality rules, sharding and preference pairs against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from orbitlens.llm import bitmap, preferences, quality_rules, registry, sharding
from orbitlens.llm import textops as tx

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " \t\n", "one", "One two\x0bthree\x0cfour\rfive\nsix", "é É ñ x  y ", "a b c d e a b c d e", "x " * 40,
         "a\x00b c", "　wide word here", "line one\nline one\n\nline two\nline one", "emoji 😀 here"]


def some_docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "other", "n") for i, t in enumerate(texts)], "doc_id long, text string, size string, kept string")


def test_words_match_python():
    column = pa.array(TEXTS, pa.string())
    lo = 0
    for lo, hi, data, bounds in tx.slices(column, 16):
        w = tx.find_words(data, bounds, lower=True)
        for d in range(hi - lo):
            want = (TEXTS[lo + d] or "").encode().lower().split()
            got = [w.data[s:e].tobytes() for s, e in zip(w.starts[w.first[d]:w.first[d + 1]], w.ends[w.first[d]:w.first[d + 1]])]
            assert got == want
        alnum = tx.find_words(data, bounds, alnum=True)
        for d in range(hi - lo):
            want = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (TEXTS[lo + d] or "").encode().lower())
            a, b = alnum.first[d], alnum.first[d + 1]
            assert [alnum.data[s:e].tobytes() for s, e in zip(alnum.starts[a:b], alnum.ends[a:b])] == want


def test_word_hashes_follow_words():
    words = [bytes(random.Random(i).choices(b"abcxyz", k=1 + i % 7)) for i in range(3000)]
    column = pa.array([b" ".join(words).decode()])
    (_, _, data, bounds), = tx.slices(column)
    h = tx.find_words(data, bounds).hashes()
    assert len(set(h.tolist())) == len(set(words))
    assert len(set(zip(words, h.tolist()))) == len(set(words))


def test_bitmap_never_misses(spark):
    values = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 2000)
    assert [bitmap.size_for(n) for n in (0, 10, 1 << 17, 10**9)] == [20, 20, 21, 29]
    words = bitmap.build(spark.createDataFrame([(int(v),) for v in values], "h long"), "h").value
    assert len(words) == 1 << 14
    assert bitmap.contains(words, values.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 2000).view(np.uint64)
    assert bitmap.contains(words, others).sum() < 5


def repeated(words, k=5):
    grams = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
    n = Counter(grams)
    return len({p for i, g in enumerate(grams) if n[g] > 1 for p in range(i, i + k)})


def test_repeated_words(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(60)]
    df = some_docs(spark, texts).withColumn("words", quality_rules.words_of(F.col("text")))
    df = df.withColumn("h", quality_rules.window_hashes(F.col("words"), 5))
    got = df.select("doc_id", quality_rules.repeated_words(F.col("words"), F.col("h"), 5).alias("n")).collect()
    for r in got:
        assert r["n"] == repeated((texts[r["doc_id"]] or "").encode().split()), texts[r["doc_id"]]


def test_cascade_order_does_not_change_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    f = quality_rules.Features(F.col("text"))
    rules = list(quality_rules.STANDARD)
    plain = {r["doc_id"]: r["k"] for r in docs.select("doc_id", quality_rules.first_rejection(rules, f).isNull().alias("k")).collect()}
    ordered = quality_rules.order_rules(docs, rules)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    judged = quality_rules.judge(docs.withColumn("kept", F.lit("clash")))
    assert {r["doc_id"]: r["kept"] for r in judged.collect()} == plain
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.keep_good(docs).count() == sum(plain.values())


def test_cascade_edge_cases(spark):
    out = {r["doc_id"]: r for r in quality_rules.judge(some_docs(spark)).collect()}
    assert [out[i]["rejected_by"] is None for i in range(4)] == [False] * 4
    assert quality_rules.judge(some_docs(spark).limit(0)).count() == 0


def test_clean_prose_is_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    kept = {r["quality"]: r["share"] for r in quality_rules.judge(docs).groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.9 and kept[0] < 0.2


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_sharding(spark, shards):
    docs = some_docs(spark, TEXTS + [None, "same", "same"]).union(some_docs(spark, ["same"] * 20)).repartition(3)
    out = sharding.shuffle_into_shards(docs, shards).collect()
    assert len(out) == docs.count()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["size"] == 16 + len((r["text"] or "").encode())
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.shuffle_into_shards(docs.limit(0), shards).count() == 0


def plain_shards(rows, shards, seed, buckets, hashes):
    """The law of the shards in plain Python: hashes gives (key, other, {copy: bucket hash}, {(bucket, step): draw hash})."""
    by = {}
    copies = Counter(rows)
    for row, n in copies.items():
        key, other = hashes["row"][row]
        for c in range(n):
            copy = c + 1 if n > sharding.HOT else 0
            by.setdefault(hashes["bucket"][key, copy] % buckets, []).append((key, other, copy, c, row))
    order = []
    for bucket in sorted(by):
        members = sorted(by[bucket])
        places = [0]
        for i in range(1, len(members)):
            j = hashes["draw"][bucket, i] % (i + 1)
            places.append(i)
            places[j], places[i] = (i, places[j]) if j < i else (places[j], i)
        laid = [None] * len(members)
        for member, place in zip(members, places):
            laid[place] = member[-1]
        order += laid
    n, out = len(order), Counter()
    for at, row in enumerate(order):
        shard = at * shards // n
        out[row, shard, at - (shard * n + shards - 1) // shards] += 1
    return out


@pytest.mark.parametrize("shards", [3, 40])
def test_shards_equal_a_plain_shuffle_under_every_layout(spark, shards):
    seed, schema = 17, "doc_id long, text string"
    rows = [(i % 700, f"text {i % 700}") for i in range(900)] + [(None, None)] * 2 + [(5000, "hot")] * 400
    docs = spark.createDataFrame(rows, schema)
    buckets, distinct = sharding.MIN_BUCKETS, list(dict.fromkeys(rows))
    hashed = spark.createDataFrame([(i, *r) for i, r in enumerate(distinct)], f"i long, {schema}").select(
        "i", F.xxhash64(F.lit(seed), F.struct("doc_id", "text")).alias("k"), F.xxhash64(F.struct("doc_id", "text"), F.lit(seed)).alias("o")).collect()
    row = {distinct[r["i"]]: (r["k"], r["o"]) for r in hashed}
    keys = spark.createDataFrame([(k, c) for k, _ in row.values() for c in (range(401) if k == row[5000, "hot"][0] else (0,))], "k long, c long")
    bucket = {(r["k"], r["c"]): r["h"] for r in keys.select("k", "c", F.when(F.col("c") > 0, F.xxhash64(F.lit(seed + 1), "k", "c")).otherwise(
        F.xxhash64(F.lit(seed + 1), "k")).alias("h")).collect()}
    steps = spark.range(buckets).select(F.col("id").alias("b"), F.explode(F.sequence(F.lit(1), F.lit(200))).alias("s"))
    draws = {(r["b"], r["s"]): r["h"] for r in steps.select("b", "s", F.xxhash64(F.lit(seed + 2), "b", "s").alias("h")).collect()}
    want = plain_shards(rows, shards, seed, buckets, {"row": row, "bucket": bucket, "draw": draws})
    for parts in (1, 5):
        got = sharding.shuffle_into_shards(docs.repartition(parts), shards, seed).collect()
        assert Counter(((r["doc_id"], r["text"]), r["shard"], r["slot"]) for r in got) == want


def test_shards_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a", "x", 2, "k")], "doc_id long, text string, size string, `at` long, `key` string")
    got = sharding.shuffle_into_shards(docs, 2).first()
    assert (got["at"], got["key"], got["size"]) == (2, "k", 17)


def test_sharding_mixes_and_writes(spark, tmp_path):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    out = sharding.shuffle_into_shards(docs, 4)
    rows = out.orderBy("shard", "slot").toPandas().doc_id.to_numpy()
    assert abs(np.corrcoef(rows, np.arange(4000))[0, 1]) < 0.1
    sharding.write_shards(out, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4000 and back.select("shard").distinct().count() == 4


def plain_pairs(turns):
    sides = {}
    for conv, turn, role, text in sorted(set(turns), key=lambda t: (t[0] is None, t[0], t[1] is not None, t[1] or 0, t[2] or "none", t[3] or "")):
        if conv is not None:
            sides.setdefault(conv // 2, ([], []))[conv % 2].append((role or "none", text or ""))
    out = {}
    for pair, (a, b) in sides.items():
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        show = lambda ts: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in ts)
        out[pair] = (n, show(a[:n]), show(a[n:]) if a else None, show(b[n:]) if b else None)
    return out


def test_preferences(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "good"), (1, 0, "user", "hi"), (1, 1, "assistant", "bad"),
             (1, 1, "assistant", "bad"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b"),
             (4, 0, None, None), (6, 1, "user", "t2"), (6, 1, "user", "t1"), (7, None, "user", "t1"), (7, 5, "user", "x"),
             (9, 0, "user", "only rejected"), (None, 0, "user", "nobody")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df = df.withColumn("pair_id", F.expr("conv_id div 2"))
    even = F.pmod("conv_id", F.lit(2)) == 0
    got = preferences.format_preferences(df.where(even), df.where(~even)).collect()
    want = plain_pairs(turns)
    assert {r["pair_id"]: (r["n_prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) for r in got} == want
    for r in got:
        for side in ("chosen", "rejected"):
            for s in r[f"{side}_spans"] or []:
                piece = r[side][s["start"]:s["end"]]
                assert piece.endswith("<|end|>\n") and r[side][:s["start"]].endswith("<|assistant|>\n")
    first = next(r for r in got if r["pair_id"] == 0)
    assert [first["chosen"][s["start"]:s["end"]] for s in first["chosen_spans"]] == ["good<|end|>\n"]


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_equals_sql(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert difference(got, connect(SF).execute(registry.ORACLES[name]).df()) == ""
