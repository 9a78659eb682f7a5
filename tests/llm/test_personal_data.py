"""Base spans against Python's re, candidates and selection against plain versions, and planted data."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from orbitlens.llm import personal_data as pii
from orbitlens.llm import registry

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, value):
    number = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")),
            "card": 12 <= len(number) <= 19 and luhn(number), "phone": 9 <= len(number) <= 15}[kind]


def plain_base(text):
    found = [(m.start(), k, m.end()) for k, (name, p) in enumerate(PLAIN.items())
             for m in re.finditer(p, text or "") if passes(name, m.group())]
    return sorted(found)


def base_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = docs.select("id", pii.base_spans(F.col("text")).alias("b")).orderBy("id").collect()
    return [[tuple(s) for s in r["b"]] for r in rows]


ODD = [
    None, "", "no data", "a@b.c_x@y.z", "a@b@c.d e@f", "x@y.z.@q.r", "..@-.-", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.001 1.2.3.4",
    "9999999999999999999999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "+1 (743) 555-3824.",
    "+1+2 345 678 901", "+12", "+1 2", "+1          234567890", "+(1) 234 567 890", "0" * 12, "é@ü.de ü+1 234 567 8901", "😀 a@b.cd 😀 1.2.3.4",
    "+123456789012345 +1234567890123456", "12.34.56.78-1234 5678 9012", "1-1-1-1-1-1-1-1-1-1-1-1-1-1", "\n+1\n234567890\n", "a@b.c d@e.f",
]


def test_base_spans_of_odd_texts(spark):
    for text, got in zip(ODD, base_of(spark, ODD)):
        assert got == plain_base(text), text


def test_base_spans_of_random_texts(spark):
    rng = random.Random(5)
    alphabet = "0123456789" * 3 + "..@@  +--()\nab_%é😀/"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(5, 400))) for _ in range(400)]
    assert base_of(spark, texts) == [plain_base(t) for t in texts]


def test_base_spans_of_very_long_texts(spark):
    texts = ["a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "a@" + "b." * 500_000 + "c", "+1" + " " * 1_000_000, "+" * 1_000_000,
             "1 " * 300_000 + "4111111111111111", ("x" * 40 + " 1.2.3.4 ") * 5000]
    got = base_of(spark, texts)
    assert [len(g) for g in got[:2]] == [0, 0] and got[3] == [(0, 0, 1_000_003)]
    assert got[2] == [(8 * i, 1, 8 * i + 7) for i in range(125_000)] and got[4:6] == [[], []]
    assert got[7] == [(i * 49 + 41, 1, i * 49 + 48) for i in range(5000)]


def test_sums_before(spark):
    rng = random.Random(1)
    rows = [[rng.randrange(9) for _ in range(n)] for n in (0, 1, 2, 3, 4, 5, 10, 99, 100, 1001)]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<int>").select(
        "i", pii.sums_before(F.col("v")).alias("s")).orderBy("i").collect()
    assert [r["s"] for r in got] == [[sum(r[:i]) for i in range(len(r))] for r in rows]


def corpus():
    """Texts whose base spans teach contexts, negatives, and planted spans that only the trees can find."""
    rng = random.Random(3)
    words = "the of and river stone light under many come value order late".split()
    prose = lambda n: " ".join(rng.choices(words, k=n))
    rows, planted = [], {}

    def add(middle, kind=None, span=None):
        head = prose(rng.randrange(3, 20)) + " "
        text = head + middle + " " + prose(5)
        if kind is not None:
            at = text.index(span)
            planted[len(rows)] = (at, kind, at + len(span))
        rows.append((len(rows), text))

    phone = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    for i in range(300):
        add(f"call +1 {phone()}")
        add(f"mail bo.{rng.choice(words)}@host{i}.example.com")
        add(f"look at {rng.choice(words)}")
        add(f"on 2024-{rng.randrange(1, 12):02d}-{rng.randrange(1, 28):02d} of {rng.randrange(1000000, 9999999)}")
        add(f"{rng.randrange(10**7, 10**8)}")
    for i in range(30):
        span = f"bo.{rng.choice(words)} (at) host{i} (dot) com"
        add("mail " + span, 0, span)
        add(prose(30))
    return rows, planted


def test_trees_find_planted_spans_and_leave_the_rest(spark):
    rows, planted = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert len(found) == len(rows)
    added = {i: [tuple(s) for s in r["spans"] if s not in r["base"]] for i, r in found.items()}
    assert all([tuple(s) for s in r["base"]] == plain_base(r["text"]) for r in found.values())
    caught = sum(planted[i] in added[i] for i in planted)
    assert caught >= 0.9 * len(planted)
    assert sum(bool(x) for i, x in added.items() if i not in planted) <= 0.02 * len(rows)


def test_rows_are_kept_whatever_their_columns(spark):
    docs = spark.createDataFrame([(1, "a@b.cd", "x", "row"), (1, "a@b.cd", "x", "row"), (None, None, None, None)],
                                 "doc_id long, text string, spans string, held_out string")
    got = pii.find(docs)
    assert got.columns == ["doc_id", "text", "held_out", "base", "spans"]
    rows = got.collect()
    assert len(rows) == 3 and [len(r["spans"]) for r in rows if r["doc_id"]] == [1, 1]
    assert pii.find(docs.limit(0)).count() == 0


def test_redacted_texts(spark):
    docs = spark.createDataFrame([(1, "é a@b.cd and 1.2.3.4!"), (2, "+1 234 567 8901 2345"), (3, None), (4, "none")], "doc_id long, text string")
    got = {r["doc_id"]: r["redacted"] for r in pii.redact(pii.find(docs)).collect()}
    assert got[1] == "é [EMAIL] and [IP]!" and got[3] is None and got[4] == "none"
    assert got[2] in ("[PHONE]", "+[CARD]")


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query_counts_and_digests(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    for r in registry.QUERIES["op12_personal_data"](spark, f"/root/testdata/{sf}").collect():
        base = plain_base(docs[r["doc_id"]])
        names = list(PLAIN)
        listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{n}"] for n in names] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))
