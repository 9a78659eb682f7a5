"""Near duplicates, decontamination and passage removal against brute force."""

import hashlib
import random
import re

import pytest

from orbitlens.llm import decontaminate, large_groups, near_dups, passages
from orbitlens.llm.components import connected


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def plain_components(rows, k, percent):
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = [shingles(t, k) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sets, [least[find(i)] for i in range(len(rows))]


def family(rng, n_copies, length=120, edits=8):
    base = [f"w{rng.randint(0, 5000)}" for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(n_copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(length)] = f"e{rng.randint(0, 60)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("chunk", [4, 256])
def test_near_dups_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_dups, "CHUNK", chunk)
    monkeypatch.setattr(near_dups, "HOT_COPIES", chunk // 4)
    rng = random.Random(7)
    texts = [t for n in (30, 12, 3, 1, 1) for t in family(rng, n)]
    texts += [None, "", "  ", "a", "A", "a b", "A  b", "b a", "x y z", "X y\tz"] + [" ".join(rng.choices("ab", k=40)) for _ in range(5)]
    texts += [texts[0]] * 5 + [texts[31]] * 2
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets, want = plain_components(rows, 3, 85)
    got = {r["doc_id"]: r for r in near_dups.find_components(df, 3, 85).collect()}
    assert len(got) == len(rows)
    for (doc, text), s, c in zip(rows, sets, want):
        assert (got[doc]["n_shingles"], got[doc]["component_id"], got[doc]["kept"]) == (len(s), c, doc == c), text


def template(rng, n, own, length=120, name="t"):
    """Documents that share a template and hold ``own`` words of their own, some of them twice with an edit or two."""
    base = [f"{name}{i}" for i in range(length)]
    out = []
    for i in range(n):
        w = base[:length - own] + [f"{name}own{i}x{j}" for j in range(own)]
        out.append(" ".join(w))
        if i % 10 == 0:
            w[rng.randrange(length)] = "edit"
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("own", [8, 14, 25])
def test_templates_below_the_limit_equal_brute_force(spark, monkeypatch, own):
    """Groups of more than a chunk whose members are not linked to their hub."""
    monkeypatch.setattr(near_dups, "CHUNK", 16)
    rng = random.Random(own)
    texts = template(rng, 90, own) + template(rng, 60, own + 3, name="u") + family(rng, 20)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    sets, want = plain_components(rows, 3, 85)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.find_components(
        spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert [got[d] for d, _ in rows] == want


def test_prefixes_meet_all_linked_pairs(spark):
    """Every pair of sets at or above the limit shares a prefix shingle, and templates give few meetings."""
    rng = random.Random(2)
    sets = [sorted(rng.sample(range(40), rng.randrange(1, 40))) for _ in range(60)]
    sets += [sorted({*range(1000, 1090 + rng.randrange(3)), *(10**6 * (i + 1) + j for j in range(20))}) for i in range(60)]
    rows = [(0, i, i % 4, 4, passages.np.array(x, passages.np.uint64).tobytes(), i, i % 3 > 0) for i, x in enumerate(sets)]
    members = spark.createDataFrame(rows, "hub long, node long, chunk int, chunks int, shingles binary, part long, alone boolean")
    met = {tuple(sorted((r["a"], r["b"]))) for r in large_groups.meetings(members, 85).collect()}
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = len(set(x) & set(y))
            if 100 * both >= 85 * (len(x) + len(y) - both) and (i % 3 or j % 3):
                assert (j, i) in met
    assert not any(i >= 60 and j >= 60 for i, j in met)


def test_meetings_of_a_template_grow_with_its_documents(spark):
    rng = random.Random(6)
    met = []
    for n in (200, 400):
        sets = [{*range(250), *(10**6 * (i + 1) + j for j in range(60))} | ({10**6 * i + j for j in range(58)} if i % 10 == 0 else set()) for i in range(n)]
        rows = [(0, i, i % 4, 4, passages.np.array(sorted(x), passages.np.uint64).tobytes(), i, True) for i, x in enumerate(sets)]
        members = spark.createDataFrame(rows, "hub long, node long, chunk int, chunks int, shingles binary, part long, alone boolean")
        met.append(large_groups.meetings(members, 85).count())
    assert 0 < met[1] <= 2.5 * met[0] and met[0] < 200


def test_keep_first_cases(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(5, long, "k"), (5, long, "k"), (7, long.upper(), "k"), (None, long + " more", "k"), (1, None, "k"), (2, "", "k"), (3, "z", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, keys string")
    out = near_dups.keep_first(df)
    assert out.columns == df.columns
    kept = sorted((r["doc_id"], r["text"] or "") for r in out.collect())
    assert kept == sorted([(5, long), (1, ""), (2, ""), (3, "z")])
    assert near_dups.keep_first(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 140)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    edges += [(300, 300), (1, 0), (5, 6)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up}


def alnum(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def plain_hits(doc, items):
    w = alnum(doc)
    hit, found = set(), set()
    for item, text in items:
        v = alnum(text)
        k = min(10, len(v))
        grams = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if grams and tuple(w[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                if item is not None:
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["alpha", "Beta", "gam-ma", "délta", "x1", "of", "the"]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([25, 12, 10, 9, 4, 1, 40])]
    items += [(6, "alpha"), (None, items[1][1]), (8, None), (9, "--"), (10, " ".join(["of"] * 30))]
    docs = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(40)]
    for _, text in items[:7]:
        v = text.split()
        docs += [text, "pre " + text.upper() + " post", " ".join(v[:10]), " ".join(v[1:10] + ["zz"] + v[10:])]
    docs += [None, "", "...", "of " * 50]
    df = spark.createDataFrame([(i, d, "x") for i, d in enumerate(docs)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.report(df, bench).collect()}
    assert len(got) == len(docs)
    for i, d in enumerate(docs):
        n, hit, found = plain_hits(d, items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"], got[i]["contaminated"]) == (n, hit, found, hit > 0), d
    clean = decontaminate.keep_clean(df, bench)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i in got if not got[i]["contaminated"]}
    assert decontaminate.keep_clean(df, bench.limit(0)).count() == len(docs)
    assert decontaminate.report(df.limit(0), bench).count() == 0


def plain_removed(rows, window):
    least = {}
    for doc, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            least[g] = min(least.get(g, 1 << 63), (1 << 63) - 1 if doc is None else doc)
    out = []
    for doc, text in rows:
        w = (text or "").encode().split()
        gone = {p for i in range(len(w) - window + 1)
                if least[tuple(w[i:i + window])] < ((1 << 63) - 1 if doc is None else doc) for p in range(i, i + window)}
        out.append((doc, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return out


@pytest.mark.parametrize("anchor_windows", [1024, 2])
def test_passages_equal_brute_force(spark, monkeypatch, anchor_windows):
    monkeypatch.setattr(passages, "ANCHOR_WINDOWS", anchor_windows)
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    shared = [fresh(n) for n in (13, 14, 30, 60, 12, 200)]
    rows = []
    for i in range(60):
        w = fresh(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 5)
            w += s[a:a + rng.randint(10, 80)] + fresh(rng.randint(0, 4))
        rows.append((rng.randint(0, 50), rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(3, None), (4, ""), (None, " ".join(shared[3])), (None, " ".join(shared[5])), (60, "Ü é " * 20), (61, "Ü é " * 30),
             (62, " ".join(rng.choices("ab", k=300))), (63, " ".join(rng.choices("ab", k=300))), (64, "a " * 50), (65, "a " * 70), rows[0], rows[0]]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_words string").repartition(3)
    out = passages.remove_repeats(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_words"].encode()).hexdigest()) for r in out), key=key)
    assert got == sorted(plain_removed(rows, 13), key=key)
    for r in out:
        assert r["cut_text"].split() == r["kept_words"].split() or "　" in (r["text"] or "")
        if not r["n_removed"]:
            assert r["cut_text"] == (r["text"] or "")
    assert passages.remove_repeats(df.limit(0)).count() == 0


def test_passages_of_one_word_and_of_hot_rows(spark):
    """A text of one repeated word is one window, however long; a third of the rows share a text, and a third an id."""
    rows = [(0, "a " * 40_000), *[(i, "a " * 60 + f"x{i}") for i in range(1, 200)], *[(500 + i, "b c d e " * 9) for i in range(100)],
            *[(None, f"q{i} " * 3 + "the same passage of more than thirteen words that many rows without an id do hold " + f"r{i}") for i in range(100)]]
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], "doc_id long, text string, __doc string, `row` long, phrase string").repartition(4)
    got = passages.remove_repeats(df)
    assert got.columns == ["doc_id", "text", "__doc", "row", "phrase", "n_words", "n_removed", "kept_words", "cut_text"]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    found = sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_words"].encode()).hexdigest()) for r in got.collect()), key=key)
    assert found == sorted(plain_removed(rows, 13), key=key)


def test_anchor_of_a_window_is_its_least_phrase():
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randrange(0, 60))) for _ in range(20)]
    (_, _, data, bounds), = passages.tx.slices(passages.pa.array(texts))
    p = passages.Parsed(data, bounds, 13, 6)
    grams = dict(zip(p.gram_at.tolist(), p.grams.tolist()))
    assert p.anchor_of(p.at).tolist() == [min(grams[i + j] for j in range(8)) for i in p.at.tolist()]
    where, anchors = p.anchors()
    assert set(p.anchor_of(p.at).tolist()) == set(anchors.tolist())
