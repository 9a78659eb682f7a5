"""The manifest against a plain one, with nulls, repeated rows and ids, and single leaves."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from orbitlens.llm import merkle, registry

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_leaf(row):
    out = ""
    for v in row:
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(out)


def climb(level):
    """All levels up to a single node."""
    levels = [level]
    while len(level) > 1:
        level = [h(*level[i:i + 8]) for i in range(0, len(level), 8)]
        levels.append(level)
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 8 * 8:i // 8 * 8 + 8]
        out.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        i //= 8
    return out


def plain(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    langs = sorted(trees, key=lambda x: b"" if x is None else b"=" + x.encode())
    built, low = {}, -2**70
    for lang in langs:
        trees[lang].sort(key=lambda r: (low if r[0] is None else r[0], plain_leaf(r)))
        built[lang] = climb([plain_leaf(r) for r in trees[lang]])
    top = climb([built[x][-1][0] for x in langs])
    root = top[-1][0]
    out = []
    for j, lang in enumerate(langs):
        for i, row in enumerate(trees[lang]):
            path = siblings(built[lang], i) + siblings(top, j)
            own = plain_leaf(row)
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = plain_leaf((*row[:4], lower(row[4]))) if bad else own
            for a, b in path:
                node = h(a, node, b)
            out.append((row[0], own, built[lang][-1][0], root, h(*[a + b for a, b in path]), node, node == root))
    return sorted(out, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "leaf": F.lit("x"), "index": F.lit(2)})
    lowered = [F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if c == "text" else F.col(c) for c in FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf(lowered))
    done = merkle.prove(merkle.build(docs, FIELDS, carried={"tampered": tampered}), "tampered")
    assert done.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in done.collect()], key=repr)


def test_manifest_of_odd_rows(spark):
    rows = [(i * 7919 % 5000 - 900, "s", "en", i, f"Text {i} Ünï") for i in range(300)]
    rows += [(None, None, None, None, None), (None, "s", "en", 1, ""), (5, "s", "de", 3, "Abc"), (5, "s", "de", 3, "Abc"),
             (5, "t", "de", 3, "abc"), (2**62, "s", "", 1, "Big"), (-2**63, "s", "", 1, "Small"), (2**63 - 1, "s", "", 1, "x" * 70000)]
    rows += [(7, "s", "en", 1, "Same")] * 30 + [(j, "s", "\U0001f600", 1, "T") for j in range(64)]
    assert found(spark, rows) == plain(rows)


def test_manifest_of_one_row_and_none(spark):
    assert found(spark, [(1, "a", "en", 3, "Abc")]) == plain([(1, "a", "en", 3, "Abc")])
    assert found(spark, []) == []


def test_manifest_of_many_trees_and_two_rounds(spark):
    rows = [(i * i % 100003, "s", f"l{i % 3}" if i % 5 == 0 else "big", i, f"Row {i}") for i in range(6000)]
    assert 4096 < sum(r[2] == "big" for r in rows)
    rows += [(i, "s", f"g{i:04d}", 1, "T") for i in range(200)]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_plain(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select(*FIELDS)
    want = plain([tuple(r) for r in docs.collect()])
    got = registry.QUERIES["op13_merkle"](spark, f"/root/testdata/{sf}").collect()
    assert sorted([tuple(r) for r in got], key=repr) == want
