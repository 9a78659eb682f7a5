"""Registered queries of the manifest, the whitening and the personal-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.llm import merkle, personal_data, whitening
from orbitlens.llm.queries_native import table

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, checked against texts whose letters have been lower-cased in a third of them."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    lowered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf(lowered))
    return merkle.prove(merkle.build(docs, FIELDS, carried={"tampered": tampered}), "tampered")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per vector and component."""
    rows, model = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    error = whitening.identity_error(rows)
    shares = (model.values[:whitening.COMPONENTS] / model.trace).tolist() if model else [0.0]
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.rows if model else 0).cast("bigint").alias("n"),
        "deviation", "whitened", F.get(F.lit(shares), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are those of the base patterns; spans are theirs and those the trees add."""
    found = personal_data.find(table(spark, sf_dir, "documents").select("doc_id", "text"), kept=["doc_id"])

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(kind).alias(f"n_{name}") for kind, name in enumerate(personal_data.KINDS)]
    return found.select("doc_id", *counts, F.sha2(personal_data.listed("base"), 256).alias("base_sha256"),
                        personal_data.listed("spans").alias("spans"))


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


def _levels(name: str, first: str, levels: int) -> str:
    """Nodes (tree, i, h) of ``levels`` levels over those of ``first``, with their siblings and their tree's width."""
    out = []
    for k in range(levels):
        source = first if k == 0 else f"{name}{k - 1}"
        nodes = source if k == 0 else f"""(SELECT tree, CASE WHEN w > 1 THEN i // 8 ELSE i END AS i,
            CASE WHEN any_value(w) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
          FROM {source} GROUP BY tree, CASE WHEN w > 1 THEN i // 8 ELSE i END)"""
        run = "PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
        out.append(f"""
  {name}{k} AS (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS w,
      coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {nodes})""")
    return ",".join(out)


def _climb(start: str, name: str, levels: int, tree: str, at: str, out: str) -> str:
    """``proof`` and ``node`` of the rows of ``start`` carried up the levels of their tree."""
    steps = []
    for k in range(levels):
        source = start if k == 0 else f"{out}{k - 1}"
        steps.append(f"""
  {out}{k} AS (SELECT s.* REPLACE (CASE WHEN n.w > 1 THEN s.proof || n.l || n.r ELSE s.proof END AS proof,
      CASE WHEN n.w > 1 THEN sha256(n.l || s.node || n.r) ELSE s.node END AS node,
      CASE WHEN n.w > 1 THEN s.{at} // 8 ELSE s.{at} END AS {at})
    FROM {source} s JOIN {name}{k} n ON n.tree = s.{tree} AND n.i = s.{at})""")
    return ",".join(steps)


#: levels that the SQL twin goes through: 8 ** 8 leaves a tree and 8 ** 4 trees at most
TREE_LEVELS, TOP_LEVELS = 9, 5
LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"
CRC_STEP = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
CRC = (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
       f"lambda a, b: list_reduce(list_prepend(xor(a, b), range(0, 8)), lambda x, i: {CRC_STEP})), 4294967295)")

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
    sha256({" || ".join(_field(c) for c in FIELDS)}) AS leaf,
    CASE WHEN {CRC} % 3 = 0 THEN sha256({" || ".join(_field(c) for c in FIELDS[:-1])} || {_field(LOWERED)}) END AS bad FROM documents),
  placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
  leaves AS (SELECT tree, i, leaf AS h FROM placed), {_levels('n', 'leaves', TREE_LEVELS)},
  subs AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM n{TREE_LEVELS - 1}),
  tops AS (SELECT '' AS tree, place AS i, subroot AS h FROM subs), {_levels('t', 'tops', TOP_LEVELS)},
  start AS (SELECT p.*, '' AS proof, coalesce(bad, leaf) AS node, '' AS top, s.subroot, s.place FROM placed p JOIN subs s USING (tree)),
  {_climb('start', 'n', TREE_LEVELS, 'tree', 'i', 'c')}, {_climb(f'c{TREE_LEVELS - 1}', 't', TOP_LEVELS, 'top', 'place', 'u')}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.h AS verified
FROM u{TOP_LEVELS - 1}, t{TOP_LEVELS - 1} r"""

QUERIES = {"op11_whitening": op11_whitening, "op12_personal_data": op12_personal_data, "op13_merkle": op13_merkle}
ORACLES = {"op13_merkle": OP13_SQL}
