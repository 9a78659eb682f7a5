"""All registered queries of this subpackage and their SQL."""

from __future__ import annotations

from orbitlens.llm import queries_docs, queries_models, queries_native, queries_sets

QUERIES = {**queries_native.QUERIES, **queries_docs.QUERIES, **queries_models.QUERIES, **queries_sets.QUERIES}
ORACLES = {**queries_native.ORACLES, **queries_docs.ORACLES, **queries_sets.ORACLES}
