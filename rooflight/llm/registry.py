"""All queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from rooflight.llm import (
    queries_dedup,
    queries_language,
    queries_license,
    queries_lm,
    queries_mixing,
    queries_pieces,
    queries_quality,
    queries_search,
    queries_simhash,
    queries_url,
)

_MODULES = [queries_search, queries_mixing, queries_language, queries_url, queries_quality, queries_lm, queries_simhash, queries_license, queries_pieces, queries_dedup]


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in _MODULES for k, s in m.SQL.items()}
