"""Registered queries of the solar operators, and their SQL."""

from __future__ import annotations

from rooflight.plans import planes, scalars, surfaces, tiles, village

_MODULES = [planes, scalars, surfaces, tiles, village]
QUERIES: dict = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
SQL: dict = {k: s for m in _MODULES for k, s in m.SQL.items()}
FLAGSHIP = "areal_weighted_mean"
