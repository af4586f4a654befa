"""Query op2; which documents the mix takes depends on the method, so it has no SQL."""

from __future__ import annotations

from rooflight.llm import mixing
from rooflight.llm.shared import documents


def op2_source_mixing(spark, sf_dir):
    return mixing.mix_report(documents(spark, sf_dir))


QUERIES = {"op2_source_mixing": op2_source_mixing}
SQL: dict = {}
