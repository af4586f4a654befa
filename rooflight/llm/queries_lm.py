"""Query op6; the model's score has no SQL, all else is tested against brute force."""

from __future__ import annotations

from rooflight.llm import lm_scoring
from rooflight.llm.shared import documents


def op6_lm_scoring(spark, sf_dir):
    return lm_scoring.score_documents(documents(spark, sf_dir))


QUERIES = {"op6_lm_scoring": op6_lm_scoring}
SQL: dict = {}
