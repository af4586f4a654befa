"""Query op3; it has no SQL, its accuracy on held-out documents is tested."""

from __future__ import annotations

from rooflight.llm import language_id
from rooflight.llm.shared import documents


def op3_language_id(spark, sf_dir):
    return language_id.identify(documents(spark, sf_dir))


QUERIES = {"op3_language_id": op3_language_id}
SQL: dict = {}
