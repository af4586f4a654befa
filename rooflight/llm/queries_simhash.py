"""Query op7; it has no SQL, it is tested against brute force."""

from __future__ import annotations

from rooflight.llm import simhash
from rooflight.llm.shared import documents


def op7_simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


QUERIES = {"op7_simhash_dedup": op7_simhash_dedup}
SQL: dict = {}
