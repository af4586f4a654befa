"""Query op9; it has no SQL, it is tested by round trip and against a plain Viterbi search."""

from __future__ import annotations

from rooflight.llm import piece_lattice
from rooflight.llm.shared import documents


def op9_sentencepiece(spark, sf_dir):
    return piece_lattice.encode_documents(documents(spark, sf_dir))


QUERIES = {"op9_sentencepiece": op9_sentencepiece}
SQL: dict = {}
