"""Query op10 and its SQL."""

from __future__ import annotations

from rooflight.llm import exact_dedup
from rooflight.llm.shared import documents


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup_report(documents(spark, sf_dir))


QUERIES = {"op10_exact_dedup": op10_exact_dedup}
SQL = {
    "op10_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS len,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept,
               text_sha256
        FROM d
        WINDOW w AS (PARTITION BY text_sha256 ORDER BY len DESC, doc_id NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
}
