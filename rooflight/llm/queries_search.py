"""Query op1 and its SQL."""

from __future__ import annotations

from rooflight.llm import topk_search


def op1_exact_topk(spark, sf_dir):
    vectors = topk_search.quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return topk_search.search(vectors, vectors.where("vec_id % 50 = 0"), 5)


QUERIES = {"op1_exact_topk": op1_exact_topk}
SQL = {
    "op1_exact_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
