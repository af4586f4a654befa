"""Query op5; it has no SQL, its accuracy on held-out documents is tested."""

from __future__ import annotations

from rooflight.llm import quality
from rooflight.llm.shared import documents


def op5_quality_classifier(spark, sf_dir):
    return quality.rate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op5_quality_classifier": op5_quality_classifier}
SQL: dict = {}
