"""The pipeline's stages, one by one on their own input, with awkward rows and names; and the whole run."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import pytest
from rooflight.llm import piece_lattice, quality, shared

#: Names that the stages use or used themselves.
NAMES = "row quality_score simhash_print near_set near_size near_bands prints fp node component mix_p mix_times mix_copies mix_copy mix_before mix_at mix_h mix_i mix_words copies times pattern size p cut_hash cut_id h i n hot_key digest best_uid neg_len own_id stay_id doc label ids".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in NAMES)


def rows():
    texts = [None, "", " \n", "one two  three", "one two three", "ONE two three", "plain text " * 40, "plain text " * 40 + "x", "a" * 5000, "tab\tand\r\nline", "ünï ▁ 日本語" * 50]
    base = [(i, t, "en", "ab"[i % 2] if i % 3 else None, 1) for i, t in enumerate(texts)]
    base += [base[3], base[6], (None, "no id at all", None, None, None), (None, "another without id", None, "a", None), (4, "an id that comes twice", "en", "b", 3)]
    return [(*r, *range(5, 5 + len(NAMES))) for r in base]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(40)] + [(3, 1, 0), (None, 1, 0), (5, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage(spark, tables, name, stage):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    given = docs.collect()
    out = stage(spark, docs, tables)
    got = out.collect()
    if name != "encoding":
        assert out.columns == docs.columns and set(got) <= set(given)
        assert all(tuple(r)[5:] == tuple(range(5, 5 + len(NAMES))) for r in got)  # values of all columns stay
    if name == "quality":
        model = quality.train(docs, spark.read.parquet(f"{tables}/labels.parquet"))
        want = [r for r in given if model.score(model.margin(quality.features(r.text))) >= quality.THRESHOLD]
        assert Counter(got) == Counter(want)
    elif name == "exact_dedup":
        assert sorted(squeezed(r.text) for r in got) == sorted({squeezed(r.text) for r in given})
    elif name == "near_dedup":
        kept = [" ".join((r.text or "").lower().split()) for r in got]
        assert sorted(kept) == sorted({" ".join((r.text or "").lower().split()) for r in given})
    elif name == "mixing":
        assert len(got) == len(stage(spark, docs, tables).collect()) and all(n <= 3 * Counter(given)[r] for r, n in Counter(got).items())
    else:
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in given) and all(r.round_trip for r in got)
        back = piece_lattice.decode_documents(out).collect()
        assert Counter((r.doc_id, r.text) for r in back) == Counter((r.doc_id, r.text or "") for r in given)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_nothing(spark, tables, name, stage):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("false")
    assert stage(spark, docs, tables).count() == 0


def test_run(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert Counter(map(str, out.collect())) == Counter(map(str, docs.collect()))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_driver_gives_native_memory_back(spark, monkeypatch):
    """After each written table."""
    said, trim = [], shared.trim_native
    monkeypatch.setattr(shared, "trim_native", lambda s: said.append(trim(s)))
    assert shared.written(spark.range(5), "five").count() == 5
    assert len(said) == 1 and (said[0] is None or "native heap" in said[0])
