"""The pipeline against plain Python, stage by stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickshop.llm import quality

from . import brute
from .test_queries import given, ordered


def stage(spark, docs, sf_dir: str, name: str):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)


@pytest.fixture(params=["small", "tricky"])
def tables(request) -> str:
    return request.getfixturevalue(request.param)


def pairs(df) -> list[tuple]:
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(spark, tables, empty):
    for sf_dir in (tables, empty):
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, _ in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir, name)
            assert out.schema.simpleString() == docs.schema.simpleString()
            out.write.format("noop").mode("overwrite").save()


def test_quality_stage(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    judged = quality.judge(docs.select("doc_id", "text"))
    expected = pairs(judged.filter("quality.kept"))
    assert ordered(pairs(stage(spark, docs, tables, "quality rules"))) == ordered(expected)
    assert 0 < len(expected) < docs.count()


def test_near_duplicate_stage_keeps_one_of_each_group(spark, tables):
    docs = given(tables, "documents", "doc_id", "text")
    group = brute.components([brute.fingerprint(t) for _, t in docs])
    expected = [
        min((d is None, d or 0) for (d, _), own in zip(docs, group) if own == g)
        for g in set(group)
    ]
    kept = pairs(stage(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables, "SimHash near-duplicates"))
    assert sorted((d is None, d or 0) for d, _ in kept) == sorted(expected)


def test_decontamination_stage(spark, tables):
    docs = given(tables, "documents", "doc_id", "text")
    judged = brute.decontamination(docs, given(tables, "benchmark", "item_id", "text"))
    expected = [d for d, row in zip(docs, judged) if not row[-1]]
    kept = stage(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables, "benchmark decontamination")
    assert ordered(pairs(kept)) == ordered(expected)


def test_secret_stage_leaves_no_base_secret(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = stage(spark, docs, tables, "secret scan")
    before = given(tables, "documents", "doc_id", "text")
    for (_, old), (_, new) in zip(sorted(before, key=repr), sorted(pairs(out), key=repr)):
        assert not any(k != "assign" for k, _, _ in brute.base_spans(new))
    nested = {24, 25}  # secrets in a compressed and in an escaped run
    clean = [(d, t) for d, t in before if d not in nested and not brute.base_spans(t)]
    assert set(clean) <= set(pairs(out))
    wrong = out.filter(F.col("n_chars") != F.length("text"))
    assert wrong.count() == docs.filter(F.col("n_chars") != F.length("text")).count()


def test_run_is_the_stages_one_after_another(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, _ in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small, name)
    expected = [(d, brute.MULTI.encode_ordinary(t)) for d, t in pairs(docs)]
    rows = corpus_pipeline.run(spark, small).collect()
    assert ordered((r.doc_id, r.ids) for r in rows) == ordered(expected)
