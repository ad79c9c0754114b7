"""Registered queries against SQL or plain Python, on generated and on tricky tables."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from clickshop.llm import licenses, substrings
from parity import compare

from . import brute

SQL = ["op3_quality_rules", "op5_chat_format", "op10_url_filter", "op11_collocations", "op13_periodic_runs"]


def given(sf_dir: str, table: str, *columns: str) -> list[tuple]:
    rows = pq.read_table(f"{sf_dir}/{table}.parquet", columns=list(columns))
    return list(zip(*[rows.column(c).to_pylist() for c in columns]))


def ordered(rows) -> list[tuple]:
    return sorted(map(tuple, rows), key=repr)


def run(spark, sf_dir: str, name: str):
    return contract.queries()[name](spark, sf_dir)


@pytest.fixture(params=["small", "tricky"])
def tables(request) -> str:
    return request.getfixturevalue(request.param)


@pytest.mark.parametrize("name", SQL)
def test_matches_sql(spark, tables, name):
    db = compare.connect(tables)
    df = run(spark, tables, name)
    assert compare.difference(df, db, contract.oracle_sql()[name]) is None


def test_token_files(spark, tables):
    documents = given(tables, "documents", "doc_id", "text")
    rows = sorted(run(spark, tables, "op1_token_files").collect(), key=lambda r: r.start)
    expected = [(d, len(x) // 4, brute.crc(x)) for (d, _), x in zip(documents, brute.token_ids([t for _, t in documents]))]
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == ordered(expected)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert order == sorted(order)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens


def test_token_files_hold_the_ids_of_the_default_call(spark, tricky):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc, text in given(tricky, "documents", "doc_id", "text"):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        expected.append((doc, len(ids), brute.crc(ids.tobytes())))
    rows = run(spark, tricky, "op1_token_files").collect()
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == ordered(expected)


def test_decontamination(spark, tables):
    documents = given(tables, "documents", "doc_id", "text")
    expected = brute.decontamination(documents, given(tables, "benchmark", "item_id", "text"))
    assert ordered(run(spark, tables, "op2_decontamination").collect()) == ordered(expected)


def test_suffix_dedup(spark, tables):
    expected = brute.substrings(given(tables, "documents", "doc_id", "text"))
    assert ordered(run(spark, tables, "op4_suffix_dedup").collect()) == ordered(expected)


def test_suffix_dedup_over_many_chunks_with_hot_keys(spark, tables, monkeypatch):
    monkeypatch.setitem(substrings_batch(), "spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    monkeypatch.setattr(substrings, "HOT_CHUNKS", 1)
    expected = brute.substrings(given(tables, "documents", "doc_id", "text"))
    assert ordered(run(spark, tables, "op4_suffix_dedup").collect()) == ordered(expected)


def substrings_batch() -> dict[str, str]:
    from clickshop.llm import common

    return common.BATCH


def test_bpe(spark, tables):
    expected = brute.bpe(given(tables, "documents", "doc_id", "text"))
    assert ordered(run(spark, tables, "op6_bpe").collect()) == ordered(expected)


def test_simhash(spark, tables):
    expected = brute.simhash(given(tables, "documents", "doc_id", "text"))
    assert ordered(run(spark, tables, "op7_simhash_groups").collect()) == ordered(expected)


def test_secrets_base(spark, tables):
    rows = run(spark, tables, "op8_secret_scan").collect()
    expected = []
    for doc, text in given(tables, "documents", "doc_id", "text"):
        spans = brute.base_spans(text)
        counts = [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        expected.append((doc, *counts, brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    assert ordered(tuple(r)[:5] for r in rows) == ordered(expected)


def test_html_rows(spark, tables):
    rows = run(spark, tables, "op9_html_text").collect()
    pages = given(tables, "pages", "page_id", "url")
    assert ordered((r.page_id, r.url) for r in rows) == ordered(pages)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_license_scan_base(spark, tables):
    rows = run(spark, tables, "op12_license_scan").collect()
    expected = brute.licenses(given(tables, "documents", "doc_id", "text"), licenses.BASE_PHRASES)
    assert ordered(tuple(r)[:6] for r in rows) == ordered(expected)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)


def test_license_scan_all_phrases(spark, tables):
    found = licenses.scan(spark.read.parquet(f"{tables}/documents.parquet")).collect()
    expected = brute.licenses(given(tables, "documents", "doc_id", "text"), licenses.BASE_PHRASES | licenses.MORE_PHRASES)
    got = [(r.doc_id, r.n_words, len(r.notices), ",".join(sorted({n.label for n in r.notices}))) for r in found]
    assert ordered(got) == ordered((e[0], e[1], e[2], e[5]) for e in expected)


@pytest.mark.parametrize("name", [n for n in contract.queries() if n[:2] == "op" and n[2].isdigit()])
def test_empty_tables(spark, empty, name):
    rows = run(spark, empty, name).collect()
    assert len(rows) == (1 if name == "op5_chat_format" else 0)


def test_native_plans_hold_no_python(spark, small):
    for name in ("op3_quality_rules", "op5_chat_format"):
        plan = run(spark, small, name)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "ExistingRDD"))
