"""Collocations, licence expressions and periodic runs against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clickshop.llm import collocations, licenses, periodic_runs
from clickshop.llm.collocations import DoubleArray

from . import brute

# --- collocations


@settings(max_examples=80, deadline=None)
@given(st.sets(st.tuples(st.integers(1, 12), st.integers(1, 40)), min_size=1, max_size=200))
def test_double_array_knows_its_edges_and_no_others(edges):
    trie = DoubleArray(np.array([s << 32 | w for s, w in edges]))
    states, words = np.meshgrid(np.arange(14, dtype=np.int32), np.arange(42, dtype=np.int32), indexing="ij")
    found = trie.step(states.ravel(), words.ravel())
    for s, w, edge in zip(states.ravel().tolist(), words.ravel().tolist(), found.tolist()):
        assert (edge >= 0) == ((s, w) in edges)
        assert edge < 0 or trie.keys[edge] == s << 32 | w


def test_packed_numbers_come_back():
    for numbers in (np.array([], np.int32), np.arange(-3, 70_000, dtype=np.int32), np.array([1 << 62, -1, 0])):
        assert (collocations._unpacked(collocations._packed(numbers)) == numbers).all()


ROWS = [
    ("a b c a b c a b c. a b", "en"), ("A\tB c, x y x y x y x", "en"), ("a b c a b c", None), (None, "en"), ("", "de"),
    ("the cat the cat the cat the cat the cat", "en"), ("the cat\nthe cat the cat", "x y"), ("the cat the cat", "und"),
    ("\u00c4b \u00e4b \u00c4b \u00e4b \u00c4b", "de"), ("a b c a b c a b c. a b", "en"),
]


def counted(rows) -> dict[str, Counter]:
    found: dict[str, Counter] = {}
    for text, lang in rows:
        for mark in ".,;:!?\n\x0b\x0c\r":
            text = brute.lower(text).replace(mark, "\0")
        for piece in text.split("\0"):
            words = piece.replace("\t", " ").split(" ")
            words = [w for w in words if w]
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    found.setdefault(lang or "und", Counter())[tuple(words[i : i + size])] += 1
    return found


def expected(rows, least: int) -> list[tuple]:
    out = []
    for lang, f in counted(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        own = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in own.items():
            inside = [q for q, c in own.items() if len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not inside:
                score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored), 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


@pytest.mark.parametrize(("shard", "block"), [(1 << 20, 1 << 20), (7, 3)])
def test_collocations_in_small_shards_and_blocks(spark, shard, block):
    documents = spark.createDataFrame(ROWS * 2, "text string, lang string")
    found = collocations.collocations(documents, least=3, shard=shard, block=block)
    assert sorted(map(tuple, found.collect())) == expected(ROWS * 2, 3)


def test_collocations_without_frequent_words(spark):
    documents = spark.createDataFrame([("a b", "en")], "text string, lang string")
    found = collocations.collocations(documents)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found.collect() == []


# --- licences


def grown(rng: random.Random, depth: int) -> list[str]:
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        name = rng.choice(["mit", "apache-2.0", "gpl-3.0-or-later", "bsd-3-clause", "own-1.0", "cc-by-nc-4.0"])
        return [name, "with", "classpath-exception-2.0"] if kind < 0.08 else [name]
    if kind < 0.5:
        return ["(", *grown(rng, depth - 1), ")"]
    return [*grown(rng, depth - 1), rng.choice(["and", "or"]), *grown(rng, depth - 1)]


def test_expressions_mean_what_recursive_descent_says():
    rng = random.Random(5)
    for _ in range(500):
        tokens = grown(rng, 5)
        text = " ".join(tokens)
        terms, end = licenses.evaluate(text + " and then some")
        terms, end = licenses.evaluate(text)
        labels, score = brute.license_terms(tokens, licenses.label_of, licenses.freedom, licenses.EXCEPTION)
        assert (terms.labels, terms.score, end) == (labels, score, len(text))


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("MIT copyright 2020", {"mit"}), ("mit or", {"mit"}), ("(mit or (apache-2.0", {"mit", "apache-2"}),
        ("mit and ((", {"mit"}), ("mit) or gpl-2.0", {"mit"}), ("mit with", {"mit"}), ("(mit) with x", {"mit"}),
        ("gpl-2.0+ with a with b", {"gpl-2-with-a"}), ("mit or and gpl-2.0", {"mit"}), ("(" * 50_000 + "mit" + ")" * 50_000, {"mit"}),
        ("\"MIT\",", {"mit"}),
    ],
)
def test_broken_expressions_end_where_they_break(text, labels):
    assert licenses.evaluate(text.lower())[0].labels == labels


@pytest.mark.parametrize("text", ["", "and mit", "or", "()", "((", ") mit", "***"])
def test_no_expression(text):
    assert licenses.evaluate(text)[0] is None


def test_tags_and_spans(spark):
    text = "\u00e9\u00e9 // SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Zlib */\nx = 1\nLicense = 'Apache-2.0'\n"
    (row,) = licenses.scan(spark.createDataFrame([(text,)], "text string")).collect()
    assert [text[e.start : e.end] for e in row.expressions] == ["(MIT OR GPL-2.0-only) AND Zlib", "Apache-2.0"]
    assert row.labels == ["apache-2", "gpl-2", "mit", "zlib"]
    assert row.score == 1.0
    assert row.notices == []


def test_overlapping_notices_all_count(spark):
    text = "cc by nc sa CC-BY-NC cc by cc by nc"
    (row,) = licenses.scan(spark.createDataFrame([(text,)], "text string")).collect()
    assert [(n.label, n.first_word, n.end_word) for n in row.notices if n.base] == [("cc-by-nc", 0, 3), ("cc-by-nc", 4, 7), ("cc-by-nc", 9, 12)]
    assert row.labels == ["cc-by-nc", "cc-by-nc-sa"]


# --- periodic runs


def found_runs(words: list[int], *more: list[int]) -> list[list[tuple]]:
    texts = [words, *more]
    codes = np.array([w for t in texts for w in t], np.int64)
    text, *runs = periodic_runs.runs_of(codes, np.array([len(t) for t in texts]))
    out: list[list[tuple]] = [[] for _ in texts]
    for t, *run in zip(text.tolist(), *[r.tolist() for r in runs]):
        out[t].append(tuple(run))
    return out


def test_runs_of_random_words():
    rng = random.Random(1)
    for trial in range(400):
        texts = []
        for _ in range(3):
            words: list[int] = []
            while len(words) < rng.choice([6, 20, 150]):
                unit = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.choice([1, 2, 3, 5, 9]))]
                if rng.random() < 0.4:
                    unit = unit * rng.randint(2, 4) + [7]
                words += (unit * rng.randint(1, 7))[: rng.randint(1, 60)]
            texts.append(words)
        assert found_runs(*texts) == [brute.word_runs(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=4, max_size=70))
def test_runs_of_two_words(words):
    assert found_runs(words) == [brute.word_runs(words)]


def test_one_word_all_through():
    assert found_runs([5] * 4_001) == [[(0, 4_001, 1)]]


def test_nested_periods():
    inner = [1] * 8 + [2]
    words = inner * 9 + [3]
    assert found_runs(words * 5 + [4]) == [brute.word_runs(words * 5 + [4])]


def test_runs_leave_other_columns(spark):
    rows = [(1, "x y x y x y x y z", "kept"), (1, None, None), (2, "", ""), (3, " a\u00a0b ", "")]
    found = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")).collect()
    assert [(r.n_words, [tuple(x) for x in r.runs], r.best and tuple(r.best), r.collapsed, r["a.b"]) for r in found] == [
        (9, [(0, 8, 2)], (0, 8, 2), "x y z", "kept"), (0, [], None, "", None), (0, [], None, "", ""), (1, [], None, "a\u00a0b", ""),
    ]
