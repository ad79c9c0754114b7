"""Licence scans: notices and identifier tags by Aho-Corasick, expressions by shunting-yard.

One automaton runs over a text's words, joined by blanks, and finds every place of every
notice phrase, overlaps included.  Another runs over the lower-cased text and finds
identifier tags; the rest of a tag's line is read as a licence expression.  ``with`` binds before
``and``, ``and`` before ``or``; an expression ends at the first token that cannot go on, an
operator without a right side counts as not written, and an open bracket closes at the end.

An expression's score says how free its terms are: ``and`` takes the lesser, ``or`` the greater,
and an exception frees a copyleft licence to ``EXCEPTION``.  A document's score is the least of all its notices
and expressions, as all of them hold; without any it is 0.

A null or empty text has no words and no finds.  Rows are judged one by one, so repeated rows and
ids change nothing.  A text of any length is scanned whole, in memory in proportion to it.  Input
columns pass through, but for those named like the added ones, which are replaced.  Empty tables are fine.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from clickshop.llm.common import field, free_name, mapped, others, prepare

# Notice phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
MORE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "under the bsd license": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license version 2": "lgpl-2",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license version 3": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license version 2": "epl-2",
    "cc0 1 0": "cc0",
    "cc by 4 0": "cc-by",
    "cc by 3 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "all rights reserved": "all-rights-reserved",
}
# Tags in front of a licence expression, lower-cased.
TAGS = ("spdx-license-identifier:", "license-expression:", '"license":', "license = ")
# How free the terms of a family of licences are.
FREEDOM = {
    "0bsd": 1.0, "apache": 1.0, "bsd": 1.0, "cc-by": 1.0, "cc0": 1.0, "isc": 1.0, "mit": 1.0, "unlicense": 1.0, "zlib": 1.0,
    "epl": 0.6, "lgpl": 0.6, "mpl": 0.6, "cc-by-sa": 0.4, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nc": 0.2, "cc-by-nd": 0.2, "all-rights-reserved": 0.0,
}
EXCEPTION = 0.7

ADDED = ("n_words", "notices", "expressions", "labels", "score")
_NOTICE = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("end_word", pa.int64())])
_EXPRESSION = pa.struct(
    [("start", pa.int64()), ("end", pa.int64()), ("labels", pa.list_(pa.string())), ("score", pa.float64())]
)
NOTICE = "array<struct<label:string,base:boolean,first_word:bigint,end_word:bigint>>"
EXPRESSIONS = "array<struct<start:bigint,end:bigint,labels:array<string>,score:double>>"

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORDS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in _LOWER)
_LINE_END = re.compile(rb"[\n\r]|$")
_TOKEN = re.compile(r"[\x20\t\"',]*(?:([()])|([a-z0-9][a-z0-9.:+-]*))")
_RANK = {"or": 1, "and": 2, "with": 3}


class Terms(NamedTuple):
    """What an expression or a part of it comes to."""

    labels: set[str]
    score: float


def scan(documents: DataFrame) -> DataFrame:
    """``documents`` with number of words, notices, expressions, all labels, and the score."""
    prepare(documents.sparkSession)
    kept = others(documents, *ADDED)
    text = free_name(documents, "text_")
    given = documents.select(*[field(c) for c in kept], field("text").cast("string").alias(text))
    added = T.StructType.fromDDL(f"n_words bigint, notices {NOTICE}, expressions {EXPRESSIONS}, labels array<string>, score double")
    return mapped(given, _scan_rows, T.StructType([*[given.schema[c] for c in kept], *added]))


def label_of(identifier: str) -> str:
    """The label of a licence identifier: no ``-only`` or ``-or-later``, no minor version 0."""
    label = re.sub(r"(\+|-only|-or-later)+$", "", identifier.lower())
    label = re.sub(r"^(cc-by(?:-nc|-nd|-sa)*|cc0)-[0-9.]+.*$", r"\1", label)
    return re.sub(r"(\.0)+$", "", label)


def freedom(label: str) -> float:
    """The score of the longest family that the label belongs to; 0 if it has none."""
    parts = label.split("-")
    for n in range(len(parts), 0, -1):
        family = "-".join(parts[:n])
        if family in FREEDOM:
            return FREEDOM[family]
    return 0.0


def _apply(operator: str, values: list[Terms]) -> None:
    right, left = values.pop(), values.pop()
    if operator == "with":
        (exception,) = right.labels
        labels = {f"{label}-with-{exception}" for label in left.labels}
        values.append(Terms(labels, max(left.score, EXCEPTION) if left.score else 0.0))
    else:
        less, more = sorted((left.labels, right.labels), key=len)
        more |= less
        better = max if operator == "or" else min
        values.append(Terms(more, better(left.score, right.score)))


def evaluate(text: str) -> tuple[Terms | None, int]:
    """What the longest expression at the start of a lower-cased text means, and where it ends."""
    values: list[Terms] = []
    operators: list[str] = []
    awaits_value, at, end, depth = True, 0, 0, 0
    while found := _TOKEN.match(text, at):
        bracket, word = found.groups()
        if word in _RANK:
            # What goes before ``with`` is a licence, not a bracket or an exception.
            if awaits_value or word == "with" and (text[end - 1] == ")" or operators and operators[-1] == "with"):
                break
            while operators and operators[-1] != "(" and _RANK[operators[-1]] >= _RANK[word]:
                _apply(operators.pop(), values)
            operators.append(word)
            awaits_value = True
        elif word:
            if not awaits_value:
                break
            label = label_of(word.rstrip(".:"))
            values.append(Terms({label}, freedom(label)))
            awaits_value = False
        elif bracket == "(":
            if not awaits_value or operators and operators[-1] == "with":
                break
            operators.append("(")
            depth += 1
        else:
            if awaits_value or not depth:
                break
            while operators[-1] != "(":
                _apply(operators.pop(), values)
            operators.pop()
            depth -= 1
        at = found.end()
        if not awaits_value:
            end = at
    if awaits_value:  # brackets and operators without a right side
        while operators and operators[-1] == "(":
            operators.pop()
        if operators:
            operators.pop()
    while operators:
        if (operator := operators.pop()) != "(":
            _apply(operator, values)
    return (values[0] if values else None), end


@lru_cache(maxsize=1)
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    notices, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrases, base in ((BASE_PHRASES, True), (MORE_PHRASES, False)):
        for phrase, label in phrases.items():
            notices.add_word(f" {phrase} ", (label, base, len(phrase), phrase.count(" ") + 1))
    for tag in TAGS:
        tags.add_word(tag, len(tag))
    notices.make_automaton()
    tags.make_automaton()
    return notices, tags


def _scan_text(text: str | None) -> tuple[int, list[dict], list[dict], list[str], float]:
    data = (text or "").encode()
    words = data.translate(_WORDS).split()
    notices, tags = _automata()
    # One character a byte, so that places in the automata are places in the bytes.
    joined = " " + b" ".join(words).decode("latin-1") + " "
    met = [(end - size, label, base, count) for end, (label, base, size, count) in notices.iter(joined)]
    found = []
    if met:
        blanks = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 0x20)
        first = np.searchsorted(blanks, [m[0] for m in met]) - 1
        for (_, label, base, count), word in sorted(zip(met, first.tolist()), key=lambda m: (m[1], m[0][1:])):
            found.append({"label": label, "base": base, "first_word": word, "end_word": word + count})
    lower = data.translate(_LOWER)
    expressions = []
    terms = [Terms({n["label"]}, freedom(n["label"])) for n in found]
    chars = bytes_seen = 0
    for end, _ in tags.iter(lower.decode("latin-1")):
        start = end + 1
        stop = _LINE_END.search(lower, start).start()
        line = lower[start:stop].decode("latin-1")
        value, size = evaluate(line)
        if value is None:
            continue
        chars += len(data[bytes_seen:start].decode(errors="replace"))
        bytes_seen = start
        lead = len(line) - len(line.lstrip("\x20\t\"',"))
        expressions.append({"start": chars + lead, "end": chars + size, "labels": sorted(value.labels), "score": value.score})
        terms.append(value)
    labels = sorted({label for t in terms for label in t.labels})
    return len(words), found, expressions, labels, min((t.score for t in terms), default=0.0)


def _scan_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [_scan_text(t) for t in batch.columns[-1].to_pylist()]
    kinds = [pa.int64(), pa.list_(_NOTICE), pa.list_(_EXPRESSION), pa.list_(pa.string()), pa.float64()]
    columns = [*batch.columns[:-1], *[pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]]
    return pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
