"""Benchmark decontamination with an FM-index per shard of documents.

Benchmark items are cut into windows of ``WINDOW`` words; an item of fewer words is one
window.  A shard is an Arrow batch of documents, of bounded size.  Its words become symbols
of the benchmark's vocabulary; a word outside it cannot lie in a window, so only runs of
known words at least as long as the shortest window enter the shard's index.  All windows
are searched backward through wavelet-tree ranks, their occurrences located by sampled
suffix positions, and overlapping occurrences merged into removal spans.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text, each broadcast by
itself; with more than one block the spans of a document are merged over the blocks.

A null or empty text has no words and is not contaminated; an item without words has no
window.  Rows are judged one by one, so repeated rows and ids change nothing.  Items of
one id count once; a null id counts as the empty string.  Empty tables are fine.  Input
columns pass through, but for those named like the added ones, which are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from clickshop.llm.common import field, free_name, in_batches, mapped, others, prepare, text_bytes, written
from clickshop.llm.fm_index import FmIndex

WINDOW = 13
BLOCK_BYTES = 8 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LONG = 64
_SIEVE = 1 << 20

ADDED = ("n_words", "hits", "items")
HIT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("first_word", "end_word", "start", "end")]
)
_HITS = pa.list_(
    pa.struct([(n, pa.int64()) for n in ("first_word", "end_word", "start", "end")])
)


class _Words:
    """The words of texts that lie end to end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = _LOWER[data]
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = _IN_WORD[self.data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True  # words end with their text
        self.starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
        self.sizes = ends - self.starts
        self.bounds = np.searchsorted(self.starts, offsets)  # of the texts, in words
        self._raw = self.data.tobytes()
        self._eights = np.ndarray(n + 1, dtype="<u8", buffer=self._raw + bytes(8), strides=(1,))

    def eight(self, words: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8 k to 8 k + 7 of words that have any there."""
        left = np.minimum(self.sizes[words] - 8 * k, 8)
        return self._eights[self.starts[words] + 8 * k] & _MASK[left]

    def word(self, i: int) -> bytes:
        return self._raw[self.starts[i] : self.starts[i] + self.sizes[i]]

    def hashes(self) -> np.ndarray:
        mixed = self.sizes.astype(np.uint64)
        for k in range(_LONG // 8):
            own = np.flatnonzero(self.sizes > 8 * k)
            if not len(own):
                break
            x = (mixed[own] ^ self.eight(own, k)) * _ODD
            mixed[own] = x ^ (x >> np.uint64(29))
        for i in np.flatnonzero(self.sizes > _LONG).tolist():
            mixed[i] = int.from_bytes(hashlib.blake2b(self.word(i), digest_size=8).digest())
        return mixed


class Phrases:
    """The windows of a block of benchmark items, over a vocabulary of its words."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW) -> None:
        windows: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = _WORD.findall(_LOWER[np.frombuffer(text.encode(), np.uint8)].tobytes())
            for i in range(max(1, len(words) - window + 1) if words else 0):
                windows.setdefault(tuple(words[i : i + window]), set()).add(item)
        vocabulary = sorted({w for words in windows for w in words})
        self.shortest = min(map(len, windows), default=0)
        self.words = _Words(*text_bytes(pa.array(vocabulary, pa.binary())))
        hashes = self.words.hashes()
        self._order = np.argsort(hashes)
        self._hashes = hashes[self._order]
        self._sieve = np.zeros(_SIEVE, bool)
        self._sieve[hashes & np.uint64(_SIEVE - 1)] = True
        number = {w: i + 2 for i, w in enumerate(vocabulary)}  # 1 ends a run
        self.symbols = len(vocabulary) + 1
        self.patterns: list[np.ndarray] = []
        self.items: list[list[list[str]]] = []
        for size in sorted({len(w) for w in windows}):
            own = [w for w in windows if len(w) == size]
            self.patterns.append(np.array([[number[x] for x in w] for w in own]))
            self.items.append([sorted(windows[w]) for w in own])

    def symbols_of(self, words: _Words) -> np.ndarray:
        """Each word's symbol; 0 for words outside the vocabulary."""
        out = np.zeros(len(words.starts), np.int64)
        if not len(self._hashes):
            return out
        hashes = words.hashes()
        at = np.flatnonzero(self._sieve[hashes & np.uint64(_SIEVE - 1)])
        place = np.minimum(np.searchsorted(self._hashes, hashes[at]), len(self._hashes) - 1)
        found = self._hashes[place] == hashes[at]
        at, own = at[found], self._order[place[found]]
        # Equal hashes are no proof: the bytes decide.
        same = words.sizes[at] == self.words.sizes[own]
        for k in range(_LONG // 8):
            deep = np.flatnonzero(same & (words.sizes[at] > 8 * k))
            if not len(deep):
                break
            same[deep] = words.eight(at[deep], k) == self.words.eight(own[deep], k)
        for i in np.flatnonzero(same & (words.sizes[at] > _LONG)).tolist():
            same[i] = words.word(at[i]) == self.words.word(own[i])
        out[at[same]] = own[same] + 2
        return out

    def occurrences(self, words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """First words, lengths and windows of all occurrences, and the windows' items."""
        symbols = self.symbols_of(words)
        none = np.empty(0, np.int64)
        # Maximal runs of known words within a text, long enough for some window.
        known = symbols > 0
        cut = np.zeros(len(symbols) + 1, bool)
        cut[words.bounds] = True
        begin = np.flatnonzero(known & np.concatenate(([True], ~known[:-1])) | known & cut[:-1])
        end = np.flatnonzero(known & np.concatenate((~known[1:], [True])) | known & cut[1:]) + 1
        enough = end - begin >= max(1, self.shortest)
        begin, end = begin[enough], end[enough]
        if not len(begin):
            return none, none, none, []
        sizes = end - begin + 1  # with the symbol that ends a run
        ends = np.cumsum(sizes)
        word_at = np.arange(ends[-1]) - np.repeat(ends - sizes - begin, sizes)
        text = symbols[np.minimum(word_at, len(symbols) - 1)]
        text[ends - 1] = 1
        index = FmIndex(text, self.symbols)
        firsts, lengths, windows, items = [], [], [], []
        for patterns, own_items in zip(self.patterns, self.items):
            lo, hi = index.search(patterns)
            count = hi - lo
            rows = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
            firsts.append(word_at[index.locate(rows)] if len(rows) else none)
            lengths.append(np.full(len(rows), patterns.shape[1]))
            windows.append(np.repeat(np.arange(len(patterns)), count) + len(items))
            items += own_items
        return np.concatenate(firsts), np.concatenate(lengths), np.concatenate(windows), items


def _code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points that start before the byte offsets of one text."""
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]


def find_hits(phrases: Phrases, column: pa.Array) -> tuple[np.ndarray, list, list]:
    """Per text: its number of words, merged hits, and the items that occur."""
    data, offsets = text_bytes(column)
    words = _Words(data, offsets)
    n_words = np.diff(words.bounds)
    hits: list[list[dict]] = [[] for _ in range(len(column))]
    items: list[list[str]] = [[] for _ in range(len(column))]
    first, length, window, names = phrases.occurrences(words)
    if len(first):
        text_of = np.searchsorted(words.bounds, first, side="right") - 1
        for text, own in np.unique(np.stack((text_of, window)), axis=1).T.tolist():
            items[text] += names[own]
        step = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(step, first, 1)
        np.add.at(step, first + length, -1)
        covered = np.concatenate(([0], np.cumsum(step)[:-1] > 0, [0]))
        edge = np.zeros(len(covered), bool)
        edge[1:][words.bounds] = True  # a hit ends with its text
        begin = np.flatnonzero(covered[1:-1] & (~covered[:-2].astype(bool) | edge[1:-1]))
        end = np.flatnonzero(covered[1:-1] & (~covered[2:].astype(bool) | edge[2:])) + 1
        owner = np.searchsorted(words.bounds, begin, side="right") - 1
        for text in np.unique(owner).tolist():
            own = owner == text
            at = offsets[text]
            raw = data[at : offsets[text + 1]]
            a, b = begin[own], end[own]
            start = _code_points(raw, words.starts[a] - at)
            stop = _code_points(raw, words.starts[b - 1] + words.sizes[b - 1] - at)
            rank = words.bounds[text]
            hits[text] = [
                {"first_word": i, "end_word": j, "start": s, "end": e}
                for i, j, s, e in zip(
                    (a - rank).tolist(), (b - rank).tolist(), start.tolist(), stop.tolist()
                )
            ]
    return n_words, hits, [sorted(set(x)) for x in items]


def _pass(documents: DataFrame, items: list[tuple[str, str]], text: str) -> DataFrame:
    """``documents`` with what one block of the benchmark hits."""
    kept = others(documents, *ADDED)
    rows = documents.select(*[field(c) for c in kept])
    schema = T.StructType(list(rows.schema)).add("n_words", T.LongType())
    schema = schema.add("hits", T.ArrayType(HIT)).add("items", T.ArrayType(T.StringType()))
    phrases = documents.sparkSession.sparkContext.broadcast(items)
    place = kept.index(text)

    def hits(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, found, names = find_hits(_phrases(phrases.value), batch.column(place))
        columns = [
            pa.array(n_words, pa.int64()),
            pa.array(found, _HITS),
            pa.array(names, pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*kept, *ADDED])

    return mapped(rows, hits, schema)


_LATEST: list = [None, None]


def _phrases(items: list[tuple[str, str]]) -> Phrases:
    """The windows of a broadcast block, built once in each process."""
    if _LATEST[0] is not items:
        _LATEST[:] = [items, Phrases(items)]
    return _LATEST[1]


def _merged(hits: list[dict]) -> list[dict]:
    out: list[dict] = []
    for hit in sorted(hits, key=lambda h: (h["first_word"], h["end_word"])):
        if out and hit["first_word"] <= out[-1]["end_word"]:
            if hit["end_word"] > out[-1]["end_word"]:
                out[-1] = out[-1] | {"end_word": hit["end_word"], "end": hit["end"]}
        else:
            out.append(hit)
    return out


def contamination(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``documents`` with ``n_words``, ``hits`` and ``items``.

    ``hits`` are the merged removal spans, in words and in code points of the text;
    ``items`` the ids, as strings, of the benchmark items whose windows occur.
    """
    spark = documents.sparkSession
    prepare(spark)
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    source = benchmark.select(item.alias("item"), "text").filter("text is not null")
    total = source.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * total / block_bytes)) if total > block_bytes else 1
    if blocks == 1:
        return _pass(documents, [tuple(r) for r in source.collect()], text)
    # A block is at most block_bytes unless single items are larger.
    row = free_name(documents, "row")
    numbered = written(documents.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = None
    for k in range(blocks):
        own = source.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        narrow = numbered.select(F.col(row).alias("row"), F.col(text).alias("text"))
        part = _pass(narrow, [tuple(r) for r in own], "text")
        part = written(part.drop("text"), "hits")
        found = part if found is None else found.union(part)
    by_row = found.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def merge(batch: pa.RecordBatch) -> pa.RecordBatch:
        merged = [_merged(h) for h in batch.column("hits").to_pylist()]
        columns = [
            pa.array(merged, _HITS) if n == "hits" else c
            for n, c in zip(batch.schema.names, batch.columns)
        ]
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    by_row = by_row.mapInArrow(in_batches(merge), by_row.schema)
    kept = [field(c) for c in others(numbered, *ADDED)]
    return numbered.select(*kept).join(by_row.withColumnRenamed("row", row), row).drop(row)


def n_hit() -> F.Column:
    """Words of a document that lie in a hit."""
    return F.aggregate(
        "hits", F.lit(0).cast("bigint"), lambda s, h: s + h["end_word"] - h["first_word"]
    )


def is_contaminated() -> F.Column:
    """A document with any hit that covers a twentieth of its words or more."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, in their own columns."""
    own = [free_name(documents, f"{c}_") if c.lower() in ADDED else c for c in documents.columns]
    judged = contamination(documents.toDF(*own), benchmark).filter(~is_contaminated())
    return judged.select(*[field(c) for c in own]).toDF(*documents.columns)
