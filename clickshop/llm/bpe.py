"""Byte-level BPE encoding and decoding from a rank file.

Pre-tokens are merged with a rank queue: a bucket per merge rank holds positions of a
linked list of parts, and a two-level bitmap names the buckets that are not empty.
Find-first-set gives the lowest rank, its leftmost position is merged, and entries whose
pair has changed since are skipped.  A pre-token of n bytes takes O(n log n) time, so very
long ones (one letter repeated, packed data) are no special case.  Short pre-tokens share
one queue: a bucket's leftmost position of each of them is merged in the same numpy step,
which changes nothing for any of them, as their parts never meet.

A null or empty text has no ids.  Rows are read one by one: repeated rows and ids change
nothing, an empty table gives an empty result, other columns pass through.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from clickshop.llm.common import field, mapped, others, prepare, text_bytes
from clickshop.llm.pieces import Memo, distinct_pieces, expand

_BITS = 9
_LOW = (1 << _BITS) - 1
_NONE = -1
#: Pieces and pre-tokens that a worker remembers, in two generations.
REMEMBERED = 100_000
#: Bytes up to which pre-tokens share a queue.
SHORT = 64


class _Queue:
    """Buckets of positions by rank, and the bitmap of those that are not empty."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self._low: dict[int, int] = {}
        self._high = 0

    def __bool__(self) -> bool:
        return self._high != 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.fill(rank, [position])
        else:
            heappush(bucket, position)

    def fill(self, rank: int, positions: list[int]) -> None:
        """A whole bucket in ascending order, which makes it a heap."""
        self.buckets[rank] = positions
        block = rank >> _BITS
        self._low[block] = self._low.get(block, 0) | 1 << (rank & _LOW)
        self._high |= 1 << block

    def lowest(self) -> int:
        block = (self._high & -self._high).bit_length() - 1
        bits = self._low[block]
        return block << _BITS | (bits & -bits).bit_length() - 1

    def drop(self, rank: int) -> list[int]:
        block = rank >> _BITS
        self._low[block] ^= 1 << (rank & _LOW)
        if not self._low[block]:
            self._high ^= 1 << block
        return self.buckets.pop(rank)


class Codec:
    """Ranks and pattern of one vocabulary."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.ranks = read_ranks(rank_file)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self._pieces = Memo(REMEMBERED)
        self._words = Memo(REMEMBERED)
        # Pairs of ids that join to a token: keys in order, and the token's rank.
        self._end = max(self.tokens) + 1
        pairs = {
            self.ranks[t[:i]] * self._end + self.ranks[t[i:]]: rank
            for t, rank in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        }
        self._pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self._pair_ranks = np.array([pairs[k] for k in self._pair_keys.tolist()], dtype=np.int64)
        self._byte_ids = np.array([self.ranks.get(bytes([b]), _NONE) for b in range(256)])

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; none for ``_end``, which stands between pre-tokens."""
        key = left * self._end + right
        at = np.minimum(np.searchsorted(self._pair_keys, key), len(self._pair_keys) - 1)
        hit = (self._pair_keys[at] == key) & (left < self._end) & (right < self._end)
        return np.where(hit, self._pair_ranks[at], _NONE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """The ids of many pre-tokens, from one queue, as 32-bit integers."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        gaps = np.cumsum(sizes + 1)  # after each word a gap; position 0 is one as well
        ids = np.full(int(gaps[-1]) + 1, self._end)
        inside = np.ones(len(ids), bool)
        inside[0] = False
        inside[gaps] = False
        ids[inside] = self._byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word_of = np.cumsum(~inside)
        after = np.arange(1, len(ids) + 1)
        before = np.arange(-1, len(ids) - 1)
        pair = np.full(len(ids), _NONE)
        pair[:-1] = self._joined(ids[:-1], ids[1:])
        queue = _Queue()
        order = np.argsort(pair, kind="stable")
        order = order[np.searchsorted(pair[order], 0) :]
        ranks, starts = np.unique(pair[order], return_index=True)
        for rank, positions in zip(ranks.tolist(), np.split(order, starts[1:])):
            queue.fill(rank, positions.tolist())
        while queue:
            rank = queue.lowest()
            at = np.array(sorted(set(queue.drop(rank))))
            at = at[pair[at] == rank]  # the others are stale
            if not len(at):
                continue
            own = word_of[at]
            first = np.concatenate(([True], own[1:] != own[:-1]))
            if not first.all():
                queue.fill(rank, at[~first].tolist())
                at = at[first]
            right = after[at]
            beyond = after[right]
            inside[right] = False
            pair[right] = _NONE
            ids[at] = rank
            after[at] = beyond
            before[beyond] = at
            left = before[at]
            places = np.concatenate((at, left))
            new = self._joined(ids[places], ids[np.concatenate((beyond, at))])
            pair[places] = new
            hit = new >= 0
            for r, p in zip(new[hit].tolist(), places[hit].tolist()):
                queue.push(r, p)
        flat = ids[inside].astype(np.uint32).tobytes()
        counts = np.bincount(word_of[inside] - 1, minlength=len(words))
        ends = (4 * np.cumsum(counts)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        rank_of = self.ranks.get
        whole = rank_of(word)
        if whole is not None:
            return [whole]
        n = len(word)
        after = list(range(1, n + 1))  # part i is word[i : after[i]]
        before = list(range(-1, n - 1))
        pair = [rank_of(word[i : i + 2], _NONE) for i in range(n - 1)]
        pair.append(_NONE)  # pair[i]: rank of part i joined with the next
        queue = _Queue()
        for i, r in enumerate(pair):
            if r >= 0:
                queue.push(r, i)
        while queue:
            r = queue.lowest()
            bucket = queue.buckets[r]
            i = heappop(bucket)
            if not bucket:
                queue.drop(r)
            if pair[i] != r:
                continue  # stale: this pair was merged or changed
            j = after[i]
            k = after[i] = after[j]
            pair[j] = pair[i] = _NONE
            if k < n:
                before[k] = i
                r = pair[i] = rank_of(word[i : after[k]], _NONE)
                if r >= 0:
                    queue.push(r, i)
            p = before[i]
            if p >= 0:
                r = pair[p] = rank_of(word[p:k], _NONE)
                if r >= 0:
                    queue.push(r, p)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[word[i : after[i]]])
            i = after[i]
        return ids

    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many texts, each match of the pattern by itself, as 32-bit integers."""
        found = [self._pieces.get(p) for p in pieces]
        matches = {
            i: [m.encode() for m in self.split(pieces[i].decode())]
            for i, ids in enumerate(found)
            if ids is None
        }
        known: dict[bytes, bytes] = {}
        short = []
        for word in {w for words in matches.values() for w in words}:
            ids = self._words.get(word)
            if ids is not None:
                known[word] = ids
            elif word in self.ranks:
                known[word] = np.uint32(self.ranks[word]).tobytes()
            elif len(word) <= SHORT:
                short.append(word)
            else:
                known[word] = np.array(self.merge(word), np.uint32).tobytes()
        if short:
            for word, ids in zip(short, self.merge_many(short)):
                known[word] = ids
                self._words.put(word, ids)
        for i, words in matches.items():
            found[i] = b"".join([known[w] for w in words])
            self._pieces.put(pieces[i], found[i])
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts end to end, and the texts' bounds in them."""
        distinct, inverse, bounds = distinct_pieces(data, offsets)
        return expand(self.pieces(distinct), inverse, bounds)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def read_ranks(rank_file: bytes) -> dict[bytes, int]:
    """Rank of each token of a rank file."""
    lines = [line.split() for line in rank_file.splitlines() if line]
    return {base64.b64decode(token): int(rank) for token, rank in lines}


_CODECS: dict[tuple, Codec] = {}


def codec(rank_file: bytes, pattern: str) -> Codec:
    """The codec, built once in each process."""
    key = (hash(rank_file), len(rank_file), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(rank_file, pattern)
    return _CODECS[key]


_TOKENS: dict[tuple, dict[int, bytes]] = {}


def tokens(rank_file: bytes) -> dict[int, bytes]:
    """Token of each rank, all that decoding needs, built once in each process."""
    key = (hash(rank_file), len(rank_file))
    if key not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[key] = {rank: token for token, rank in read_ranks(rank_file).items()}
    return _TOKENS[key]


def encode(
    documents: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``documents`` with the array ``ids`` in place of the text.

    The rank file is read once on the driver and broadcast; its size is the vocabulary's.
    """
    spark = documents.sparkSession
    prepare(spark, share=2)
    ranks = spark.sparkContext.broadcast(Path(rank_file).read_bytes())
    kept = others(documents, text, ids)
    own = [field(c) for c in kept]
    schema = documents.select(*own, F.array(F.lit(0)).alias(ids)).schema

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = codec(ranks.value, pattern).encode(*text_bytes(batch.column(len(kept))))
        lists = pa.ListArray.from_arrays(
            pa.array(bounds.astype(np.int32)), pa.array(flat.astype(np.int32))
        )
        return pa.RecordBatch.from_arrays(
            [*batch.columns[: len(kept)], lists], names=[*kept, ids]
        )

    source = documents.select(*own, F.col(text).alias("_text"))
    return mapped(source, rows, schema)


def decode(
    encoded: DataFrame, rank_file: str, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``encoded`` with the bytes that its ids stand for, in the binary column ``out``."""
    spark = encoded.sparkSession
    prepare(spark, share=2)
    ranks = spark.sparkContext.broadcast(Path(rank_file).read_bytes())
    kept = others(encoded, out)
    source = encoded.select(*[field(c) for c in kept])
    schema = source.withColumn(out, F.lit(b"")).schema
    place = kept.index(ids)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        token = tokens(ranks.value).__getitem__
        column = batch.column(place)
        bounds = column.offsets.to_numpy()
        values = column.values.to_numpy(zero_copy_only=False)
        out_bytes = [
            b"".join(map(token, values[a:b].tolist())) for a, b in zip(bounds[:-1], bounds[1:])
        ]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[: len(kept)], pa.array(out_bytes, pa.binary())], names=[*kept, out]
        )

    return mapped(source, rows, schema)
