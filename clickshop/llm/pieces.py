"""Distinct pieces of a batch of texts, for tokenizers that split texts by one pattern.

``PATTERN``-like splits never cut across a single space between two characters that are
not white space: the space always starts a new match.  So a text is the join of pieces
that begin at such spaces, each split and encoded by itself.  Pieces repeat a lot, so a
batch is reduced to its distinct ones with numpy before any Python code looks at them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = 32
# White space of one byte, and the first bytes of characters that may be white space.
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_WIDE = np.zeros(256, bool)
_WIDE[[0xE1, 0xE2, 0xE3]] = True
_OPENS = ~_WHITE & ~_WIDE
_OPENS[0xC2] = False
# Kinds of bytes: letters and digits, signs but the apostrophe (it belongs to "'s" and its
# like), space, other white space, what else opens a character that is not white, the rest.
_REST, _WORD, _SIGN, _BLANK, _BREAK, _OTHER = range(6)
_KIND = np.select(
    [
        [b < 128 and chr(b).isalnum() for b in range(256)],
        [32 < b < 127 and b != 39 for b in range(256)],
        np.arange(256) == _SPACE,
        [9 <= b <= 13 for b in range(256)],
        _OPENS,
    ],
    [_WORD, _SIGN, _BLANK, _BREAK, _OTHER],
    _REST,
).astype(np.uint8)
# For 8 times the kind of a byte and that of the next: whether every match ends between
# them, whatever surrounds them; the same for the last white space before a character, if
# it is cut from other white space; and whether the first byte is such a white space.
_APART, _AFTER, _LAST = np.zeros((3, 64), bool)
_APART[[8 * _WORD + _SIGN, 8 * _SIGN + _WORD]] = True
for _white in (_BLANK, _BREAK):
    _APART[[8 * _WORD + _white, 8 * _SIGN + _white]] = True
    _LAST[[8 * _white + k for k in (_WORD, _SIGN, _OTHER)]] = True
_AFTER[[8 * _BREAK + k for k in (_WORD, _SIGN, _OTHER)]] = True
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LONG = 64


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts start; ``offsets`` bound the texts in ``data``."""
    at = np.flatnonzero(data == _SPACE)
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    wide = (before >= 0x80) & (
        (data[np.maximum(at - 2, 0)] == 0xC2) | _WIDE[data[np.maximum(at - 3, 0)]]
    )
    begins = np.zeros(len(data), bool)
    begins[at[~_WHITE[before] & _OPENS[after] & ~wide]] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Like ``piece_starts``, for ``PATTERN`` alone, with nearly all places where it always cuts.

    Its matches hold letters or signs or white space, but for one space in front.  White space
    before a character is one match without its last character, which is a match of its own or
    that space.  Letters are ASCII ones and those of U+00C0 to U+00FF; cuts left out do no harm.
    """
    pairs = _pairs(data)
    begins = np.zeros(len(data), bool)
    begins[:-1] = _LAST[pairs]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    begins[firsts[firsts > 0] - 1] = False
    begins[1:] |= _APART[pairs] | _AFTER[pairs]
    begins[firsts] = True
    return np.flatnonzero(begins)


def joints(data: np.ndarray) -> np.ndarray:
    """For each place of joined pieces, the end included: whether those that meet there keep
    their matches if they are searched as one text."""
    found = np.zeros(len(data) + 1, bool)
    found[piece_starts(data, np.array([0, len(data)]))] = True
    found[1:-1] |= _APART[_pairs(data)]
    return found


def _pairs(data: np.ndarray) -> np.ndarray:
    """For each byte but the last: 8 times its kind and the kind of the next."""
    kind = _KIND[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[lead < len(data) - 1]
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # × and ÷
    kind[lead] = kind[lead + 1] = _WORD
    return 8 * kind[:-1] + kind[1:]


def numbered(
    known: pa.LargeBinaryArray, data: np.ndarray, starts: np.ndarray
) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """``known`` distinct pieces and after them the new ones of ``data``, whose pieces have
    these starts; and the number of each of its pieces in order."""
    bounds = np.append(starts, len(data)).astype(np.int64)
    own = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
    )
    found = pa.concat_arrays([known, own]).dictionary_encode()
    return found.dictionary, found.indices.to_numpy()[len(known) :]


def distinct_pieces(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct pieces, the number of each piece in order, and the texts' bounds in these."""
    starts = piece_starts(data, offsets)
    if not len(starts):
        return [], np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    bounds = np.searchsorted(starts, offsets)
    sizes = np.diff(np.append(starts, len(data)))
    raw = data.tobytes()
    first, inverse = _by_words(raw, starts, sizes)
    found = [raw[a : a + n] for a, n in zip(starts[first].tolist(), sizes[first].tolist())]
    return found, inverse, bounds


def _by_words(raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First occurrence of each distinct piece, and each piece's number among them."""
    padded = raw + bytes(8)
    words = np.ndarray(len(raw) + 1, dtype="<u8", buffer=padded, strides=(1,))

    def word(at: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
        return words[at + 8 * k] & _MASK[np.minimum(size - 8 * k, 8)]

    mixed = sizes.astype(np.uint64)
    steps = [np.flatnonzero(sizes > 8 * k) for k in range(_LONG // 8)]
    for k, own in enumerate(steps):
        x = (mixed[own] ^ word(starts[own], sizes[own], k)) * _ODD
        mixed[own] = x ^ (x >> np.uint64(29))
    _, first, inverse = np.unique(mixed, return_index=True, return_inverse=True)
    same = first[inverse]
    equal = (sizes[same] == sizes).all() and (sizes <= _LONG).all()
    if equal:
        for k, own in enumerate(steps):
            one = word(starts[own], sizes[own], k)
            if not (one == word(starts[same[own]], sizes[same[own]], k)).all():
                equal = False
                break
    if equal:
        return first, inverse
    # Very long pieces, or two pieces of one hash: compare the pieces themselves.
    numbers: dict[bytes, int] = {}
    first_at: list[int] = []
    inverse = np.empty(len(starts), np.int64)
    for i, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
        piece = raw[a : a + n]
        number = numbers.setdefault(piece, len(numbers))
        if number == len(first_at):
            first_at.append(i)
        inverse[i] = number
    return np.array(first_at), inverse


class Memo:
    """A bounded map of what was put into it twice or more.

    Most pieces of a corpus occur once and would only push out the others, so a bitmap of
    hashes first tells whether a key came before.  The map forgets what was not asked for
    while ``limit`` entries came in.
    """

    def __init__(self, limit: int, seen_bits: int = 24) -> None:
        self.limit = limit
        self._new: dict = {}
        self._old: dict = {}
        self._seen = bytearray(1 << (seen_bits - 3))
        self._mask = (1 << seen_bits) - 1

    def get(self, key):
        found = self._new.get(key)
        if found is None:
            found = self._old.get(key)
            if found is not None:
                self._store(key, found)
        return found

    def put(self, key, value) -> None:
        place = hash(key) & self._mask
        bit = 1 << (place & 7)
        if self._seen[place >> 3] & bit:
            self._store(key, value)
        else:
            self._seen[place >> 3] |= bit

    def _store(self, key, value) -> None:
        if len(self._new) >= self.limit:
            self._old, self._new = self._new, {}
        self._new[key] = value


def expand(
    tokens: list[bytes], inverse: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts end to end, and the texts' bounds in them.

    ``tokens`` has the ids of each distinct piece as 32-bit integers.
    """
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) // 4
    return spread(np.frombuffer(b"".join(tokens), np.uint32), sizes, inverse, bounds)


def spread(
    flat: np.ndarray, sizes: np.ndarray, inverse: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Like ``expand``, of the distinct pieces' ids end to end and their numbers of ids."""
    starts = np.cumsum(sizes) - sizes
    own = sizes[inverse]
    ends = np.concatenate(([0], np.cumsum(own)))
    skip = np.repeat(starts[inverse] - ends[:-1], own)
    return flat[skip + np.arange(ends[-1])], ends[bounds]
