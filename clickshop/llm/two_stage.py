"""Two-stage suffix sorting of short byte strings, on numpy.

Stage one sorts only the suffixes that are smaller than their successors.  Stage two scans
the buckets of first bytes in ascending order and induces all others: a suffix larger than
its successor lies in a bucket not below its successor's, so whole buckets are scanned at
once, and a run of one byte takes one step per repetition.
"""

from __future__ import annotations

import numpy as np

#: Bytes compared by the direct sort, in words of eight.  Longer prefixes stay in any order.
DEPTH_WORDS = 7


class Strings:
    """Byte strings end to end, a zero after each; symbols are bytes plus one."""

    def __init__(self, raw: bytes, sizes: np.ndarray) -> None:
        data = np.frombuffer(raw, np.uint8)
        n = len(data) + len(sizes)
        self.ends = np.cumsum(sizes + 1) - 1  # where the zeros are
        self.starts = self.ends - sizes
        inside = np.ones(n, bool)
        inside[self.ends] = False
        plain = np.zeros(n + 8, np.uint8)
        plain[:n][inside] = data
        self.symbols = np.zeros(n, np.uint16)
        self.symbols[inside] = data.astype(np.uint16) + 1
        self.left = np.repeat(self.ends, sizes + 1) - np.arange(n)  # bytes up to the zero
        self._eights = np.ndarray(n + 1, dtype=">u8", buffer=plain.tobytes(), strides=(1,))

    def eight(self, at: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8 k .. 8 k + 7 of suffixes as one number, zero beyond their string."""
        left = np.clip(self.left[at] - 8 * k, 0, 8)
        place = np.minimum(at + 8 * k, len(self._eights) - 1)
        shift = (8 * (8 - left)).astype(np.uint64)
        word = self._eights[place].astype(np.uint64)
        return np.where(left > 0, word >> np.minimum(shift, 63) << np.minimum(shift, 63), 0)

    def suffix_array(self) -> np.ndarray:
        """Suffixes in the order of their first ``8 * DEPTH_WORDS`` bytes or more."""
        symbols = self.symbols
        n = len(symbols)
        small = _smaller_than_next(symbols)
        counts = np.bincount(symbols, minlength=257)
        tail = np.cumsum(counts)  # S-type suffixes end their bucket
        head = tail - counts
        order = np.full(n, -1, np.int64)
        direct = self._sorted(np.flatnonzero(small))
        first = symbols[direct]
        small_counts = np.bincount(first, minlength=257)
        split = tail - small_counts
        order[_places(first, split)] = direct
        free = head.copy()

        def induce(entries: np.ndarray) -> None:
            before = entries - 1
            before = before[before >= 0]
            before = before[~small[before]]
            if not len(before):
                return
            bucket = symbols[before]
            by = np.argsort(bucket, kind="stable")
            bucket = bucket[by]
            order[_places(bucket, free)] = before[by]
            np.add(free, np.bincount(bucket, minlength=257), out=free)

        for c in np.flatnonzero(counts).tolist():
            done = head[c]
            while done < free[c]:  # larger ones, then those they induce in this bucket
                now = free[c]
                induce(order[done:now])
                done = now
            induce(order[split[c] : tail[c]])
        return order

    def _sorted(self, at: np.ndarray) -> np.ndarray:
        """``at`` ordered by the bytes of the suffixes; only ties look at further words."""
        word = self.eight(at, 0)
        by = np.argsort(word, kind="stable")
        at, word = at[by], word[by]
        rank = np.concatenate(([0], np.cumsum(word[1:] != word[:-1]))) if len(at) else at
        tied = np.arange(len(at))
        for k in range(1, DEPTH_WORDS):
            if not len(tied):
                break
            own = rank[tied]
            same = own[1:] == own[:-1]
            keep = np.concatenate((same, [False])) | np.concatenate(([False], same))
            tied = tied[keep]
            if not len(tied):
                break
            word = self.eight(at[tied], k)
            by = np.lexsort((word, rank[tied]))
            old, word = rank[tied], word[by]
            at[tied] = at[tied][by]
            # Dense ranks among the tied ones are enough: groups never mix again.
            step = (old[1:] != old[:-1]) | (word[1:] != word[:-1])
            rank[tied] = np.concatenate(([0], np.cumsum(step)))
        return at

    def common_prefixes(self, order: np.ndarray, limit: int) -> np.ndarray:
        """Common bytes, up to ``limit``, of each suffix with the one before it."""
        a, b = order[:-1], order[1:]
        common = np.zeros(len(a), np.int64)
        open_pairs = np.arange(len(a))
        for k in range(-(-limit // 8)):
            x = self.eight(a[open_pairs], k) ^ self.eight(b[open_pairs], k)
            equal = np.zeros(len(x), np.int64)
            for byte in range(1, 9):
                equal += x < np.uint64(1 << (64 - 8 * byte)) if byte < 8 else x == 0
            common[open_pairs] += equal
            open_pairs = open_pairs[equal == 8]
        reach = np.minimum(np.minimum(self.left[a], self.left[b]), limit)
        return np.concatenate(([0], np.minimum(common, reach)))


def _smaller_than_next(symbols: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; the last one counts as such."""
    n = len(symbols)
    small = np.ones(n, bool)
    small[:-1] = symbols[:-1] < symbols[1:]
    equal = np.zeros(n, bool)
    equal[:-1] = symbols[:-1] == symbols[1:]
    # An equal neighbour decides as the next one that differs.
    at = np.where(equal, n, np.arange(n))
    at = np.minimum.accumulate(at[::-1])[::-1]
    return small[np.minimum(at, n - 1)]


def _places(buckets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Positions for entries in bucket order, from each bucket's first free place on."""
    starts = np.concatenate(([True], buckets[1:] != buckets[:-1])) if len(buckets) else buckets
    at = np.flatnonzero(starts)
    sizes = np.diff(np.append(at, len(buckets)))
    return np.repeat(begin[buckets[at]] - at, sizes) + np.arange(len(buckets))
