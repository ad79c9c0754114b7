"""Runs of repeated word sequences, by internal pattern matching.

The texts of a batch lie end to end as word numbers, distinct per text, so that nothing matches
across texts.  Prefix doubling names all stretches of 2^k words and sorts the suffixes; only
stretches found more than once are sorted again.  A wavelet tree over the suffix array
answers, for many ranges at once, which occurrence follows a position.

A run of least period q and four periods or more holds an aligned block of b = 2^k words, b <= q < 2b,
that starts again q words on.  So each block asks for its occurrences in the b places beyond itself.
They form an arithmetic progression.  One or two occurrences are candidate periods.  Three or more differ
by the block's own period, and lie in a stretch of that period; a longer period can only
be the distance between the ends of that stretch and of the block's own one.  Stretches equal
in both directions, from the names of halved lengths, give a candidate's run.

A null or empty text has no words and no runs.  Rows are judged one by one, so repeated rows and
ids change nothing.  A batch, of at least one whole text, is one numpy problem: about 200 bytes a
word.  Runs are ordered by start, then period; of equal exponents the first
is ``best``.  Input columns pass through, but for those named like the added ones, which are
replaced.  Empty tables are fine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickshop.llm.common import field, free_name, let, mapped, others, prepare

#: Periods that a run holds at least, and its least length in words.
EXPONENT, LENGTH = 4, 6
ADDED = ("n_words", "runs", "best", "collapsed")
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
_SPACES = r"[\x20\x09-\x0D]+"


def periodic_runs(documents: DataFrame) -> DataFrame:
    """``documents`` with the runs of each text, the best one, and the text without repeats."""
    prepare(documents.sparkSession)
    kept = others(documents, *ADDED)
    text = free_name(documents, "text_")
    given = documents.select(*[field(c) for c in kept], field("text").cast("string").alias(text))
    types = [given.schema[c] for c in kept]
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("best", RUN),
        T.StructField("collapsed", T.StringType()),
    ]
    return mapped(given, _judge, T.StructType([*types, *added]))


def repeated_tail(text: Column, key: Column) -> Column:
    """``text`` with a periodic tail in a tenth of all rows, drawn from the key's checksum."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tailed(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        copies = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), copies)), 1, n - a)
        return F.array_join(F.concat(F.slice(words, 1, a), tail), " ")

    trimmed = F.regexp_replace(text, f"^{_SPACES}|{_SPACES}$", "")
    changed = let(F.split(trimmed, _SPACES, -1), tailed)
    return F.when((h % 10 == 0) & (trimmed != ""), changed).otherwise(text)


def _judge(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [b"" if t is None else t.encode() for t in batch.columns[-1].to_pylist()]
    words = [t.split() for t in texts]  # of bytes: at the six white spaces of ASCII
    sizes = np.array([len(w) for w in words], np.int64)
    classes = np.array([int(n).bit_length() for n in sizes.tolist()])
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for size in np.unique(classes[classes > 2]).tolist():  # texts of like length share one problem
        own = np.flatnonzero(classes == size)
        flat = pa.array([w for i in own.tolist() for w in words[i]], pa.large_binary())
        codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text, *found = runs_of(codes, sizes[own])
        for t, *run in zip(text.tolist(), *[f.tolist() for f in found]):
            runs[own[t]].append(tuple(run))
    best, collapsed = [], []
    for own, found in zip(words, runs):
        top = None
        left = np.ones(len(own) + 1, bool)
        for start, length, period in found:
            if top is None or length * top[2] > top[1] * period:
                top = (start, length, period)
            left[start + period : start + length] = False
        best.append(top)
        collapsed.append(b" ".join(own if top is None else [own[i] for i in np.flatnonzero(left[:-1]).tolist()]))
    as_rows = lambda run: dict(zip(RUN.names, run))
    added = [
        pa.array(sizes, pa.int64()),
        pa.array([[as_rows(r) for r in found] for found in runs], pa.list_(_RUN)),
        pa.array([None if r is None else as_rows(r) for r in best], _RUN),
        pa.array(collapsed, pa.binary()).cast(pa.string()),
    ]
    columns = [*batch.columns[:-1], *added]
    return pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])


def runs_of(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, start, length and period of all runs, of texts that lie end to end."""
    begins = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    names, order = _names(text * (int(codes.max()) + 1) + codes, int(sizes.max()) // EXPONENT)
    # A range of the suffix array stays within one text, so places within texts will do.
    tree = SuccessorTree(order - begins[text[order]], max(1, int(sizes.max() - 1).bit_length()))
    found = []
    for k, name in enumerate(names):
        block = 1 << k
        counts = np.bincount(name, minlength=len(name))
        at = np.arange(0, len(name) - block + 1, block)
        at = at[counts[name[at]] > 1]
        found += _block_runs(names, tree, at, counts, begins[text[at]], k)
    start, end, period = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.ones(len(start), bool)  # the first, so the least period of equal stretches
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    return text[start], start - begins[text[start]], end - start, period


def _names(keys: np.ndarray, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Names of all stretches of 1, 2, 4 ... ``longest`` words, and the suffixes sorted by them.

    A name is the first place of its stretch among the sorted suffixes.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    name = np.empty(n, np.int64)
    name[order] = _first_places(keys[order], np.arange(n))
    names, step = [name], 1
    while 2 * step <= longest:
        counts = np.bincount(name, minlength=n)
        places = np.flatnonzero(counts[name[order]] > 1)
        if not len(places):
            break
        own = order[places]
        after = np.where(own + step < n, name[np.minimum(own + step, n - 1)] + 1, 0)
        key = name[own] * (n + 1) + after
        sort = np.argsort(key, kind="stable")
        own = own[sort]
        order[places] = own
        name = name.copy()
        name[own] = _first_places(key[sort], places)
        names.append(name)
        step *= 2
    return names, order


def _first_places(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each of the sorted keys the place of the first equal one."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return places[np.flatnonzero(new)[np.cumsum(new) - 1]]


class SuccessorTree:
    """A wavelet tree over a sequence, as one bit vector with counts per bit of a value."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            ones = np.zeros(len(bit) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((level, ones, len(bit) - int(ones[-1])))
            values = np.concatenate([values[~bit], values[bit]])
        self.bits = bits

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values in places low .. high are less than ``value``."""
        value = np.minimum(value, 1 << self.bits)
        whole = value == 1 << self.bits
        found = np.where(whole, high - low, 0)
        for level, ones, zeros in self.levels:
            bit = (value >> level & 1).astype(bool)
            a, b = ones[low], ones[high]
            found += np.where(bit & ~whole, (high - low) - (b - a), 0)
            low, high = np.where(bit, zeros + a, low - a), np.where(bit, zeros + b, high - b)
        return found

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th least value (from 0) in places low .. high."""
        value = np.zeros(len(low), np.int64)
        for _, ones, zeros in self.levels:
            a, b = ones[low], ones[high]
            none = (high - low) - (b - a)
            bit = n >= none
            n = np.where(bit, n - none, n)
            value = value << 1 | bit
            low, high = np.where(bit, zeros + a, low - a), np.where(bit, zeros + b, high - b)
        return value


def _block_runs(
    names: list[np.ndarray], tree: SuccessorTree, at: np.ndarray, counts: np.ndarray, begin: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Starts, ends and periods of runs that the blocks of 2^k words at ``at`` lead to."""
    block = 1 << k
    low = names[k][at]
    high = low + counts[low]
    place = at - begin
    first = tree.below(low, high, place + block)  # occurrences before the window
    n = tree.below(low, high, place + 2 * block) - first
    met = np.flatnonzero(n > 0)
    at, begin, low, high, first, n = (x[met] for x in (at, begin, low, high, first, n))
    next_at = begin + tree.nth(low, high, first)
    last_at = begin + tree.nth(low, high, first + n - 1)
    few, two, many = (np.flatnonzero(x) for x in (n <= 2, n == 2, n > 2))
    step = (last_at[many] - next_at[many]) // (n[many] - 1)
    end = at[many] + step + _equal(names, at[many], at[many] + step)
    far = next_at[many] + step + _equal(names, next_at[many], next_at[many] + step)
    starts = np.concatenate([at[few], at[two], at[many]])
    periods = np.concatenate([next_at[few] - at[few], last_at[two] - at[two], far - end])
    fits = (periods >= block) & (periods < 2 * block)
    starts, periods = starts[fits], periods[fits]
    after = starts + periods + _equal(names, starts, starts + periods)
    before = starts - _equal_before(names, starts, starts + periods)
    whole = after - before >= np.maximum(LENGTH, EXPONENT * periods)
    return [(before[whole], after[whole], periods[whole])]


def _equal(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For how many words the stretches from ``a`` and from ``b``, further on, are equal."""
    n, total = len(names[0]), np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):  # in steps of the longest names, as long as they are equal
        x, y = a[live] + total[live], b[live] + total[live]
        inside = y < n
        same = inside & (names[-1][np.where(inside, x, 0)] == names[-1][np.where(inside, y, 0)])
        live = live[same]
        total[live] += 1 << len(names) - 1
    for k in range(len(names) - 2, -1, -1):
        x, y = a + total, b + total
        inside = y < n
        total[inside & (names[k][np.where(inside, x, 0)] == names[k][np.where(inside, y, 0)])] += 1 << k
    return total


def _equal_before(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For how many words the stretches that end before ``a`` and ``b`` are equal."""
    total = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x, y = (z[live] - total[live] - (1 << len(names) - 1) for z in (a, b))
        inside = x >= 0
        live = live[inside & (names[-1][np.where(inside, x, 0)] == names[-1][np.where(inside, y, 0)])]
        total[live] += 1 << len(names) - 1
    for k in range(len(names) - 2, -1, -1):
        x, y = a - total - (1 << k), b - total - (1 << k)
        inside = x >= 0
        total[inside & (names[k][np.where(inside, x, 0)] == names[k][np.where(inside, y, 0)])] += 1 << k
    return total
