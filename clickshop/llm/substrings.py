"""Removal of repeated substrings by suffix sorting.

A byte goes when it lies in a ``LENGTH``-byte string that also starts in a document with a
smaller id.  Five passes, none of which holds a document set or a frequent string whole:

1. ``pack``: documents become chunks, written once as a table bucketed by chunk, so that
   the joins below move no text.
2. Every window of ``LENGTH`` bytes has a key: the least hash of the ``GRAM``-byte strings
   within it.  Equal windows have equal keys, and neighbours mostly share one, so a chunk
   has few distinct keys.  Keys go to parts of the key space, each key once per chunk, and
   those in two documents or more come back as marks.
3. The windows with one key are a stretch of text.  For repeated keys a chunk sends a digest
   of each distinct stretch and its least document.  Where a key has one stretch everywhere,
   its windows have nothing to be sorted against, and the least document of all decides.
4. Where stretches differ, one chunk sends the bytes of each.  A part sorts their suffixes in
   two stages; windows with common prefixes of ``LENGTH`` bytes form classes, and the least
   document of each class decides.
5. What was decided comes back to the chunk, one byte for a stretch or window, and cuts its
   documents.

A string in many chunks costs each of them a digest, however many there are.  A key with more
than ``HOT_CHUNKS`` different stretches is split: its windows travel one by one under digests
of their own, so no task gets a frequent string with all its surroundings.  Keys only bring
windows together; digests have 64 bits beside the key's 48.

Null and empty texts have no windows.  A null ``doc_id`` counts as larger than any other
and never as smaller.  Rows of one ``doc_id`` remove nothing from each other.  An empty
table gives an empty result.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickshop.llm.common import in_batches, prepare, text_bytes, work_dir, written
from clickshop.llm.two_stage import Strings

LENGTH = 50
GRAM = 24
#: Different stretches of one key, each sent by a chunk, that are sorted together at most.
HOT_CHUNKS = 256
#: Longer stretches have their digest from the library.
LONG = 128
#: Text of a bucket of chunks, and the most buckets that Spark makes unless told otherwise.
BUCKET_BYTES, MOST_BUCKETS = 8 << 20, 100_000
#: Bytes of keys in one part, and of stretches sorted at a time.
PART_BYTES = 8 << 20
SORT_BYTES = 1 << 20
#: Bytes of stretches that a chunk sends at a time.
SENT_BYTES = 4 << 20
#: A window key per so many bytes, about; it only sizes the parts.
BYTES_PER_KEY = 13

_NO_ID = np.iinfo(np.int64).max
_A, _B, _C, _D = (
    np.uint64(x)
    for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
)
_SLICE = 1 << 18

#: What a chunk is told, and of an entry: nothing, an earlier document has all of it, its bytes
#: are wanted, its bytes come from another chunk, its windows are wanted one by one.
_MARKS, _CODES, _SORTED, _WINDOWS = range(4)
_NOTHING, _EARLIER, _WANTED, _SHARED, _HOT = range(5)


class Chunk:
    """Texts end to end, and the keys of their windows."""

    def __init__(self, ids: bytes, sizes: bytes, blob: bytes) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, np.int64))))
        self.blob = blob

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of windows of a text with one key: first window, past the last, key, document."""
        n = len(self.blob) - LENGTH + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
        first = self.offsets[:-1]
        begins, keys = [], []
        for at in range(0, n, _SLICE):
            stop = min(at + _SLICE, n)
            least = _least_hashes(self.blob, at, stop)
            edge = np.ones(stop - at, bool)
            np.not_equal(least[1:], least[:-1], out=edge[1:])
            edge[first[np.searchsorted(first, at) : np.searchsorted(first, stop)] - at] = True
            edge = np.flatnonzero(edge)
            begins.append(at + edge)
            keys.append(least[edge])
        begin, key = np.concatenate(begins), np.concatenate(keys)
        per_text = np.diff(np.append(np.searchsorted(begin, first), len(begin)))
        # The windows of a text end before the next one begins.
        end = np.minimum(np.append(begin[1:], n), np.repeat(self.offsets[1:] - LENGTH + 1, per_text))
        keep = np.flatnonzero(begin < end)
        return begin[keep], end[keep], key[keep], np.repeat(self.ids, per_text)[keep]

    def by_key(self) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        """The runs in the order of their keys, and where each key begins."""
        runs = self.runs()
        order = np.argsort(runs[2], kind="stable")
        runs = tuple(x[order] for x in runs)
        return runs, np.flatnonzero(_edges(runs[2]))

    def digests(self, begin: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
        """A 64-bit digest of the ``size`` bytes, at least ``LENGTH``, from each ``begin`` on."""
        h = seed ^ size.astype(np.uint64) * _D
        if not len(h):
            return h
        words = np.ndarray(len(self.blob) - 7, "<u8", self.blob, strides=(1,))
        for k in range(LONG // 8):
            if 8 * k + 8 <= LENGTH:
                h = _mixed(h, words[begin + 8 * k])
                continue
            on = np.flatnonzero(size >= 8 * k + 8)
            if not len(on):
                break
            h[on] = _mixed(h[on], words[begin[on] + 8 * k])
        h = _mixed(h, words[begin + size - 8])
        for i in np.flatnonzero(size > LONG).tolist():
            own = hashlib.blake2b(self.blob[begin[i] : begin[i] + size[i]], digest_size=8).digest()
            h[i] ^= np.uint64(int.from_bytes(own))
        return h


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * _A
    h ^= h >> np.uint64(32)
    h *= _B
    return h ^ (h >> np.uint64(29))


def _edges(*ordered: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    edge = np.ones(len(ordered[0]), bool)
    edge[1:] = False
    for x in ordered:
        edge[1:] |= x[1:] != x[:-1]
    return edge


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` numbers from each ``begin`` on, end to end."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Entries:
    """Runs with equal bytes are one entry; entries in the order of key and digest.

    Only ``digested`` ones all have their digest; it orders the others where they share a key.
    """

    def __init__(
        self, chunk: Chunk, begin: np.ndarray, end: np.ndarray, key: np.ndarray, doc: np.ndarray, digested: bool
    ) -> None:
        order = np.argsort(key, kind="stable")
        begin, end, key, doc = (x[order] for x in (begin, end, key, doc))
        edge = _edges(key)
        tied = np.flatnonzero(~edge | ~np.append(edge[1:], True))
        digest = np.zeros(len(key), np.uint64)
        some = slice(None) if digested else tied
        digest[some] = chunk.digests(begin[some], (end - begin)[some] + LENGTH - 1, key[some])
        by = tied[np.lexsort((digest[tied], key[tied]))]
        for x in (begin, end, doc, digest):
            x[tied] = x[by]
        edge |= _edges(digest)
        self.begin, self.end, self.doc = begin, end, doc
        self.of = np.cumsum(edge) - 1  # each run's entry
        self.first = np.flatnonzero(edge)
        self.key, self.digest = key[edge], digest[edge]
        self.windows = (end - begin)[edge]
        self.least = np.minimum.reduceat(doc, self.first) if len(key) else doc

    def windows_of(self, chunk: Chunk, entries: np.ndarray) -> Entries:
        """The windows of some entries, each an entry under a key of its own; ``entries``: flags."""
        runs = np.flatnonzero(entries[self.of])
        count = (self.end - self.begin)[runs]
        at = _spread(self.begin[runs], count)
        seed = np.repeat(self.key[self.of[runs]], count)
        own = chunk.digests(at, np.full(len(at), LENGTH), seed * _C)
        return Entries(chunk, at, at + 1, own, np.repeat(self.doc[runs], count), False)


def _least_hashes(blob: bytes, at: int, stop: int) -> np.ndarray:
    """Key of the windows that start at ``at .. stop``: mixed least hash of their grams."""
    grams = stop - at + LENGTH - GRAM
    raw = np.ndarray(grams + 16, dtype="<u8", buffer=blob[at : at + grams + 23] + bytes(8), strides=(1,))
    h = raw[:grams] * _A
    h ^= h >> np.uint64(32)
    h += raw[8 : grams + 8]
    h *= _B
    h ^= h >> np.uint64(29)
    h += raw[16 : grams + 16]
    h *= _C
    h ^= h >> np.uint64(32)
    span, have = LENGTH - GRAM + 1, 1
    while have < span:  # least of windows of doubling length
        step = min(have, span - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    h = h[: stop - at] * _D
    return h ^ (h >> np.uint64(31))


def pack(documents: DataFrame) -> tuple[DataFrame, int]:
    """The chunk table of ``documents``, and the bytes of all texts."""
    spark = documents.sparkSession
    prepare(spark)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = text_bytes(batch.column(1))
            ids = batch.column(0).fill_null(_NO_ID).to_numpy().astype(np.int64)
            row = {
                "chunk": pa.array([number], pa.int64()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "sizes": pa.array([np.diff(offsets).tobytes()], pa.binary()),
                "blob": pa.array([data.tobytes()], pa.binary()),
            }
            number += 1
            yield pa.RecordBatch.from_pydict(row)

    source = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(total)
    name = f"chunks_{uuid.uuid4().hex}"
    (
        source.mapInArrow(chunks, "chunk long, ids binary, sizes binary, blob binary")
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", work_dir(spark, "chunks"))
        .bucketBy(buckets, "chunk")
        .saveAsTable(name)
    )
    return spark.table(name), total


def bucket_count(total: int) -> int:
    """Buckets of about ``BUCKET_BYTES`` of text; larger ones where there would be more than Spark allows.

    A bucket is read chunk by chunk, so its size bounds no memory.
    """
    return min(MOST_BUCKETS, max(1, math.ceil(total / BUCKET_BYTES)))


def _parts(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts by high bits that ordered keys lie in, and where each begins, then the end."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int32)
    begin = np.flatnonzero(_edges(part))
    return part[begin], np.append(begin, len(keys))


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Items end to end as binary values, cut where the rows end."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    data = np.ascontiguousarray(values).tobytes()
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _items(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The items of binary values end to end, and where those of each row begin, then the end."""
    kind = np.dtype(kind)
    data, offsets = text_bytes(column.combine_chunks())
    return data.view(kind), offsets // kind.itemsize


def _six(keys: np.ndarray) -> np.ndarray:
    """The high 48 bits of keys."""
    return np.ascontiguousarray((keys >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).view("V6").ravel()


def _unsixed(six: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six.view(np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _key_rows(bits: int):
    """Chunk rows to the chunk's keys, a row per part; the lowest of 48 bits says whether several documents have the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunks(batches):
            (_, _, key, doc), edge = chunk.by_key()
            if not len(edge):
                continue
            several = np.minimum.reduceat(doc, edge) != np.maximum.reduceat(doc, edge)
            keys = key[edge]
            parts, cuts = _parts(keys, bits)
            keys = keys & ~np.uint64(1 << 16) | several.astype(np.uint64) << np.uint64(16)
            columns = [pa.array(parts), pa.array(np.full(len(parts), number)), _binary(_six(keys), cuts)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "chunk", "keys"])

    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk]]:
    for batch in batches:
        for number, ids, sizes, blob in zip(
            *[batch.column(n).to_pylist() for n in ("chunk", "ids", "sizes", "blob")]
        ):
            yield number, Chunk(ids, sizes, blob)


_NOTES = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("data", pa.binary())])


def _told(table: pa.Table, cuts: np.ndarray, data: np.ndarray, schema: pa.Schema, *more: pa.Array) -> pa.Table:
    """Rows of one part with new data for each chunk, without those whose data are all zero."""
    columns = [pa.concat_arrays(table.column(n).chunks) for n in ("chunk", "part")]
    told = np.concatenate(([0], np.cumsum(data != 0)))[cuts]
    found = pa.Table.from_arrays([*columns, _binary(data, cuts), *more], schema=schema)
    return found.filter(pa.array(np.diff(told) > 0))


def _marks(table: pa.Table) -> pa.Table:
    """Of one part: which keys of each chunk are repeated."""
    six, cuts = _items(table.column("keys"), "V6")
    keys = _unsixed(six)
    _, inverse, counts = np.unique(keys >> np.uint64(1), return_inverse=True, return_counts=True)
    repeated = counts > 1
    repeated[inverse[keys & np.uint64(1) == 1]] = True
    return _told(table, cuts, repeated[inverse].astype(np.uint8), _NOTES)


class Notes:
    """What a chunk was told, by kind and part."""

    def __init__(self, notes: list[dict]) -> None:
        self.by: dict[int, list[tuple[int, bytes]]] = {}
        for note in notes:
            self.by.setdefault(note["kind"], []).append((note["part"], note["data"]))

    def of(self, kind: int, keys: np.ndarray, bits: int, counts: np.ndarray | None = None) -> np.ndarray:
        """A byte for each of the ordered ``keys``, or ``counts`` bytes; zeros where nothing was told."""
        parts, cuts = _parts(keys, bits)
        if counts is not None:
            cuts = np.concatenate(([0], np.cumsum(counts)))[cuts]
        where = dict(zip(parts.tolist(), zip(cuts[:-1].tolist(), cuts[1:].tolist())))
        flags = np.zeros(cuts[-1], np.uint8)
        for part, data in self.by.get(kind, ()):
            a, b = where[part]
            flags[a:b] = np.frombuffer(data, np.uint8)
        return flags

    def entries(self, chunk: Chunk, bits: int, digested: bool = False) -> Entries:
        """The stretches of the chunk's repeated keys."""
        (begin, end, key, doc), edge = chunk.by_key()
        repeated = self.of(_MARKS, key[edge], bits).astype(bool)
        chosen = np.flatnonzero(np.repeat(repeated, np.diff(np.append(edge, len(key)))))
        return Entries(chunk, begin[chosen], end[chosen], key[chosen], doc[chosen], digested)


def _with_notes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk, Notes]]:
    for batch in batches:
        notes = batch.column("notes")
        for i, (number, chunk) in enumerate(_chunks(iter((batch,)))):
            yield number, chunk, Notes(notes[i].as_py() or [])


def _entry_rows(bits: int, out_bits: int):
    """Chunk rows with their marks to the entries of repeated keys, a row per part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk, notes in _with_notes(batches):
            entries = notes.entries(chunk, bits, digested=True)
            if not len(entries.key):
                continue
            parts, cuts = _parts(entries.key, out_bits)
            base = int(entries.least.min())
            docs = entries.least.astype(np.uint64) - np.uint64(base % (1 << 64))  # wraps, as it does back
            docs = docs.astype(np.min_scalar_type(docs.max()))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(parts),
                    "chunk": pa.array(np.full(len(parts), number)),
                    "keys": _binary(_six(entries.key), cuts),
                    "digests": _binary(entries.digest, cuts),
                    "base": pa.array(np.full(len(parts), base)),
                    "docs": _binary(docs, cuts),
                }
            )

    return run


_MEMBER = np.dtype([("string", "<u4"), ("key", "<u4"), ("doc", "<i8")])
_CODED = _NOTES.append(pa.field("members", pa.binary()))


def _codes(hot_chunks: int):
    """Of one part: what is known of each entry, and the strings that differ under one key."""

    def run(table: pa.Table) -> pa.Table:
        six, cuts = _items(table.column("keys"), "V6")
        keys = _unsixed(six)
        digests, _ = _items(table.column("digests"), "<u8")
        doc = np.concatenate(
            [
                np.frombuffer(d, f"<u{len(d) // n}").astype(np.int64) + b
                for d, b, n in zip(*(table.column(c).to_pylist() for c in ("docs", "base")), np.diff(cuts).tolist())
            ]
        )
        order = np.lexsort((digests, keys))
        keys, digests = keys[order], digests[order]
        new_key, new_string = _edges(keys), _edges(keys, digests)
        first = np.flatnonzero(new_string)
        key = (np.cumsum(new_key) - 1)[first]  # each string's key
        string = np.cumsum(new_string) - 1  # each entry's string
        least = np.minimum.reduceat(doc[order], first)
        strings = np.bincount(key)[key]  # with that key
        code = np.where(strings == 1, _NOTHING, np.where(strings <= hot_chunks, _SHARED, _HOT)).astype(np.uint8)[string]
        code[(code == _NOTHING) & (least[string] < doc[order])] = _EARLIER
        code[first[code[first] == _SHARED]] = _WANTED
        members = np.empty(len(order), _MEMBER)
        members["string"][order], members["key"][order], members["doc"] = string, key[string], doc
        codes = np.empty(len(order), np.uint8)
        codes[order] = code
        member = (codes == _WANTED) | (codes == _SHARED)
        member_cuts = np.concatenate(([0], np.cumsum(member)))[cuts]
        return _told(table, cuts, codes, _CODED, _binary(members[member], member_cuts))

    return run


def _text_rows(bits: int, out_bits: int, sent_bytes: int):
    """Chunk rows to the bytes of wanted entries, and to the windows of hot ones; these come with documents."""

    def rows(
        number: int, chunk: Chunk, entries: Entries, chosen: np.ndarray, docs: bool
    ) -> Iterator[pa.RecordBatch]:
        parts, cuts = _parts(entries.key[chosen], out_bits)
        sizes = entries.windows[chosen] + LENGTH - 1
        volume = np.concatenate(([0], np.cumsum(sizes)))[cuts]
        data = np.frombuffer(chunk.blob, np.uint8)
        begin = 0
        while begin < len(parts):  # some parts at a time
            end = max(int(np.searchsorted(volume, volume[begin] + sent_bytes, side="right")) - 1, begin + 1)
            own, own_cuts = chosen[cuts[begin] : cuts[end]], cuts[begin : end + 1] - cuts[begin]
            size = sizes[cuts[begin] : cuts[end]]
            none = pa.nulls(end - begin, pa.binary())
            text = data[_spread(entries.begin[entries.first[own]], size)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(parts[begin:end]),
                    "chunk": pa.array(np.full(end - begin, number)),
                    "sizes": none if docs else _binary(size, own_cuts),
                    "docs": _binary(entries.least[own], own_cuts) if docs else none,
                    "text": _binary(text, volume[begin : end + 1] - volume[begin]),
                }
            )
            begin = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk, notes in _with_notes(batches):
            if not any(bytes((x,)) in data for _, data in notes.by.get(_CODES, ()) for x in (_WANTED, _HOT)):
                continue
            entries = notes.entries(chunk, bits)
            codes = notes.of(_CODES, entries.key, out_bits)
            wanted = np.flatnonzero(codes == _WANTED)
            if len(wanted):
                yield from rows(number, chunk, entries, wanted, False)
            if (codes == _HOT).any():
                windows = entries.windows_of(chunk, codes == _HOT)
                yield from rows(number, chunk, windows, np.arange(len(windows.key)), True)

    return run


_FOUND = pa.schema([("kind", pa.int32()), *_NOTES])


def _sort_part(texts: pa.Table, coded: pa.Table) -> pa.Table:
    """Of one part: which windows an earlier document has, chunk by chunk."""
    single = texts.filter(texts.column("docs").is_valid())
    texts = texts.filter(texts.column("sizes").is_valid()).sort_by("chunk")
    found = []
    if single.num_rows:
        found.append((_WINDOWS, _sort_windows(single)))
    if coded.num_rows:
        found.append((_SORTED, _sort_strings(texts, coded.sort_by("chunk"))))
    return pa.concat_tables(
        [t.add_column(0, _FOUND.field(0), pa.array(np.full(t.num_rows, kind, np.int32))) for kind, t in found]
    )


def _sort_windows(table: pa.Table) -> pa.Table:
    """Single windows: equal bytes are one class."""
    doc, cuts = _items(table.column("docs"), "<i8")
    raw = text_bytes(table.column("text").combine_chunks())[0].tobytes()
    number: dict[bytes, int] = {}
    which = np.fromiter(
        (number.setdefault(raw[a : a + LENGTH], len(number)) for a in range(0, len(raw), LENGTH)), np.int64, len(doc)
    )
    least = np.full(len(number), _NO_ID)
    np.minimum.at(least, which, doc)
    return _told(table, cuts, (least[which] < doc).astype(np.uint8), _NOTES)


def _sort_strings(texts: pa.Table, coded: pa.Table) -> pa.Table:
    """Strings that differ under one key: classes of their windows."""
    sizes, _ = _items(texts.column("sizes"), "<i8")
    raw = text_bytes(texts.column("text").combine_chunks())[0].tobytes()
    members, cuts = _items(coded.column("members"), _MEMBER)
    codes, _ = _items(coded.column("data"), "u1")
    sent = codes[(codes == _WANTED) | (codes == _SHARED)] == _WANTED  # texts come in this order
    # Strings in the order of their keys, as their numbers are.
    numbers = members["string"][sent]
    order = np.argsort(numbers)
    numbers, keys = numbers[order], members["key"][sent][order]
    owner = np.searchsorted(numbers, members["string"])
    ends = np.cumsum(sizes)
    begins, sizes = (ends - sizes)[order].tolist(), sizes[order]
    strings = [raw[a : a + n] for a, n in zip(begins, sizes.tolist())]
    least = np.full(len(strings), _NO_ID)
    np.minimum.at(least, owner, members["doc"])
    volume = np.cumsum(sizes)
    windows = sizes - LENGTH + 1
    firsts = np.cumsum(windows) - windows
    mins = np.empty(windows.sum(), np.int64)  # the least document of each window's class
    begin = 0
    while begin < len(strings):  # some keys at a time; all strings of a key together
        base = volume[begin - 1] if begin else 0
        end = max(int(np.searchsorted(volume, base + SORT_BYTES)), begin + 1)
        end = int(np.searchsorted(keys, keys[end - 1], side="right"))
        own = _classes(strings[begin:end], sizes[begin:end], least[begin:end])[1]
        mins[firsts[begin] : firsts[begin] + len(own)] = own
        begin = end
    count = windows[owner]
    earlier = mins[_spread(firsts[owner], count)] < np.repeat(members["doc"], count)
    return _told(coded, np.concatenate(([0], np.cumsum(count)))[cuts], earlier.astype(np.uint8), _NOTES)


def _classes(
    strings: list[bytes], sizes: np.ndarray, least: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The least document of every window's class, string by string, and where these begin."""
    sorted_strings = Strings(b"".join(strings), sizes)
    order = sorted_strings.suffix_array()
    order = order[sorted_strings.left[order] >= LENGTH]  # the windows
    common = sorted_strings.common_prefixes(order, LENGTH)
    edge = np.flatnonzero(common < LENGTH)
    string_of = np.searchsorted(sorted_strings.starts, order, side="right") - 1
    per_class = np.minimum.reduceat(least[string_of], edge)
    counts = sizes - LENGTH + 1
    firsts = np.cumsum(counts) - counts
    mins = np.empty(counts.sum(), np.int64)
    at = firsts[string_of] + order - sorted_strings.starts[string_of]
    mins[at] = np.repeat(per_class, np.diff(np.append(edge, len(order))))
    return firsts, mins


def _removed(chunk: Chunk, notes: Notes, bits: int, out_bits: int) -> np.ndarray:
    """Which bytes of the chunk lie in a window that an earlier document has."""
    n = len(chunk.blob)
    step = np.zeros(n + 1, np.int32)

    def remove(begin: np.ndarray, end: np.ndarray) -> None:
        np.add.at(step, begin, np.int32(1))
        np.add.at(step, end, np.int32(-1))

    if notes.by:
        entries = notes.entries(chunk, bits)
        codes = notes.of(_CODES, entries.key, out_bits)
        whole = (codes == _EARLIER)[entries.of] | (entries.doc > entries.least[entries.of])
        remove(entries.begin[whole], entries.end[whole] + LENGTH - 1)
        if _SORTED in notes.by:
            own = np.flatnonzero((codes == _WANTED) | (codes == _SHARED))
            windows = entries.windows[own]
            flags = notes.of(_SORTED, entries.key[own], out_bits, windows)
            firsts = np.zeros(len(codes), np.int64)
            firsts[own] = np.cumsum(windows) - windows
            member = np.zeros(len(codes), bool)
            member[own] = True
            runs = np.flatnonzero(member[entries.of] & ~whole)
            count = entries.windows[entries.of[runs]]
            gone = flags[_spread(firsts[entries.of[runs]], count)] == 1
            at = _spread(entries.begin[runs], count)[gone]
            remove(at, at + LENGTH)
        if (codes == _HOT).any():
            single = entries.windows_of(chunk, codes == _HOT)
            flags = notes.of(_WINDOWS, single.key, out_bits) == 1
            at = single.begin[flags[single.of] | (single.doc > single.least[single.of])]
            remove(at, at + LENGTH)
    return np.cumsum(step, dtype=np.int32)[:n] > 0


def _cut(bits: int, out_bits: int):
    """Chunk rows with their notes to one row per document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, sizes, spans, kept = [], [], [], []
        for _, chunk, notes in _with_notes(iter((batch,))):
            gone = _removed(chunk, notes, bits, out_bits)
            data = np.frombuffer(chunk.blob, np.uint8)
            for i, (a, b) in enumerate(zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist())):
                ids.append(int(chunk.ids[i]))
                sizes.append(b - a)
                mask = gone[a:b]
                if mask.any():
                    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
                    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    spans.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())])
                    kept.append(data[a:b][~mask].tobytes())
                else:
                    spans.append([])
                    kept.append(chunk.blob[a:b])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64(), mask=np.array(ids, np.int64) == _NO_ID),
                pa.array(sizes, pa.int64()),
                pa.array(spans, span),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )

    return run


def _by_chunk(notes: dict[int, DataFrame]) -> DataFrame:
    """All that each chunk was told, one row."""
    rows = [df.select("chunk", F.lit(kind).alias("kind"), "part", "data") for kind, df in notes.items()]
    return reduce(DataFrame.unionByName, rows).groupBy("chunk").agg(F.collect_list(F.struct("kind", "part", "data")).alias("notes"))


def remove_repeats(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``: removed byte spans, and the bytes that stay."""
    chunks, total = pack(documents)
    volume = max(1, 6 * total / BYTES_PER_KEY / PART_BYTES)
    bits = max(3, math.ceil(math.log2(volume)))
    out_bits = bits + 1
    keys = chunks.mapInArrow(_key_rows(bits), "part int, chunk long, keys binary")
    marks = written(keys.groupBy("part").applyInArrow(_marks, "chunk long, part int, data binary"), "marks")
    notes = {_MARKS: marks}
    entries = chunks.join(_by_chunk(notes), "chunk").mapInArrow(
        _entry_rows(bits, out_bits), "part int, chunk long, keys binary, digests binary, base long, docs binary"
    )
    coded = written(
        entries.groupBy("part").applyInArrow(
            _codes(HOT_CHUNKS), "chunk long, part int, data binary, members binary"
        ),
        "codes",
    )
    notes[_CODES] = coded
    texts = chunks.join(_by_chunk(notes), "chunk").mapInArrow(
        _text_rows(bits, out_bits, SENT_BYTES), "part int, chunk long, sizes binary, docs binary, text binary"
    )
    differ = coded.filter(F.octet_length("members") > 0)
    found = written(
        texts.groupBy("part")
        .cogroup(differ.groupBy("part"))
        .applyInArrow(_sort_part, "kind int, chunk long, part int, data binary"),
        "windows",
    )
    for kind in (_SORTED, _WINDOWS):
        notes[kind] = found.filter(F.col("kind") == kind)
    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return chunks.join(_by_chunk(notes), "chunk", "left").mapInArrow(in_batches(_cut(bits, out_bits)), schema)
