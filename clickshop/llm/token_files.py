"""Token ids as binary files: frequency-ranked ids in byte-aligned variable-length coding.

``encode`` gives each document's ids.  ``write_ids`` counts the ids, numbers them by
falling frequency and writes files in ascending ``doc_id`` order; ``read_ids`` reads them
back through Spark's ``binaryFile`` source, so any file system that Spark reaches will do.

A file is a run of blocks, each followed by one line feed (Spark's text writer adds it;
its commit protocol makes a lost task leave no half-written file).  A block holds whole
documents.  All numbers are little-endian:

    4 bytes  magic ``VB03``
    8        u64 number of ids before the block
    4 x 4    u32 documents, ids, control bytes, data bytes
    n x 8    i64 doc_id                  (n documents)
    n x 1    u8  1 where the doc_id is null
    n x 4    u32 ids of the document
    control  2 bits an id, four ids a byte, low bits first: bytes of the rank minus one;
             each document starts a new byte
    data     the ranks, 1 to 4 bytes each

Control bytes are apart from the data, so a table of the four lengths that each of the
256 control bytes stands for decodes a block without a loop.  The folder ``ranks`` beside
the files lists the id of each rank; it has one row per vocabulary entry in use.

Null and empty texts have only the end id.  Rows with a null ``doc_id`` come first, and
rows that share an id follow each other in an order fixed by their ids' hash.  An empty
table writes no file and reads back empty.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickshop.llm.common import (
    field,
    in_batches,
    mapped,
    others,
    prepare,
    text_bytes,
    work_dir,
    written,
)
from clickshop.llm.pieces import joints, numbered, spread, word_starts

MAGIC = b"VB03"
#: Ids that close a block, blocks of a file, and ids of a range of documents.
BLOCK_IDS = 1 << 16
FILE_BLOCKS = 256
RANGE_IDS = 1 << 23
#: Pieces that a worker remembers, and bytes of the longest of them.
REMEMBERED = 500_000
LONG = 64

_LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)
_HEAD = np.dtype(
    [("magic", "S4"), ("start", "<u8"), ("docs", "<u4"), ("ids", "<u4"), ("control", "<u4"), ("data", "<u4")]
)


def _byte_letters() -> np.ndarray:
    """The byte-level alphabet: printable Latin-1 bytes are themselves, others follow 255."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return np.array([b if b in printable else next(others) for b in range(256)], "<u4")


_LETTERS = _byte_letters()


class _Encoder:
    """The library's BPE model, asked only for matches in pieces that are not remembered.

    The memory is an Arrow column: its pieces and those of a batch are numbered at once,
    and no Python code looks at a known one.  Matches go to the model itself, in the
    byte-level alphabet: the tokenizer around it would split and map each of them again,
    which takes twice the time.  A text that holds an added token of the file, such as
    ``<|endoftext|>``, goes to the tokenizer whole.
    """

    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content.encode() for t in added if t.content]
        self.split = regex.compile(pattern).findall
        # What is known of pieces: their bytes, their ids end to end, the batch that last had them.
        self._pieces = pa.array([], pa.large_binary())
        self._ids = np.empty(0, np.uint32)
        self._sizes = np.empty(0, np.int64)
        self._used = np.empty(0, np.int64)
        self._batch = 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts end to end, and the texts' bounds in them."""
        own = self._with_added(data, offsets)
        if not own:
            return self._by_pieces(data, offsets)
        sizes, raw = np.diff(offsets), data.tobytes()
        rest = np.ones(len(sizes), bool)
        rest[own] = False
        flat, bounds = self._by_pieces(
            data[np.repeat(rest, sizes)], np.concatenate(([0], np.cumsum(sizes * rest)))
        )
        texts = [raw[offsets[i] : offsets[i + 1]].decode() for i in own]
        found = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        counts = np.diff(bounds)
        counts[own] = [len(ids) for ids in found]
        flat = np.insert(flat, np.repeat(bounds[own], counts[own]), np.concatenate(found))
        return flat, np.concatenate(([0], np.cumsum(counts)))

    def _with_added(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """The texts that hold an added token."""
        raw, own = data.tobytes(), set()
        for token in self._added:
            at = raw.find(token)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(token) <= offsets[i + 1]:
                    own.add(i)
                at = raw.find(token, at + 1)
        return sorted(own)

    def _by_pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = word_starts(data, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        self._batch += 1
        count = len(self._pieces)
        pieces, numbers = numbered(self._pieces, data, starts)
        if len(pieces) > count:
            flat, sizes = self._learn(*text_bytes(pieces.slice(count)))
            self._pieces = pieces
            self._ids = np.concatenate((self._ids, flat))
            self._sizes = np.concatenate((self._sizes, sizes))
            self._used = np.concatenate((self._used, np.zeros(len(sizes), np.int64)))
        self._used[numbers] = self._batch
        out = spread(self._ids, self._sizes, numbers, np.searchsorted(starts, offsets))
        self._forget()
        return out

    def _forget(self) -> None:
        """When the memory is full, keep half of it: short pieces, the last used ones."""
        count, size = len(self._pieces), self._pieces.nbytes
        if count <= REMEMBERED and size <= REMEMBERED * LONG:
            return
        _, offsets = text_bytes(self._pieces)
        kept = np.flatnonzero(np.diff(offsets) <= LONG)
        order = np.argsort(-self._used[kept], kind="stable")
        kept = np.sort(kept[order[: REMEMBERED // 2]])
        self._ids, _ = spread(self._ids, self._sizes, kept, np.zeros(1, np.int64))
        self._pieces = self._pieces.take(pa.array(kept))
        self._sizes, self._used = self._sizes[kept], self._used[kept]

    def _matches(self, data: np.ndarray, ends: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The pattern's matches in all pieces, and where each piece's begin in them.

        Pieces that keep their matches beside each other are searched as one text.
        """
        raw = data.tobytes()
        matches, at = [], 0
        for end in ends[~joints(data)[ends]].tolist():
            matches += self.split(raw[at:end].decode())
            at = end
        letters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        stops = np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
        if len(raw) and (not len(stops) or stops[-1] != letters[-1]):
            raise ValueError("the pattern leaves characters without a match")
        return matches, np.concatenate(([0], np.searchsorted(stops, letters[ends], side="right")))

    def _learn(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end, and their number for each piece."""
        matches, bounds = self._matches(data, offsets[1:])
        numbers = {m: i for i, m in enumerate(dict.fromkeys(matches))}
        encoded = [m.encode() for m in numbers]
        letters = _LETTERS[np.frombuffer(b"".join(encoded), np.uint8)].tobytes().decode("utf-32-le")
        ids, ends, at = array("I"), [0], 0
        for own in map(len, encoded):
            ids.extend([t.id for t in self.model.tokenize(letters[at : at + own])])
            ends.append(len(ids))
            at += own
        of_match = np.fromiter(map(numbers.__getitem__, matches), np.int64, len(matches))
        flat, ends = spread(np.array(ids, np.uint32), np.diff(ends), of_match, bounds)
        return flat, np.diff(ends)


_ENCODERS: dict[tuple, _Encoder] = {}


def _encoder(vocabulary: bytes, pattern: str) -> _Encoder:
    key = (hash(vocabulary), len(vocabulary), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = _Encoder(vocabulary, pattern)
    return _ENCODERS[key]


def encode(
    documents: DataFrame, tokenizer: str, pattern: str, end_id: int = 0, text: str = "text"
) -> DataFrame:
    """``documents`` with ``ids`` in place of the text: little-endian u32, the end id last.

    ``tokenizer`` is a file of the tokenizers library whose pre-tokenizer is byte-level with
    ``pattern``; it is read on the driver and broadcast, as it has the vocabulary's size.
    """
    spark = documents.sparkSession
    prepare(spark)
    vocabulary = spark.sparkContext.broadcast(Path(tokenizer).read_bytes())
    kept = others(documents, text, "ids")
    own = [field(c) for c in kept]
    schema = documents.select(*own, F.lit(b"").alias("ids")).schema

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(len(kept))
        flat, bounds = _encoder(vocabulary.value, pattern).encode(*text_bytes(column))
        out = np.insert(flat, bounds[1:], end_id).astype("<u4")
        binary = _binary(out.tobytes(), 4 * (bounds + np.arange(len(bounds))))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[: len(kept)], binary], names=[*kept, "ids"]
        )

    source = documents.select(*own, F.col(text).alias("_text"))
    return mapped(source, rows, schema)


def pack(ranks: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray, bytes, np.ndarray]:
    """Control bytes and data bytes of documents' ranks, each with the documents' bounds."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    sizes = np.diff(bounds)
    slots = np.concatenate(([0], np.cumsum(-(-sizes // 4) * 4)))
    codes = np.zeros(slots[-1], np.uint8)
    codes[np.arange(len(ranks)) + np.repeat(slots[:-1] - bounds[:-1], sizes)] = extra
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    ends = np.concatenate(([0], np.cumsum(extra + np.int64(1))))
    return control.tobytes(), slots // 4, data.tobytes(), ends[bounds]


def unpack(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranks of documents of so many ids, by table lookup of the lengths."""
    sizes = sizes.astype(np.int64)
    slots = -(-sizes // 4) * 4
    count = int(sizes.sum())
    skip = np.repeat(np.cumsum(slots) - slots - np.cumsum(sizes) + sizes, sizes)
    lengths = _LENGTHS[control].reshape(-1)[np.arange(count) + skip]
    out = np.zeros((count, 4), np.uint8)
    out[np.arange(4) < lengths[:, None]] = data
    return out.view("<u4").reshape(-1)


def _block(start: int, docs: list[tuple[int | None, int, bytes, bytes]]) -> bytes:
    doc_ids, sizes, control, data = zip(*docs)
    control, data = b"".join(control), b"".join(data)
    head = np.array([(MAGIC, start, len(docs), sum(sizes), len(control), len(data))], _HEAD)
    return b"".join(
        (
            head.tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array(sizes, "<u4").tobytes(),
            control,
            data,
        )
    )


def _blocks_of(content: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Start, doc ids, null marks, sizes and ranks of each block of a file."""
    at = 0
    while at < len(content):
        head = np.frombuffer(content, _HEAD, 1, at)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a token file")
        docs = int(head["docs"])
        at += _HEAD.itemsize
        doc_ids = np.frombuffer(content, "<i8", docs, at)
        nulls = np.frombuffer(content, np.uint8, docs, at + 8 * docs)
        sizes = np.frombuffer(content, "<u4", docs, at + 9 * docs)
        at += 13 * docs
        control = np.frombuffer(content, np.uint8, int(head["control"]), at)
        at += len(control)
        data = np.frombuffer(content, np.uint8, int(head["data"]), at)
        at += len(data) + 1  # the line feed
        yield int(head["start"]), doc_ids, nulls, sizes, unpack(control, data, sizes)


def write_ids(encoded: DataFrame, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Write ``(doc_id, ids)`` rows as token files under ``path``.

    Reads ``encoded`` several times, so it should be a written table.
    """
    spark = encoded.sparkSession
    prepare(spark)
    rows = encoded.select("doc_id", "ids", F.xxhash64("ids").alias("tie"))
    rank_of = _write_ranks(encoded, f"{path}/ranks")
    sizes = encoded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(total / RANGE_IDS))
    cuts = sizes.filter("doc_id is not null").approxQuantile(
        "doc_id", [k / parts for k in range(1, parts)], 0.1 / parts
    ) if parts > 1 else []
    cuts = sorted({int(c) for c in cuts})

    def part_of() -> F.Column:
        """How many cuts lie below the id; null ids come first."""
        return F.coalesce(
            F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("doc_id")))
            if cuts
            else F.lit(0),
            F.lit(0),
        )

    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(part_of())
    by_part = sizes.groupBy(part.alias("part")).agg(F.sum("n").alias("n")).collect()
    of_part = {r.part: r.n for r in by_part}  # one entry per range of documents
    starts = np.cumsum([0] + [of_part.get(k, 0) for k in range(len(cuts) + 1)]).tolist()
    table = spark.sparkContext.broadcast(rank_of)

    def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Documents' ids as ranks in their coding, which is what the shuffle moves."""
        raw, offsets = text_bytes(batch.column(3))
        bounds = offsets // 4
        ranks = table.value[np.frombuffer(raw.tobytes(), "<u4")]
        control, control_bounds, data, data_bounds = pack(ranks, bounds)
        columns = [
            pa.array(np.diff(bounds)),
            _binary(control, control_bounds),
            _binary(data, data_bounds),
        ]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *columns], names=["part", "doc_id", "tie", "n", "control", "data"]
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, held, count = None, [], 0
        for batch in batches:
            for own, *doc in zip(*[c.to_pylist() for c in batch.columns]):
                if start is None:
                    start = starts[own]
                held.append(doc)
                count += doc[1]
                if count >= block_ids:
                    yield _value(_block(start, held))
                    start, held, count = start + count, [], 0
        if held:
            yield _value(_block(start, held))

    def _value(block: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["value"])

    (
        rows.select(part.cast("int").alias("part"), "doc_id", "tie", "ids")
        .mapInArrow(
            in_batches(coded),
            "part int, doc_id long, tie long, n long, control binary, data binary",
        )
        .repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .select("part", "doc_id", "n", "control", "data")
        .mapInArrow(blocks, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("maxRecordsPerFile", FILE_BLOCKS)
        .text(f"{path}/blocks")
    )


def _binary(raw: bytes, bounds: np.ndarray) -> pa.Array:
    """Slices of one buffer as a binary column."""
    offsets = pa.py_buffer(bounds.astype(np.int64).tobytes())
    wide = pa.Array.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(raw)]
    )
    return wide.cast(pa.binary())


def _write_ranks(encoded: DataFrame, path: str) -> np.ndarray:
    """Count the ids, write the id of each rank, and give the rank of each id."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in batches:
            data, _ = text_bytes(batch.column(0))
            own = np.bincount(np.frombuffer(data.tobytes(), "<u4"), minlength=len(seen))
            own[: len(seen)] += seen
            seen = own
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(seen[used])], names=["id", "n"]
        )

    counted = encoded.select("ids").mapInArrow(counts, "id long, n long")
    total = counted.groupBy("id").agg(F.sum("n").alias("n"))
    # One row per vocabulary entry in use: the vocabulary bounds it, not the corpus.
    rows = sorted((-r.n, r.id) for r in total.collect())
    ids = [i for _, i in rows]
    spark = encoded.sparkSession
    spark.createDataFrame(list(enumerate(ids)), "rank long, id long").coalesce(1).write.parquet(path)
    rank_of = np.zeros(max(ids, default=0) + 1, np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)
    return rank_of


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of each document in the files under ``path``."""
    prepare(spark)
    ranks = spark.read.parquet(f"{path}/ranks").collect()  # one row per vocabulary entry
    id_of = np.zeros(len(ranks), "<u4")
    id_of[[r["rank"] for r in ranks]] = [r["id"] for r in ranks]
    table = spark.sparkContext.broadcast(id_of)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for start, doc_ids, nulls, sizes, ranks in _blocks_of(content.as_py()):
                    ids = table.value[ranks]
                    ends = np.cumsum(sizes.astype(np.int64))
                    begins = ends - sizes
                    lists = [ids[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, mask=nulls.astype(bool)),
                            pa.array(start + begins),
                            pa.array(sizes.astype(np.int64)),
                            pa.array(lists, pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    files = spark.read.format("binaryFile").load(f"{path}/blocks").select("content")
    return files.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def token_files(
    documents: DataFrame, tokenizer: str, pattern: str, path: str | None = None
) -> str:
    """Encode ``documents`` and write their token files; gives the folder."""
    path = path or work_dir(documents.sparkSession, "token-files")
    encoded = encode(documents.select("doc_id", "text"), tokenizer, pattern)
    write_ids(written(encoded, "ids"), path)
    return path
