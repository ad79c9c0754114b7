"""Phrase collocations per language, counted through broadcast double-array tries.

Texts become shards of word numbers, at most ``SHARD`` words each, with a gap between pieces.
A phrase of k + 1 words is a candidate only if its first k and its last k words are frequent;
of these, each shard names the pairs of states and words it holds and how often, and a pair whose
sum stays below the least count goes.  No frequent phrase can be missed so.

The candidates of a length are cut into blocks of about ``BLOCK``.  Each block is a level of
a trie, kept as a double array (base and check) over the block's own states and words, and
broadcast alone.  numpy moves the states of all places of a shard at once, counts the
places of each accepting state, and Spark sums the shards.

Text is split at ``[.,;:!?]`` and line ends into pieces, and those at blanks and tabs into words;
A-Z count as a-z.  A null text has no words, a null language is ``und``.  Repeated rows
count each time; ids and other columns are not looked at.  Ties go by count, then phrase.  A
text of any length is taken whole: one task holds it.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickshop.llm.common import prepare, text_bytes, work_dir, written

SHARD = 1 << 19
BLOCK = 1 << 20
LEAST = 100
LONGEST = 5
TOP = 2_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~_BREAK
_IN_WORD[[0x20, 0x09]] = False
_GAP = -1
_AT_ONCE = 1 << 16
_HELD = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FAN = 64


def collocations(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """The ``top`` phrases of each language by association, with their counts."""
    spark = documents.sparkSession
    prepare(spark, share=4)
    shards = _shards(documents, shard)
    words = _word_counts(shards)
    totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    places, phrases = _encode(shards, words.filter(F.col("f") >= least), block)
    levels = [phrases]
    for size in range(1, longest):
        counted = _next_level(places, size, least, block)
        if counted is None:
            break
        places, edges = counted
        levels.append(_spelled(edges, levels[-1], levels[0], size + 1))
    frequent = levels[0]
    for level in levels[1:]:
        frequent = frequent.unionByName(level)
    return _ranked(frequent.drop("id"), totals, top)


def _tokens(texts: pa.Array, langs: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, with their language before them, and their places; gaps are -1."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    if not len(starts):
        return pa.array([], pa.string()), np.empty(0, np.int32)
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    letters = data[inside[1:-1]]
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    spelled = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(letters)]
    ).dictionary_encode()
    row = np.searchsorted(offsets, starts, side="right") - 1
    known = langs.fill_null("und").dictionary_encode()
    pair = known.indices.to_numpy(zero_copy_only=False)[row].astype(np.int64) * len(spelled.dictionary)
    pair += spelled.indices.to_numpy(zero_copy_only=False)
    own, codes = np.unique(pair, return_inverse=True)
    lang, word = np.divmod(own, len(spelled.dictionary))
    entries = pc.binary_join_element_wise(
        known.dictionary.cast(pa.string()).take(pa.array(lang)), spelled.dictionary.cast(pa.string()).take(pa.array(word)), " "
    )
    piece = np.cumsum(_BREAK[data])[starts] + row
    gaps = np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
    out = np.full(len(starts) + gaps[-1] + 1, _GAP, np.int32)
    out[np.arange(len(starts)) + gaps] = codes
    return entries, out


def _shards(documents: DataFrame, shard: int) -> DataFrame:
    """Rows of at most about ``shard`` words: codes of all places, distinct words, their counts."""

    def row(held: list[tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
        merged = pa.concat_arrays([e for e, _ in held]).dictionary_encode()
        again, at, codes = merged.indices.to_numpy(zero_copy_only=False), 0, []
        for entries, places in held:
            codes.append(np.where(places < 0, _GAP, again[at : at + len(entries)][places]).astype(np.int32))
            at += len(entries)
        places = np.concatenate(codes)
        counts = np.bincount(places[places >= 0], minlength=len(merged.dictionary))
        lists = [pa.array([0, len(counts)], pa.int32()), merged.dictionary.cast(pa.string())]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([_packed(places)], pa.binary()),
                pa.ListArray.from_arrays(*lists),
                pa.ListArray.from_arrays(lists[0], pa.array(counts, pa.int64())),
            ],
            names=["codes", "entries", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        size = 0
        for batch in batches:
            entries, places = _tokens(batch.column(0), batch.column(1))
            if not len(entries):
                continue
            if held and size + len(places) > shard:
                yield row(held)
                held, size = [], 0
            held.append((entries, places))
            size += len(places)
        if held:
            yield row(held)

    rows = documents.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    return written(rows.mapInArrow(run, "codes binary, entries array<string>, counts array<long>"), "shards")


def _word_counts(shards: DataFrame) -> DataFrame:
    each = shards.select(F.inline(F.arrays_zip("entries", "counts")))
    summed = each.groupBy("entries").agg(F.sum("counts").alias("f"))
    word = F.substring_index("entries", " ", -1)
    lang = F.left("entries", F.length("entries") - F.length(word) - 1)
    return written(summed.select(lang.alias("lang"), word.alias("word"), "f"), "words")


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte place by byte place, so that the many high zeros pack to nothing."""
    width = numbers.dtype.itemsize
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + len(numbers).to_bytes(8, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    width, n = packed[0], int.from_bytes(packed[1:9], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(packed[9:], decompressed_size=width * n), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"i{width}").reshape(-1)


def _blocks(df: DataFrame, columns: list[str], block: int) -> Iterator[tuple[pa.Table, bool]]:
    """``df`` in parts of about ``block`` rows, by hash, and if one is the last; each part alone reaches the driver."""
    parts = math.ceil(df.count() / block)
    for part in range(parts):
        table = df.filter(F.pmod(F.xxhash64(*columns), F.lit(parts)) == part).toArrow()
        if len(table):
            yield table, part == parts - 1


def _encode(shards: DataFrame, frequent: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Places as numbers of frequent words (0: none), and these words by number."""
    spark = shards.sparkSession
    coded = shards.select("codes", "entries", F.lit(None).cast("binary").alias("words"))
    path, first = work_dir(spark, "vocabulary"), 1
    _empty(spark, "id long, lang string, phrase string, size int, f long").write.parquet(path)
    for table, _ in _blocks(frequent, ["lang", "word"], block):
        if first > 1:  # one block's workers at a time
            coded = written(coded, "numbered")
        entries = pc.binary_join_element_wise(*[table[c].combine_chunks().cast(pa.string()) for c in ("lang", "word")], " ")
        numbers = pa.array(np.arange(first, first + len(table)), pa.int64())
        level = pa.table([numbers, table["lang"], table["word"], table["f"]], ["id", "lang", "phrase", "f"])
        found = spark.createDataFrame(level).withColumn("size", F.lit(1))
        found.select("id", "lang", "phrase", "size", "f").write.mode("append").parquet(path)
        coded = coded.mapInArrow(_numbered(spark.sparkContext.broadcast((entries, first))), coded.schema)
        first += len(table)
    places = written(coded.select("words"), "places")
    return places.select("words", F.col("words").alias("states")), spark.read.parquet(path)


def _numbered(block: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, first = block.value
        for batch in batches:
            found = pc.index_in(batch.column(1).flatten(), value_set=known)
            numbers = np.append(pc.add(found.cast(pa.int64()), first).fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int32)
            at, rows = 0, []
            for (codes, held), size in zip(_arrays(batch, 0, 2), pc.list_value_length(batch.column(1)).to_pylist()):
                words = numbers[np.where(codes < 0, len(numbers) - 1, codes + at)]  # the last one is for gaps
                rows.append(_packed(np.maximum(words, held)))
                at += size
            columns = [batch.column(0), batch.column(1), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


class DoubleArray:
    """A level of a trie: from a state by a word to the edge's number, in order of ``keys``.

    A key is a state times 2^32 plus a word.  Rows of edges are laid over each other, widest
    first, at random bases; edges of states with one word fill the places left.
    """

    def __init__(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        self.keys = keys
        self.states, rows = np.unique((keys >> 32).astype(np.int32), return_inverse=True)
        self.words, symbols = np.unique((keys & 0xFFFFFFFF).astype(np.int32), return_inverse=True)
        self.base = np.zeros(len(self.states), np.int64)
        degrees = np.bincount(rows, minlength=len(self.states))
        firsts = np.cumsum(degrees) - degrees
        width = len(self.words)
        size = 2 * len(keys) + width
        free = np.ones(size, bool)
        owner = np.full(size, -1, np.int64)
        random = np.random.default_rng(1)
        for degree in np.unique(degrees[degrees > 1])[::-1].tolist():
            pending = np.flatnonzero(degrees == degree)
            edges = symbols[firsts[pending][:, None] + np.arange(degree)]
            rounds = 0
            while len(pending):
                rounds += 1
                if rounds % 32 == 0:
                    free = np.concatenate([free, np.ones(size, bool)])
                    owner = np.concatenate([owner, np.full(size, -1, np.int64)])
                    size *= 2
                base = random.integers(0, size - width + 1, len(pending))
                at = base[:, None] + edges
                fits = free[at].all(axis=1)
                owner[at[fits]] = np.flatnonzero(fits)[:, None]  # of rows that meet, one wins
                won = fits & (owner[at] == np.arange(len(pending))[:, None]).all(axis=1)
                self.base[pending[won]] = base[won]
                free[at[won]] = False
                pending, edges = pending[~won], edges[~won]
        single = np.flatnonzero(degrees == 1)
        self.base[single] = np.flatnonzero(free)[: len(single)] - symbols[firsts[single]]
        at = self.base[rows] + symbols
        self.check = np.full(size, -1, np.int32)
        self.target = np.zeros(size, np.int32)
        self.check[at] = rows
        self.target[at] = np.arange(len(keys))

    def step(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The edges' numbers, -1 where there is none, for all places."""
        out = np.full(len(states), -1, np.int32)
        for at in range(0, len(states) if len(self.keys) else 0, _AT_ONCE):
            self._step(states[at : at + _AT_ONCE], words[at : at + _AT_ONCE], out[at : at + _AT_ONCE])
        return out

    def _step(self, states: np.ndarray, words: np.ndarray, out: np.ndarray) -> None:
        row = np.minimum(np.searchsorted(self.states, states), len(self.states) - 1)
        symbol = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        own = np.flatnonzero((self.states[row] == states) & (self.words[symbol] == words))
        slot = self.base[row[own]] + symbol[own]
        inside = (slot >= 0) & (slot < len(self.check))
        own, slot = own[inside], slot[inside]
        met = self.check[slot] == row[own]
        out[own[met]] = self.target[slot[met]]


def _steps(words: np.ndarray, states: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places with a frequent phrase of ``size`` words there and one word on; state and next word."""
    if len(words) <= size:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    at = np.flatnonzero((states[:-size] > 0) & (states[1 : len(states) - size + 1] > 0))
    return at, states[at], words[at + size]


def _arrays(batch: pa.RecordBatch, *columns: int) -> Iterator[list[np.ndarray]]:
    """Rows of packed numbers; a null stands for as many zeros as the first column has numbers."""
    for row in zip(*[batch.column(c) for c in columns]):
        given = [None if x.as_py() is None else _unpacked(x.as_py()) for x in row]
        size = 0 if given[0] is None else len(given[0])
        yield [np.zeros(size, np.int32) if x is None else x for x in given]


def _next_level(places: DataFrame, size: int, least: int, block: int) -> tuple[DataFrame, DataFrame] | None:
    """Places with states of one word more, and the edges to them; None without any."""
    spark = places.sparkSession
    path, first = work_dir(spark, "edges"), 1
    moved = places.withColumn("next", F.lit(None).cast("binary"))
    for table, last in _blocks(_candidates(places, size, least), ["key"], block):
        if first > 1:  # one block's workers at a time
            moved = written(moved, "moved")
        trie = DoubleArray(table["key"].to_numpy())
        moved = moved.mapInArrow(_advanced(spark.sparkContext.broadcast(trie), first, size, last), moved.schema)
        ids = pa.array(np.arange(first, first + len(trie.keys)))
        edges = pa.table([ids, pa.array(trie.keys >> 32), pa.array(trie.keys & 0xFFFFFFFF)], ["id", "state", "word"])
        spark.createDataFrame(edges).write.mode("append").parquet(path)
        first += len(trie.keys)
    if first == 1:
        return None
    places = written(moved.select("words", F.col("next").alias("states")), "places")
    return places, spark.read.parquet(path).join(_counts(places).filter(F.col("f") >= least), "id")


def _candidates(places: DataFrame, size: int, least: int) -> DataFrame:
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def told(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """The shard's keys, summed where they come from, in one packed row a part."""
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        part = ((keys.astype(np.uint64) * _ODD >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        ends = np.cumsum(np.bincount(part, minlength=parts))
        for i, own in enumerate(np.split(order, ends[:-1])):
            if len(own):
                yield _vectors(i, _packed(np.diff(keys[own], prepend=0)), _packed(counts[own]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for words, states in _arrays(batch, 0, 1):
                _, state, word = _steps(words, states, size)
                held.append(state.astype(np.int64) << 32 | word)
                if sum(map(len, held)) >= _HELD:
                    yield from told(held)
                    held = []
        if held:
            yield from told(held)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The frequent keys of a partition, whose parts come from all shards."""
        held = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for batch in batches:
            for keys, counts in zip(batch.column(1), batch.column(2)):
                held.append((np.cumsum(_unpacked(keys.as_py())), _unpacked(counts.as_py())))
                if sum(len(k) for k, _ in held[1:]) >= max(_HELD, len(held[0][0])):
                    held = [_summed_keys(held)]
        keys, counts = _summed_keys(held)
        keys = keys[counts >= least]
        for at in range(0, len(keys), _AT_ONCE):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + _AT_ONCE])], names=["key"])

    told_of = places.mapInArrow(run, "part long, keys binary, hits binary")
    return written(told_of.repartition(parts, "part").mapInArrow(merged, "key long"), "candidates")


def _vectors(part: int, *vectors: bytes) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int64()), *[pa.array([v], pa.binary()) for v in vectors]]
    return pa.RecordBatch.from_arrays(columns, names=["part", "keys", "hits"][: len(columns)])


def _summed_keys(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys, kind="stable")
    keys, sums = keys[order], np.concatenate([[0], np.cumsum(counts[order])])
    last = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)[: len(keys)])
    return keys[last], np.diff(sums[last + 1], prepend=0)


def _advanced(trie: Broadcast, first: int, size: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = [], []
            for words, states, held in _arrays(batch, 0, 1, 2):
                at, state, word = _steps(words, states, size)
                edges = trie.value.step(state, word)
                after = held.copy()
                after[at[edges >= 0]] = edges[edges >= 0] + first
                if last:  # only words that a live state may take next
                    own = _steps(words, after, size + 1)[0] + size + 1
                    left = np.zeros_like(words)
                    left[own] = words[own]
                    words = left
                kept.append(_packed(words))
                rows.append(_packed(after))
            columns = [pa.array(kept, pa.binary()), batch.column(1), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many places accept each state, as vectors of ``_AT_ONCE`` states."""
    hits = np.zeros(0, np.int64)
    for batch in batches:
        for (states,) in _arrays(batch, 1):
            more = np.bincount(states, minlength=len(hits))
            more[: len(hits)] += hits
            hits = more
    hits[:1] = 0  # no state
    for part in range(0, len(hits), _AT_ONCE):
        yield _vectors(part // _AT_ONCE, hits[part : part + _AT_ONCE].tobytes())


def _summed(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            hits = np.frombuffer(data.as_buffer(), np.int64)
            total = sums.setdefault(part, np.zeros(_AT_ONCE, np.int64))
            total[: len(hits)] += hits
    return sums


def _counts(places: DataFrame) -> DataFrame:
    """Each state's places: vectors of tasks, summed in two rounds."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, total in _summed(batches).items():
            yield _vectors(part, total.tobytes())

    def twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, total in _summed(batches).items():
            own = np.flatnonzero(total)
            rows = [pa.array(own + part * _AT_ONCE, pa.int64()), pa.array(total[own], pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, names=["id", "f"])

    vectors = places.mapInArrow(_accepted, "part long, keys binary").withColumn("salt", F.spark_partition_id() % _FAN)
    salted = vectors.repartition("part", "salt").select("part", "keys").mapInArrow(once, "part long, keys binary")
    return salted.repartition("part").mapInArrow(twice, "id long, f long")


def _spelled(edges: DataFrame, before: DataFrame, words: DataFrame, size: int) -> DataFrame:
    start = before.select(F.col("id").alias("state"), "lang", "phrase")
    end = words.select(F.col("id").alias("word"), F.col("phrase").alias("added"))
    both = edges.join(start, "state").join(end, "word")
    spelled = F.concat_ws(" ", "phrase", "added").alias("phrase")
    return written(both.select("id", "lang", spelled, F.lit(size).alias("size"), "f"), "phrases")


def _ranked(frequent: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    phrases = frequent.filter(F.col("size") > 1).withColumnRenamed("f", "a")
    words = F.split("phrase", " ", -1)
    part = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    # A phrase inside a much longer one with its count lies in one a word longer with it, too.
    longer = phrases.filter(F.col("size") > 2)
    shorter = longer.select("lang", F.col("a"), F.explode(F.array(part(1, F.col("size") - 1), part(2, F.col("size") - 1))).alias("phrase"))
    kept = phrases.join(shorter, ["lang", "phrase", "a"], "left_anti")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", part(1, F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    wide = {c: f"cast({c} as decimal(18,0))" for c in "alrn"}
    # Products of two counts are below 10^36, and 1000 of them below 10^38 up to 10^17 words.
    score = F.expr(f"(cast({wide['a']} * {wide['n']} as decimal(35,0)) * 1000bd) div (cast({wide['l']} * {wide['r']} as decimal(38,0)))")
    scored = scored.withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
