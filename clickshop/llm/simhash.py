"""SimHash near-duplicates by multi-index hashing.

``fingerprints`` gives each text a 64-bit SimHash of its word shingles.  ``links`` cuts
the distinct fingerprints into segments: two that differ in at most ``d`` bits lie, in
some segment, within a Hamming ball of ``d // segments`` bits, so each looks up the small
ball around its own segment values and complete distances decide.  Only a spanning forest
of every table bucket leaves a task, never all its pairs.  A bucket too large for one task
is divided again: its fingerprints differ in at most ``d`` of the bits outside the segment,
so two that link agree in one of ``d + 1`` parts of these bits.  What is still too large
after some such divisions agrees in most bits, so it has few fingerprints; it is cut into
blocks and solved as pairs of blocks.  Components follow from the links.

A null or empty text has fingerprint zero and is linked like any other.  Equal texts and
repeated rows share a fingerprint.  A null ``doc_id`` never names a component unless the
whole component has none.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from clickshop.llm.common import field, free_name, in_batches, mapped, others, prepare, written
from clickshop.llm.components import stars

SEED = 42
#: Rows of a bucket that one task compares at a time.
BLOCK = 2048
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SLICE = 1 << 16
#: Ways to divide a bucket that its key tells apart.
WAYS = 1 << 12
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Fingerprints above which a component's label does not travel by a join on its root.
HOT = 100_000


def fingerprint(text: bytes, width: int = 4) -> int:
    """SimHash of the ``width``-word shingles of a UTF-8 text."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SLICE):
        spans = zip(starts[at : at + _SLICE].tolist(), ends[at : at + _SLICE].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    return int(weights[2 * ones > len(starts)].sum(dtype=np.uint64))


def fingerprints(documents: DataFrame, width: int = 4, text: str = "text") -> DataFrame:
    """``documents`` with ``fp``, the fingerprint's 64 bits as a long, in place of the text."""
    prepare(documents.sparkSession)
    kept = others(documents, text, "fp")
    own = [field(c) for c in kept]
    schema = documents.select(*own, F.lit(0).cast("bigint").alias("fp")).schema

    def prints(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(len(kept)).cast(pa.binary()).to_pylist()
        found = np.array([fingerprint(t or b"", width) for t in texts], dtype=np.uint64)
        columns = [*batch.columns[: len(kept)], pa.array(found.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=[*kept, "fp"])

    rows = documents.select(*own, F.col(text).alias("_text"))
    return mapped(rows, prints, schema)


def segment_plan(bits: int, segments: int) -> list[tuple[int, int, int]]:
    """``(shift, width, radius)`` of each segment.

    With r = bits // segments, the first ``bits % segments + 1`` segments get radius r and
    the others r - 1: more errors than that everywhere would exceed ``bits`` in total.
    """
    radius, more = divmod(bits, segments)
    edges = [round(64 * k / segments) for k in range(segments + 1)]
    plan = [
        (lo, hi - lo, radius if k <= more else radius - 1)
        for k, (lo, hi) in enumerate(zip(edges, edges[1:]))
    ]
    return [x for x in plan if x[2] >= 0]


def segments_for(count: int) -> int:
    """As many segments as make a table bucket hold a few of ``count`` fingerprints."""
    return max(2, min(4, round(64 / math.log2(max(count, 4)))))


def _probes(fps: np.ndarray, plan: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Table keys of the fingerprints and of the balls around them.

    Of two segment values within a ball, the larger looks up the smaller, so a ball's
    larger values need no row.
    """
    keys, owners = [], []
    for k, (shift, width, radius) in enumerate(plan):
        value = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        for r in range(radius + 1):
            for flips in combinations(range(width), r):
                mask = np.uint64(sum(1 << f for f in flips))
                other = value ^ mask
                take = other <= value
                keys.append(other[take] * np.uint64(len(plan)) + np.uint64(k))
                owners.append(fps[take])
    return np.concatenate(keys), np.concatenate(owners)


def _labels(groups: np.ndarray, bits: int) -> np.ndarray:
    """For groups of equal size, one per row: each member's least linked member's index."""
    distance = np.bitwise_count(groups[:, :, None] ^ groups[:, None, :])
    linked = distance <= bits
    size = groups.shape[1]
    label = np.broadcast_to(np.arange(size), groups.shape)
    while True:
        reach = np.where(linked, label[:, None, :], size).min(axis=2)
        if (reach == label).all():
            return label
        label = reach


def _forest(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all groups of equal keys, sorted by key, none above ``BLOCK``."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(starts, len(keys)))
    a, b = [], []
    for size in np.unique(sizes[sizes > 1]):
        chosen = starts[sizes == size]
        step = max(1, (BLOCK * BLOCK) // int(size * size))
        for at in range(0, len(chosen), step):
            rows = fps[chosen[at : at + step, None] + np.arange(size)]
            label = _labels(rows, bits)
            root = np.take_along_axis(rows, label, axis=1)
            moved = root != rows
            a.append(rows[moved])
            b.append(root[moved])
    if not a:
        return fps[:0], fps[:0]
    return np.concatenate(a), np.concatenate(b)


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])


def _batch(a: np.ndarray, b: np.ndarray, key: np.ndarray | None = None) -> pa.RecordBatch:
    keys = pa.nulls(len(a), pa.int64()) if key is None else pa.array(key)
    columns = [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), keys]
    return pa.RecordBatch.from_arrays(columns, schema=_LINK)


def _solve(bits: int):
    """Links of sorted ``(key, fp)`` rows; rows of groups above ``BLOCK`` pass with their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.empty(0, np.int64)
        fps = np.empty(0, np.uint64)
        passing = None  # the key of a large group whose rows pass
        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            fps = np.concatenate((fps, batch.column(1).to_numpy().view(np.uint64)))
            if not len(keys):
                continue
            if passing is not None:
                n = int(np.searchsorted(keys, passing, side="right"))
                yield _batch(fps[:n], fps[:n], keys[:n])
                keys, fps = keys[n:], fps[n:]
                if not len(keys):
                    continue
                passing = None
            last = int(np.searchsorted(keys, keys[-1]))  # its group may go on
            done = _split(keys[:last], fps[:last])
            yield from done
            keys, fps = keys[last:], fps[last:]
            if len(keys) > BLOCK:
                passing = keys[0]
                yield _batch(fps, fps, keys)
                keys, fps = keys[:0], fps[:0]
        yield from _split(keys, fps)

    def _split(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        _, inverse, sizes = np.unique(keys, return_inverse=True, return_counts=True)
        large = sizes[inverse] > BLOCK
        if large.any():
            yield _batch(fps[large], fps[large], keys[large])
            keys, fps = keys[~large], fps[~large]
        if len(keys):
            a, b = _forest(keys, fps, bits)
            yield _batch(a, b)

    return run


def _part_masks(plan: list[tuple[int, int, int]], bits: int, way: int, level: int) -> list[int]:
    """The ``bits + 1`` parts of the bits that no earlier division used."""
    chosen = []
    for _ in range(level):
        way, part = divmod(way, bits + 1)
        chosen.append(part)
    shift, width, _ = plan[way]
    free = np.array([b for b in range(64) if not shift <= b < shift + width])
    for part in reversed(chosen):
        free = np.setdiff1d(free, np.array_split(free, bits + 1)[part])
    return [sum(1 << int(b) for b in part) for part in np.array_split(free, bits + 1)]


def _divide(plan: list[tuple[int, int, int]], bits: int, level: int):
    """Rows of too large buckets under the keys of smaller ones.

    The low bits of a key tell the way of divisions that led to it.  Buckets whose keys
    collide are solved as one, which adds no link.
    """

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(0).to_numpy().view(np.uint64)
        fps = batch.column(1).to_numpy().view(np.uint64)
        way = keys % np.uint64(WAYS if level else len(plan))
        made, owners = [], []
        for w in np.unique(way).tolist():
            key, fp = keys[way == w], fps[way == w]
            for part, mask in enumerate(_part_masks(plan, bits, w, level)):
                mixed = (key ^ (fp & np.uint64(mask)) * _ODD) * _ODD
                mixed ^= mixed >> np.uint64(29)
                made.append(mixed * np.uint64(WAYS) + np.uint64(w * (bits + 1) + part))
                owners.append(fp)
        columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (made, owners)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "fp"])

    return rows


def _solve_blocks(bits: int):
    """Links between the rows of a pair of blocks, by comparing piece with piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.empty(0, object)
        fps = np.empty(0, np.uint64)
        for batch in batches:
            own = np.array(batch.column(0).to_pylist(), dtype=object)
            keys = np.concatenate((keys, own))
            fps = np.concatenate((fps, batch.column(1).to_numpy().view(np.uint64)))
            while len(keys) and keys[0] != keys[-1]:
                n = int(np.argmax(keys != keys[0]))
                yield from pieces(fps[:n])
                keys, fps = keys[n:], fps[n:]
        yield from pieces(fps)

    def pieces(group: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = np.unique(group)
        parts = [group[i : i + BLOCK // 2] for i in range(0, len(group), BLOCK // 2)]
        for i, one in enumerate(parts):
            for other in parts[i:]:
                both = one if other is one else np.concatenate((one, other))
                root = both[_labels(both[None, :], bits)[0]]
                moved = root != both
                yield _batch(both[moved], root[moved])

    return run


def links(distinct: DataFrame, bits: int = 4, segments: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints ``fp`` at most ``bits`` bits apart.

    ``distinct`` holds each fingerprint once.  Not every pair has a link of its own, but
    linked fingerprints are connected and unlinked ones never are by a false pair.
    """
    prepare(distinct.sparkSession)
    plan = segment_plan(bits, segments or segments_for(distinct.count()))

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, owners = _probes(batch.column(0).to_numpy().view(np.uint64), plan)
        columns = [pa.array(keys.view(np.int64)), pa.array(owners.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["key", "fp"])

    rows = distinct.select("fp").mapInArrow(in_batches(probe), "key long, fp long")
    found, level = [], 0
    while True:
        table = rows.repartition("key").sortWithinPartitions("key")
        solved = written(table.mapInArrow(_solve(bits), "a long, b long, key long"), "links")
        found.append(solved.filter("key is null").select("a", "b"))
        large = solved.filter("key is not null").select("key", F.col("a").alias("fp"))
        if large.isEmpty():
            return reduce(DataFrame.union, found).distinct()
        if len(plan) * (bits + 1) ** (level + 1) > WAYS:
            break
        rows = large.mapInArrow(in_batches(_divide(plan, bits, level)), "key long, fp long")
        level += 1
    blocks = large.groupBy("key").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("n"))
    own = F.pmod(F.xxhash64("fp"), F.col("n"))
    pairs = (
        large.join(blocks, "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
        .select(
            F.concat_ws(
                ":", "key", F.least("own", "other"), F.greatest("own", "other")
            ).alias("pair"),
            "fp",
        )
        .repartition("pair")
        .sortWithinPartitions("pair")
    )
    more = pairs.mapInArrow(_solve_blocks(bits), "a long, b long, key long")
    return reduce(DataFrame.union, [*found, more.select("a", "b")]).distinct()


def near_duplicates(
    documents: DataFrame, bits: int = 4, width: int = 4, segments: int | None = None
) -> DataFrame:
    """``documents`` without the text, with ``fp``, ``root`` and ``component_id``.

    ``root`` names the component by its least fingerprint, ``component_id`` by its least
    ``doc_id``.  These replace columns of the same names.
    """
    own = [field(c) for c in others(documents, "fp", "root", "component_id")]
    prints = written(fingerprints(documents.select(*own), width), "fingerprints")
    distinct = written(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints"
    )
    roots = stars(links(distinct, bits, segments))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    return prints.join(_labelled(named), "fp")


def _labelled(named: DataFrame) -> DataFrame:
    """``(fp, root, component_id)`` of ``(fp, first, root)``, least ``first`` of each root.

    Labels of large components are broadcast: there is at most one for each ``HOT``
    fingerprints.  Their rows take a key that spreads them through the join of the others.
    """
    least = named.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("n"))
    hot = least.filter(F.col("n") > HOT).select("root", F.col("least").alias("hot"), "n")
    own = least.filter(F.col("n") <= HOT).select("root", "least", F.lit(-1).alias("apart"))
    apart = F.when(F.col("n").isNull(), -1).otherwise(F.pmod(F.hash("fp"), F.lit(10_000)))
    marked = named.join(F.broadcast(hot), "root", "left").withColumn("apart", apart)
    label = F.when(F.col("n").isNull(), F.col("least")).otherwise(F.col("hot"))
    return marked.join(own, ["root", "apart"], "left").select(
        "fp", "root", label.alias("component_id")
    )


def one_per_group(documents: DataFrame, bits: int = 4, width: int = 4) -> DataFrame:
    """``documents`` with one row of each component: the least ``doc_id``, nulls last.

    Of rows that repeat the least id one stays.
    """
    row = free_name(documents, "row")
    numbered = documents.withColumn(row, F.monotonically_increasing_id())
    # The row numbers hold because both reads below are of this one written table.
    rows = written(numbered, "numbered")
    narrow = rows.select("doc_id", "text", F.col(row).alias("row"))
    grouped = near_duplicates(narrow, bits, width)
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    kept = grouped.groupBy("root").agg(F.min(rank).alias("r")).select(F.col("r.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*[field(c) for c in documents.columns])
