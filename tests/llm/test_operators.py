"""Parts of the operators on their own: hot groups, blocks, templates, layers, pages."""

from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import random
import zlib
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickshop.llm import bpe, common, components, decontaminate, fm_index, html_text, pieces
from clickshop.llm import reply_trees, secrets, simhash, substrings, token_files, urls
from clickshop.llm.common import text_bytes
from clickshop.llm.two_stage import Strings

from . import brute

# --- suffix sorting, FM-index, codings


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=120).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8))
def test_two_stage_order_and_common_prefixes(strings):
    own = Strings(b"".join(strings), np.array([len(s) for s in strings]))
    order = own.suffix_array()
    assert sorted(order.tolist()) == list(range(len(own.symbols)))
    text = np.searchsorted(own.starts, order, side="right") - 1
    suffixes = [strings[t][i - own.starts[t] :] for t, i in zip(text, order)]
    cut = [s[:50].ljust(50, b"\0") for s in suffixes]
    assert all(a <= b for a, b in zip(cut, cut[1:]))
    common = own.common_prefixes(order, 50)
    for a, b, n in zip(suffixes, suffixes[1:], common[1:]):
        assert a[:n] == b[:n]
        assert n == 50 or n == min(len(a), len(b)) or a[n] != b[n]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=80), st.integers(1, 4))
def test_fm_index_finds_every_occurrence(text, size):
    index = fm_index.FmIndex(np.array(text), 6, sample=4)
    patterns = np.array([[random.randint(1, 6) for _ in range(size)] for _ in range(20)])
    lo, hi = index.search(patterns)
    for p, a, b in zip(patterns.tolist(), lo, hi):
        at = sorted(index.locate(np.arange(a, b)).tolist())
        assert at == [i for i in range(len(text) - size + 1) if text[i : i + size] == p]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_packed_ranks_round_trip(ranks):
    cuts = np.array([0, len(ranks) // 3, len(ranks) // 3, len(ranks)])
    control, _, data, ends = token_files.pack(np.array(ranks, np.uint32), cuts)
    assert ends[-1] == len(data)
    back = token_files.unpack(
        np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), np.diff(cuts)
    )
    assert back.tolist() == ranks


def test_token_files_over_many_ranges(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE_IDS", 20_000)
    monkeypatch.setattr(token_files, "FILE_BLOCKS", 2)
    from public_tokenizers import PATTERN, path

    docs = spark.read.parquet(f"{small}/documents.parquet")
    encoded = token_files.encode(docs.select("doc_id", "text"), path("byte_bpe_50k.json"), PATTERN).cache()
    token_files.write_ids(encoded, str(tmp_path / "out"), block_ids=3_000)
    back = token_files.read_ids(spark, str(tmp_path / "out"))
    assert {(r.doc_id, bytes(r.ids)) for r in back.collect()} == {
        (r.doc_id, bytes(r.ids)) for r in encoded.collect()
    }
    assert len(list((tmp_path / "out" / "blocks").glob("part-*"))) > 5


# --- pieces and byte-pair encoding

TEXT = st.text(st.sampled_from(list("ab  \n\t'sté中\u3000\u00a0\u16801٣½,.#\x1c\x85🎉")), max_size=60)
MARKED = st.lists(st.one_of(TEXT, st.just("<|endoftext|>")), max_size=4).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_pieces_encode_as_the_whole_text(codec, texts):
    ids, bounds = codec.encode(*text_bytes(pa.array(texts)))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == brute.MULTI.encode_ordinary(text)
        assert codec.decode(ids[a:b].tolist()) == text.encode()


@pytest.mark.parametrize("word", ["a" * 30_000, "ab" * 3_000, "é" * 999, "—" * 100, "x"])
def test_very_long_pre_tokens(codec, word):
    assert codec.merge(word.encode()) == brute.MULTI.encode_ordinary(word)


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers as p

    return bpe.Codec(open(p.path("byte_bpe_multi_50k.tiktoken"), "rb").read(), p.PATTERN)


def test_memo_stays_bounded():
    memo = pieces.Memo(3)
    memo.put("once", 1)
    assert memo.get("once") is None
    for i in range(10):
        memo.put(i, i)
        memo.put(i, i)
        memo.get(0)
    assert memo.get(0) == 0 and memo.get(5) is None


@settings(max_examples=60, deadline=None)
@given(st.lists(MARKED, min_size=1, max_size=5))
def test_library_ids_of_pieces_are_those_of_the_text(encoder, texts):
    ids, bounds = encoder.encode(*text_bytes(pa.array(texts)))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    import public_tokenizers as p

    return token_files._Encoder(open(p.path("byte_bpe_50k.json"), "rb").read(), p.PATTERN)


SIGNS = st.text(st.sampled_from(list("ab9é×÷ß_'st.,-(\"@   \n\n\t\r\x0b½—中\u00aa\u0301\u3000\u00a0\x85\x1c\x00")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(SIGNS, min_size=1, max_size=5))
def test_library_ids_of_pieces_cut_at_signs(encoder, texts):
    ids, bounds = encoder.encode(*text_bytes(pa.array(texts)))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_white_space_learned_beside_other_pieces_keeps_its_match(encoder):
    fresh = token_files._Encoder(encoder.tokenizer.to_str().encode(), encoder.split.__self__.pattern)
    texts = ["a\n\n", "é", "b\n\n\n", "\n", "c \n ", "x", "\u3000 ", "y", "d\n\n .", "\t\t", "÷\n\n z"]
    for _ in range(2):
        ids, bounds = fresh.encode(*text_bytes(pa.array(texts)))
        for text, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == fresh.tokenizer.encode(text, add_special_tokens=False).ids
        texts.reverse()


def test_known_words_are_neither_searched_nor_encoded_again(encoder, monkeypatch):
    encoder.encode(*text_bytes(pa.array(["one two, three (four) été. five"])))

    def again(_):
        raise AssertionError("searched again")

    monkeypatch.setattr(encoder, "split", again)
    texts = ["one (four, two) three", "one two. three five, été two"]
    ids, bounds = encoder.encode(*text_bytes(pa.array(texts)))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_memory_of_pieces_stays_bounded(monkeypatch):
    import public_tokenizers as p

    own = token_files._Encoder(open(p.path("byte_bpe_50k.json"), "rb").read(), p.PATTERN)
    monkeypatch.setattr(token_files, "REMEMBERED", 8)
    for i in range(30):
        texts = [f"the word{i} of x{i}, the", None, "", "y" * 1000 * (i % 3), f"z{i - 1} of <|endoftext|>"]
        ids, bounds = own.encode(*text_bytes(pa.array(texts)))
        for text, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == own.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert len(own._pieces) <= 8 and own._pieces.nbytes <= 8 * (token_files.LONG + 8) + 8
        assert len(own._sizes) == len(own._used) == len(own._pieces) and own._sizes.sum() == len(own._ids)
    assert "the" in [x.decode() for x in own._pieces.to_pylist()]


@pytest.mark.parametrize(
    "texts",
    [
        ["a <|endoftext|> b", "plain words", "", "<|endoftext|><|endoftext|>", None, " x<|endoftext|>"],
        ["<|endoftext|>"],
        ["cut <|endof", "text|> here", "<|endoftext|", ">"],
    ],
)
def test_added_tokens_are_those_of_the_library(texts):
    import public_tokenizers as p
    from tokenizers import Tokenizer

    file = p.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    ids, bounds = token_files._Encoder(open(file, "rb").read(), p.PATTERN).encode(*text_bytes(pa.array(texts)))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize(("size", "buckets"), [(0, 1), (1, 1), (9 << 20, 2), (10 << 40, 100_000), (100 << 40, 100_000)])
def test_buckets_of_chunks_stay_within_sparks_limit(size, buckets):
    assert substrings.bucket_count(size) == buckets


@pytest.mark.parametrize(("hot", "sent"), [(4, 4 << 20), (4, 100), (256, 100)])
def test_a_text_in_many_chunks_costs_each_of_them_little(spark, monkeypatch, hot, sent):
    """What comes back to the chunks stays far below the text, though its keys are in more than ``HOT_CHUNKS`` chunks."""
    rng = random.Random(7)

    def prose(words):
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(words))

    text, line = prose(600), prose(20)
    rows = [(i, text) for i in range(40)] + [(100 + i, f"{prose(8)} {line} {prose(8)}") for i in range(12)] + [(None, text), (3, line)]
    rng.shuffle(rows)
    written, volume = substrings.written, []

    def weighed(df, name):
        found = written(df, name)
        sizes = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, kind in found.dtypes if kind == "binary"]
        volume.append(sum(found.agg(*sizes).first()))
        return found

    monkeypatch.setattr(substrings, "written", weighed)
    monkeypatch.setattr(substrings, "HOT_CHUNKS", hot)
    monkeypatch.setattr(substrings, "SENT_BYTES", sent, raising=False)
    monkeypatch.setitem(common.BATCH, "spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), brute.sha(bytes(r.kept))) for r in found]
    assert sorted(got, key=repr) == sorted(brute.substrings(rows), key=repr)
    assert sum(volume) < sum(len(t) for _, t in rows) / 2


def test_stretches_have_one_digest_if_and_only_if_their_bytes_are_equal():
    rng = random.Random(3)
    blob = "".join(rng.choices("ab", k=400)).encode() * 2 + b"a" * 900 + bytes(range(256)) * 2
    chunk = substrings.Chunk(np.array([1]).tobytes(), np.array([len(blob)]).tobytes(), blob)
    at = [(i, n) for n in (50, 51, 57, 64, 127, 128, 129, 300) for i in range(len(blob) - n + 1)]
    begin, size = (np.array(x) for x in zip(*at))
    digests = chunk.digests(begin, size, np.zeros(len(at), np.uint64)).tolist()
    pairs = {(blob[a : a + n], d) for (a, n), d in zip(at, digests)}
    assert len(pairs) == len({s for s, _ in pairs}) == len({d for _, d in pairs})


# --- SimHash groups


def test_segments_cover_every_distance():
    for bits in range(6):
        for segments in (2, 3, 4):
            plan = simhash.segment_plan(bits, segments)
            assert sum(width for _, width, _ in plan) <= 64
            assert sum(r + 1 for _, _, r in plan) > bits


@pytest.mark.parametrize("block", [8, 2048])
@pytest.mark.parametrize("segments", [2, 3, 4])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, block, segments):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(segments)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) & (2**64 - 1) for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(100)} | {0, 1, 2**64 - 1}
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), 4, segments)
    root = {r.node: r.root for r in components.stars(links).collect()}
    mine = [root.get(p, p) for (p,) in signed]
    theirs = brute.components(prints)
    assert len({*zip(mine, theirs)}) == len(set(mine)) == len(set(theirs))


def test_divided_buckets_keep_every_link(spark, monkeypatch):
    """Fingerprints of one bucket: many far apart, chains among them, all with equal low halves."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(7)
    low = rng.getrandbits(32)
    prints = {rng.getrandbits(32) << 32 | low for _ in range(300)}
    for start in sorted(prints)[:40]:
        for step in range(1, 5):
            prints.add(start ^ ((1 << 4 * step) - 1 << 36))
    prints = sorted(prints)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), 4, 2)
    root = {r.node: r.root for r in components.stars(links).collect()}
    mine = [root.get(p, p) for (p,) in signed]
    theirs = brute.components(prints)
    assert len({*zip(mine, theirs)}) == len(set(mine)) == len(set(theirs)) > 100


@pytest.mark.parametrize("bits", [0, 1, 4, 7])
def test_parts_of_a_division_cover_the_unused_bits(bits):
    plan = simhash.segment_plan(bits, 3)
    shift, width, _ = plan[-1]
    way = len(plan) - 1
    masks = simhash._part_masks(plan, bits, way, 0)
    assert len(masks) == bits + 1
    assert sum(masks) == (2**64 - 1) ^ ((1 << width) - 1 << shift)
    deeper = simhash._part_masks(plan, bits, way * (bits + 1) + bits, 1)
    assert sum(deeper) == sum(masks[:-1])


def test_labels_of_large_components(spark, monkeypatch):
    rows = [(f, 100 - f if f % 3 else None, f % 4 if f < 30 else f) for f in range(40)]
    rows += [(f, None, 50) for f in range(50, 60)]
    named = spark.createDataFrame(rows, "fp long, first long, root long")
    plain = [tuple(r) for r in simhash._labelled(named).collect()]
    monkeypatch.setattr(simhash, "HOT", 3)
    assert sorted(map(tuple, simhash._labelled(named).collect()), key=str) == sorted(plain, key=str)
    least = {f: c for f, _, c in plain}
    assert least[0] == 100 - 28 and least[39] is None and least[55] is None and len(least) == len(rows)


def test_stars_on_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 2000), (5, 5)]
    found = components.stars(spark.createDataFrame(edges, "a long, b long"))
    assert {(r.node, r.root) for r in found.collect()} == {(i, 0) for i in range(1, 201)} | {(2000, 1000)}


# --- decontamination


def test_blocks_of_the_benchmark_give_the_same(spark, tricky):
    docs = spark.read.parquet(f"{tricky}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{tricky}/benchmark.parquet")
    one = decontaminate.contamination(docs, benchmark)
    many = decontaminate.contamination(docs, benchmark, block_bytes=100)
    rows = lambda df: sorted(map(repr, df.select("doc_id", "n_words", "hits", "items").collect()))
    assert rows(one) == rows(many)


def test_hits_are_code_points(spark):
    text = "ñandú — " + " ".join(f"é{i}" for i in range(20)) + " fin"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    item = " ".join(f"é{i}" for i in range(2, 17))
    found = decontaminate.contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    (hit,) = found.hits
    assert text[hit.start : hit.end] == item


# --- chat formatting


def test_best_paths_by_score(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "low", 1.0), (1, 3, 1, "assistant", "high", 2.0),
        (1, 4, 3, "user", "more", 0.0), (1, 5, 2, "user", "far", 5.0), (2, 1, 9, "tool", "root", None),
        (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0),
    ]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    read = F.transform(reply_trees.turns_of(F.col("formatted")), reply_trees.read_turn)["text"]
    best = {r.tree: r[1] for r in reply_trees.format_trees(messages).select("tree", read).collect()}
    assert best == {"1": ["q", "low", "far"], "2": ["root"]}
    both = reply_trees.format_trees(messages, per_tree=2).filter("tree = '1'").select(read).collect()
    assert sorted(r[0] for r in both) == [["q", "high", "more"], ["q", "low", "far"]]


def test_templates_are_reversible(spark):
    rng = random.Random(5)
    marks = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "<ROLE>>", "</ROLE>>", " ", "\n", "é"]
    roles = ["system", "user", "assistant", "tool", ""]
    rows = [
        (tree, node, node - 1, rng.choice([*roles, "".join(rng.choices(marks, k=3))]), "".join(rng.choices(marks, k=rng.randint(0, 9))), 0.0)
        for tree in range(150)
        for node in range(1, 6)
    ]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    found = reply_trees.format_trees(messages)
    turns = F.transform(reply_trees.turns_of(F.col("formatted")), reply_trees.read_turn)
    loss = reply_trees.loss_texts(F.col("formatted"), F.col("loss_mask"))
    for r in found.select("tree", turns.alias("turns"), loss.alias("loss"), "formatted", "loss_mask").collect():
        own = [(role, text) for tree, _, _, role, text, _ in rows if str(tree) == r.tree]
        assert [tuple(t) for t in r.turns] == own
        assert r.loss == [t for role, t in own if role == "assistant"]
        for m in r.loss_mask:  # the mask's places in the whole conversation
            assert r.formatted[m["at"] - 3 : m["at"]] == "<s>"
            end = m["at"] + m["end"] - m["start"]
            assert r.formatted[end : end + 4] == "</s>"


# --- secrets

SECRET = 'password = "hunter2-hunter2"'


@pytest.mark.parametrize(
    "wrap",
    [
        lambda s: quote(s, safe=""),
        lambda s: quote(quote(s, safe=""), safe=""),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: base64.b64encode(s.encode()).decode(),
        lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
        lambda s: s.encode().hex(),
        lambda s: "%" + "25" * 20_000 + "70" + quote(s[1:], safe=""),
        lambda s: "".join("\\" + "u005c" * 300 + f"u{ord(c):04x}" for c in s),
        lambda s: quote(base64.b64encode(gzip.compress(base64.b64encode(s.encode()))).decode(), safe=""),
    ],
)
def test_nested_layers_map_to_the_text(wrap):
    inner = wrap(SECRET)
    text = f"é before {inner} after"
    base, found = secrets.all_spans(text)
    assert set(base) <= set(found)
    nested = [s for s in found if s.kind == "assign"]
    assert nested
    for s in nested:
        assert 9 <= s.start < s.end <= 9 + len(inner)


@pytest.mark.parametrize("text", [None, "", "%2525zz", "QUFBQUFBQUFBQUFBQUFBQQ==", "%41" * 500])
def test_clean_layers_end(text):
    assert secrets.all_spans(text) == ([], [])


def test_a_long_chain_of_escapes_ends_at_once():
    base, found = secrets.all_spans("%" + "25" * 50_000)
    assert base == found == [("hex", 1, 100_001)]


PLAIN = "password=hunter2hunter2"


def nested(text: str) -> list[tuple[int, int]]:
    base, found = secrets.all_spans(text)
    return [(s.start, s.end) for s in found if s.kind == "assign" and s not in base]


@pytest.mark.parametrize("encode", [base64.b64encode, base64.b16encode, lambda b: base64.b64encode(gzip.compress(b))])
@pytest.mark.parametrize(
    "data",
    [
        b"A=1\0" + PLAIN.encode() + b"\0B=2",
        b"\x1b[0mlog\n" + PLAIN.encode(),
        PLAIN.encode("utf-16"),
        PLAIN.encode("utf-16-be"),
        b"caf\xe9 " + PLAIN.encode(),
    ],
)
def test_layers_that_are_not_plain_text(encode, data):
    inner = encode(data).decode()
    (span,) = nested(f"é {inner} after")
    assert 2 <= span[0] < span[1] <= 2 + len(inner)


@pytest.mark.parametrize("data", [b"\xff " + PLAIN.encode(), gzip.compress(PLAIN.encode()), PLAIN.encode("utf-16")])
def test_url_escapes_of_bytes_that_are_not_text(data):
    inner = "".join(f"%{b:02X}" for b in data)
    assert nested(f"see ?q={inner} after") == [(7, 7 + len(inner))]
    assert nested(f"see ?q={quote(data)} after")


@pytest.mark.parametrize("before", ["https://host.example.com/cb/", "a-", "ab_", "abc/", "x+y"])
@pytest.mark.parametrize("after", ["", "/tail", "-1"])
def test_base64_beside_its_neighbours(before, after):
    inner = base64.b64encode(PLAIN.encode()).decode().rstrip("=")
    ((start, end),) = nested(f"{before}{inner}{after}")
    assert len(before) <= start < end <= len(before) + len(inner)


@pytest.mark.parametrize("width", [10, 60, 76])
@pytest.mark.parametrize("new_line", ["\n", "\r\n", "\n  "])
@pytest.mark.parametrize("form", ["plain", "gzip", "hex"])
def test_wrapped_runs(width, new_line, form):
    data = random.Random(3).randbytes(300).hex("-").encode() + b" " + PLAIN.encode() + b" end"
    data = gzip.compress(data) if form == "gzip" else data
    inner = data.hex() if form == "hex" else base64.b64encode(data).decode()
    lines = new_line.join(inner[i : i + width] for i in range(0, len(inner), width))
    start, end = max(nested(f"key:\n{lines}\n."), key=lambda s: s[1] - s[0])
    assert 5 <= start < end <= 5 + len(lines)
    assert end - start >= (len(lines) - 2 if form == "gzip" else len(PLAIN) * 4 // 3)


def test_a_line_before_other_words_ends_with_its_own_secret():
    inner = base64.b64encode(PLAIN.encode() + b"x").decode()
    assert (0, len(inner)) in nested(f"{inner}\nhello and more")


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
@pytest.mark.parametrize("first", [b"nothing here", b"pass", b""])
def test_every_member_of_compressed_data(pack, first):
    rest = PLAIN.encode().removeprefix(first)
    inner = base64.b64encode(pack(first) + pack(rest)).decode()
    assert (4, 4 + len(inner.rstrip("="))) in nested(f"see {inner} after")


def test_compressed_data_has_no_prefix_limit():
    rows = b"\xe9 a line of some log, and more \0\n" * (70 << 15)
    inner = base64.b64encode(lzma.compress(rows + PLAIN.encode())).decode()
    assert len(rows) > 64 << 20
    assert nested(inner) == [(0, len(inner.rstrip("=")))]


@pytest.mark.parametrize("wrap", [bytes, base64.b64encode, base64.encodebytes, gzip.compress, lambda b: b.hex().encode()])
def test_runs_and_data_across_pieces(monkeypatch, wrap):
    monkeypatch.setattr(secrets, "PIECE", 4096)
    monkeypatch.setattr(secrets, "OVERLAP", 64)
    monkeypatch.setattr(secrets, "BLOCK", 1000)
    noise = random.Random(1).randbytes(20_000)
    for size in (4000, 4070, 4090, 9000):
        data = b"." * size + wrap(gzip.compress(noise + PLAIN.encode())) + b" " * 90 + PLAIN.encode()[:4]
        inner = base64.b64encode(gzip.compress(data)).decode()
        assert nested(inner) == [(0, len(inner.rstrip("=")))]


def test_redaction_leaves_clean_texts(spark):
    rows = [(1, f"a {SECRET} b", 0), (2, "nothing here", 12), (3, None, None)]
    out = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"))
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ('a [secret]" b', 13), 2: ("nothing here", 12), 3: (None, None)}


# --- html

ARTICLE = "<h1>Title</h1><p>A long paragraph of the article, with <a href=x>links</a> in it.</p><p>To.</p><ul><li>one</li><li>two</li></ul><p>The last long paragraph of this article &amp; more.</p>"
WANTED = "Title\n\nA long paragraph of the article, with links in it.\n\nTo.\n\none\n\ntwo\n\nThe last long paragraph of this article & more."


@pytest.mark.parametrize(
    "page",
    [
        f"<body><nav><a>Home</a></nav><article>{ARTICLE}</article><footer>f</footer></body>",
        f"<body><header><h2>Site name</h2></header><main><div class='post'>{ARTICLE}</div><div class='comments'><p>I like it very much indeed, thanks!</p></div></main><aside>More</aside>",
        f"<body><div id='cookie-notice'><p>We use cookies on this site, do you accept them all?</p></div><div class=content>{ARTICLE}</div><form><input><button>Send</button></form>",
        f"<article><script>if (a < b) document.write('<p>x</p>')</script>{ARTICLE}<div class='ad'>Buy this now, a wonderful thing for you.</div></article>",
        f"<div class='sidebar'><p>Popular stories of the week and of the month.</p></div><article>{ARTICLE}<!-- c --></article>",
    ],
)
def test_main_text(page):
    assert html_text.main_text(page) == WANTED


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form id='aspnetForm'>{ARTICLE}</form></body>",
        f"<body><a>Skip to it</a><form><nav>Menu</nav><article>{ARTICLE}</article><button>Go</button></form></body>",
        f"<body><div class='container no-sidebar'>{ARTICLE}</div></body>",
        f"<div class='has-sidebar'><article>{ARTICLE}</article></div><p>All rights reserved</p>",
        f"<div class='sidebar-open'><main>{ARTICLE}</main></div><p>All rights reserved</p>",
        f"<div class='menu-closed'><article>{ARTICLE}</article></div>",
        f"<nav>{ARTICLE}</nav>",
        f"<div>{ARTICLE}</div><div id='comments'><article>{'<p>A comment that goes on and on.</p>' * 40}</article></div>",
        f"<article>{ARTICLE}<div class='comments'><article>{'<p>A comment that goes on and on.</p>' * 40}</article></div></article>",
        f"<article>{ARTICLE}</article><form>{'<p>A question of a long survey of readers.</p>' * 40}</form>",
    ],
)
def test_wrappers_do_not_hide_the_article(page):
    assert html_text.main_text(page) == WANTED


def test_smoothing_keeps_the_mean_level():
    assert html_text._smooth([2.0, 2.0, 2.0]) == pytest.approx([2.0, 2.0, 2.0])


# --- urls


def test_bloom_filter_has_no_false_negative(spark):
    listed = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom = urls.bloom_blocks(listed, "key", 150)
    rows = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("key"))
    passed = {r.key for r in urls.may_contain(rows, "key", bloom, 150).collect()}
    assert {f"k{i}" for i in range(3000)} <= passed
    assert len(passed) < 3000 + 300


def test_canonical_urls(spark):
    spellings = ["http://www.A.com/x/?utm_a=1", "https://a.com:443/x#t", "https://a.com/x", "https://a.com/x?ref=2"]
    df = spark.createDataFrame([(s,) for s in spellings], "url string")
    assert {r[0] for r in df.select(urls.canonical(F.col("url"))).collect()} == {"a.com/x"}


def test_no_rules_and_no_list(spark):
    pages = spark.createDataFrame([(1, "https://a.com/x")], "page_id long, url string")
    row = urls.filter_urls(pages, pages.select("url").limit(0), ()).first()
    assert (row.rule, row.verdict) == (None, "allow")
