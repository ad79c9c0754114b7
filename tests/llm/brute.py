"""Plain Python versions of the contracts, one text or one table at a time."""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

Rows = list[tuple]


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def token_ids(texts: list[str | None]) -> list[bytes]:
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]
    return [np.array(ids, "<u4").tobytes() for ids in found]


def decontamination(documents: Rows, benchmark: Rows) -> Rows:
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = defaultdict(set)
    for item, text in benchmark:
        w = word.findall(lower(text))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add("" if item is None else str(item))
    rows = []
    for doc, text in documents:
        w = word.findall(lower(text))
        hit, items = [0] * len(w), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    items |= windows[tuple(w[i : i + size])]
                    hit[i : i + size] = [1] * size
        n = sum(hit)
        digest = sha(",".join(sorted(items)))
        rows.append((doc, len(w), n, len(items), digest, n > 0 and 20 * n >= len(w)))
    return rows


def substrings(documents: Rows) -> Rows:
    def order(doc):
        return float("inf") if doc is None else doc

    first: dict[bytes, float] = {}
    for doc, text in documents:
        b = (text or "").encode()
        for i in range(len(b) - 49):
            s = b[i : i + 50]
            first[s] = min(first.get(s, float("inf")), order(doc))
    rows = []
    for doc, text in documents:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < order(doc):
                gone[i : i + 50] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        rows.append((doc, len(b), int(gone.sum()), spans, sha(kept)))
    return rows


_RANKS = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
MULTI = tiktoken.Encoding(
    "multi",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, _RANKS.splitlines())},
    special_tokens={},
)


def bpe(documents: Rows) -> Rows:
    rows = []
    for doc, text in documents:
        ids = MULTI.encode_ordinary(text or "")
        rows.append((doc, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    return rows


def fingerprint(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(prints: list[int], bits: int = 4) -> list[int]:
    """The least index reachable from each fingerprint."""
    own = np.array(prints, np.uint64)
    label = list(range(len(prints)))

    def find(x: int) -> int:
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(own)):
        for j in np.flatnonzero(np.bitwise_count(own[i + 1 :] ^ own[i]) <= bits).tolist():
            a, b = find(i), find(i + 1 + j)
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def simhash(documents: Rows) -> Rows:
    prints = [fingerprint(t) for _, t in documents]
    group = components(prints)
    least: dict[int, int] = {}
    for (doc, _), g in zip(documents, group):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    return [(d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(documents, prints, group)]


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    kinds = {
        "assign": r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]+",
    }
    least = {"assign": 8, "access": 16, "hex": 32}
    spans = []
    for rank, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= least[kind]:
                spans.append((m.start(), rank, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def crc(data: bytes) -> int:
    return zlib.crc32(data)


# --- licences


def licenses(documents: Rows, phrases: dict[str, str]) -> Rows:
    """Id, words, places, first and last place, labels of the base phrases, by comparing word lists."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    rows = []
    for doc, text in documents:
        w = word.findall(lower(text))
        places = []
        for phrase, label in phrases.items():
            own = phrase.split()
            places += [(i, label) for i in range(len(w)) if w[i : i + len(own)] == own]
        starts = [i for i, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        rows.append((doc, len(w), len(places), min(starts, default=None), max(starts, default=None), labels))
    return rows


def license_terms(tokens: list[str], label_of, freedom, exception: float) -> tuple[set[str], float]:
    """A complete licence expression, by recursive descent."""
    at = 0

    def unit():
        nonlocal at
        if tokens[at] == "(":
            at += 1
            found = either()
            at += 1
            return found
        label = label_of(tokens[at])
        at += 1
        if at < len(tokens) and tokens[at] == "with":
            score = freedom(label)
            found = {f"{label}-with-{label_of(tokens[at + 1])}"}, max(score, exception) if score else 0.0
            at += 2
            return found
        return {label}, freedom(label)

    def level(word, below, better):
        nonlocal at
        labels, score = below()
        while at < len(tokens) and tokens[at] == word:
            at += 1
            more, other = below()
            labels, score = labels | more, better(score, other)
        return labels, score

    def both():
        return level("and", unit, min)

    def either():
        return level("or", both, max)

    return either()


# --- runs of words


def word_runs(words: list) -> Rows:
    """Start, length and least period of all maximal runs of four periods and six words or more."""
    least = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                least.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in least.items())


# --- secrets in layers


def hidden_kinds(data: bytes, depth: int) -> set[str]:
    """Kinds of secrets in bytes and in all that can be decoded from them, ``depth`` times over."""
    found = set()
    for text in (data.decode("latin-1"), data[::2].decode("latin-1"), data[1::2].decode("latin-1")):
        found |= {kind for kind, _, _ in base_spans(text)}
    if depth:
        for inner in set(unwrapped(data)):
            found |= hidden_kinds(inner, depth - 1)
    return found


def unwrapped(data: bytes):
    yield data.replace(b"\0", b"")  # UTF-16
    for run in re.findall(rb"[A-Za-z0-9+/_-]{16,}", data):
        for i in range(4):
            part = run[i:].translate(bytes.maketrans(b"-_", b"+/"))
            part = part[: len(part) - (len(part) % 4 == 1)]
            yield base64.b64decode(part + b"=" * (-len(part) % 4))
    for run in re.findall(rb"[0-9A-Fa-f]{28,}", data):
        for i in range(2):
            yield bytes.fromhex(run[i : i + (len(run) - i) // 2 * 2].decode())
    yield re.sub(rb"%([0-9A-Fa-f]{2})", lambda m: bytes.fromhex(m[1].decode()), data)
    escape = rb"(?:\\u|%u)00([0-9A-Fa-f]{2})|\\x([0-9A-Fa-f]{2})"
    yield re.sub(escape, lambda m: bytes.fromhex((m[1] or m[2]).decode()), data)
    yield re.sub(rb"\\([0-3][0-7]{2})", lambda m: bytes([int(m[1], 8)]), data)
    for i in range(len(data)):
        for open_ in (
            lambda x: zlib.decompressobj(47).decompress(x),
            lambda x: bz2.BZ2Decompressor().decompress(x),
            lambda x: lzma.LZMADecompressor().decompress(x),
        ):
            try:
                out = open_(data[i:])
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                continue
            if out:
                yield out
        if data[i : i + 4] == b"PK\x03\x04":
            names = int.from_bytes(data[i + 26 : i + 28], "little") + int.from_bytes(data[i + 28 : i + 30], "little")
            yield zlib.decompressobj(-15).decompress(data[i + 30 + names :])
    try:
        yield zlib.decompressobj(-15).decompress(data)
    except zlib.error:
        pass
