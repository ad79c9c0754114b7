"""Secret scans through nested encodings.

Base patterns run over a text.  A worklist then unwraps encoded runs, layer by layer:
URL escapes, backslash and octal escapes, base64, hexadecimal bytes and compressed data
(gzip, zlib of any window, bzip2, xz, members of zip files, and raw deflate where it is all that a run
or a layer decodes to).  Decoded bytes need not be text: every readable stretch of them counts, in UTF-16 too.  Each new
layer is scanned again and unwrapped again until nothing new comes out; a layer that was
seen before in the same text is not opened twice, which ends cycles.  Every layer carries
a map to the original text, so a secret found three layers down is reported as a span of
the text itself.

Positions are code points, the end exclusive.  Null and empty texts have no spans; rows
are read one by one, so repeated rows and ids change nothing; an empty table gives an
empty result.  A text of any length is scanned whole; one task holds it.  Other columns pass through,
but for those named ``base_spans`` and ``spans``, which are replaced.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickshop.llm.common import field, mapped, others, prepare

# The kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KEYWORDS = ("passw", "secret", "token", "api")

# Escapes of an escape's first character are taken together with it: a chain of them
# is one step, however long it is.
URL_UNIT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
URL_ESCAPE = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
SLASH_ESCAPE = re.compile(
    r"\\(?:u005[cC])*(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})|U([0-9A-Fa-f]{8})|([0-3][0-7]{2}))"
    r"|%(?:25)*u([0-9A-Fa-f]{4})"
)
# Lines of a wrapped run belong together, indented or not.
BASE64_RUN = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+|[A-Za-z0-9+/_-]++(?=\r?\n))"
    r"(?:\r?\n[\t\x20]*+[A-Za-z0-9+/_-]++)*+"
)
HEX_RUN = re.compile(
    r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{28,}+|[0-9A-Fa-f]++(?=\r?\n))"
    r"(?:\r?\n[\t\x20]*+[0-9A-Fa-f]++)*+"
)
BASE64_LEAST, HEX_LEAST = 16, 28
LINE = re.compile(r"[^\t\n\r\x20]+")
_BREAKS = str.maketrans("", "", "\t\n\r\x20")
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
# No pattern or encoding uses other characters than these, so decoded bytes are read in
# stretches of them.  A shorter one cannot hold a match ("token=" and 8 characters), nor
# an encoding of one.
STRETCH_LEAST = 14
STRETCH = re.compile(r"[\t\n\r\x20-\x7E]{14,}")
WIDE_STRETCH = re.compile(r"(?:[\t\n\r\x20-\x7E]\x00){14,}|(?:\x00[\t\n\r\x20-\x7E]){14,}")
# A zlib header: deflate, a window of 256 bytes to 32 KB, no preset dictionary, a multiple of 31.
_ZLIB = [bytes([8 + 16 * w, f]) for w in range(8) for f in range(256) if (256 * (8 + 16 * w) + f) % 31 == 0 and not f & 32]
# gzip, zlib, bzip2, xz, and a deflated member of a zip file.
_MAGIC = (rb"\x1F\x8B\x08", b"|".join(map(re.escape, _ZLIB)), rb"BZh[1-9]", rb"\xFD7zXZ\x00", rb"PK\x03\x04.{4}\x08\x00")
_KINDS = [re.compile(b"(?:%b)" % magic, re.DOTALL) for magic in _MAGIC]
PACKED = re.compile(b"|".join(_MAGIC), re.DOTALL)
GZIP, ZLIB, BZIP2, XZ, ZIP, DEFLATE = range(6)
_WINDOW = {GZIP: 31, ZLIB: 15, ZIP: -15, DEFLATE: -15}
_ZIP_HEADER = 30
BYTES = re.compile(r"[\x00-\xFF]+")
BINARY = re.compile(r"[\x00-\x08\x0E-\x1F\x7F-\xFF]")
#: Compressed data is fed and opened in blocks, and scanned in pieces of about ``PIECE``
#: bytes.  A piece repeats the last ``OVERLAP`` bytes of the one before, and more where an
#: encoded run or compressed data within it goes on.
BLOCK = 1 << 16
PIECE = 4 << 20
OVERLAP = 1 << 14
# The end of a piece, backwards: what may belong to a run that the next piece continues.
_OPEN_END = re.compile(
    rb"""(?:\x00?[A-Za-z0-9+/_=%\\{}:"'\r\n-]|[\t\x20]++\n|\x20{64,}+)*+"""
)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


class _Layer(NamedTuple):
    """A decoded text.  Character i comes from ``at[i] .. to[i]`` of the original text."""

    text: str
    at: np.ndarray
    to: np.ndarray
    binary: bool = False


def base_spans(text: str) -> list[Span]:
    """What the base patterns find, leftmost and non-overlapping per kind."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append(Span("assign", m.start(), m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                found.append(Span("access", m.start(), m.end()))
    found += [Span("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class _Packed:
    """Compressed data of one kind, from ``first`` of ``data`` on, member after member."""

    def __init__(self, data: bytes, first: int, kind: int | None = None) -> None:
        self.data = data
        self.kind = next(i for i, magic in enumerate(_KINDS) if magic.match(data, first)) if kind is None else kind
        self.first = first
        #: Past the last whole member; the end of the data if a member is cut off or damaged.
        self.end = first
        self.whole = self.damaged = False

    def _decoder(self):
        if self.kind in _WINDOW:
            return zlib.decompressobj(_WINDOW[self.kind])
        return bz2.BZ2Decompressor() if self.kind == BZIP2 else lzma.LZMADecompressor(lzma.FORMAT_XZ)

    def _member(self, at: int) -> Iterator[bytes]:
        decoder, rest, flate = self._decoder(), b"", self.kind in _WINDOW
        if self.kind == ZIP:
            names = self.data[at + _ZIP_HEADER - 4 : at + _ZIP_HEADER]
            at += _ZIP_HEADER + int.from_bytes(names[:2], "little") + int.from_bytes(names[2:], "little")
        while not decoder.eof:
            if not rest and (flate or decoder.needs_input):
                rest = self.data[at : at + BLOCK]
                at += len(rest)
                if not rest:
                    if flate:
                        yield decoder.flush()
                    break
            out = decoder.decompress(rest, BLOCK)
            rest = decoder.unconsumed_tail if flate else b""
            yield out
        self.whole = decoder.eof
        self.end = at - len(decoder.unused_data)

    def blocks(self) -> Iterator[bytes]:
        """What the members hold, up to where the data ends or is damaged."""
        at = self.first
        while True:
            try:
                yield from filter(None, self._member(at))
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                if not self.whole:
                    self.end, self.damaged = len(self.data), True
                return
            at = self.end
            while self.data.startswith(b"\x00", at):  # padding
                at += 1
            if not self.whole or self.kind == DEFLATE or not _KINDS[self.kind].match(self.data, at):
                return


def _pieces(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Blocks as pieces that overlap, so that each match and each run is whole in one."""
    held, most, fresh = bytearray(), PIECE, False
    for block in blocks:
        held += block
        fresh = True
        if len(held) >= most:
            piece = bytes(held)
            yield piece
            keep = max(OVERLAP, _open_end(piece), len(piece) - _unfinished(piece))
            held, fresh = held[-keep:], False
            most = max(PIECE, 2 * keep)
    if fresh:
        yield bytes(held)


def _open_end(piece: bytes) -> int:
    """Bytes at the end that a run takes which may go on; one character over and over is none."""
    n = _OPEN_END.match(piece[::-1]).end()
    return 0 if piece.count(piece[-1:], len(piece) - n) == n else n


def _unfinished(piece: bytes) -> int:
    """Where the first compressed data starts that the piece may not hold whole."""
    at = 0
    while m := PACKED.search(piece, at):
        packed = _Packed(piece, m.start())
        deque(packed.blocks(), maxlen=0)
        if not packed.damaged and packed.end == len(piece):
            return m.start()
        at = m.start() + 1 if packed.damaged else packed.end
    return len(piece)


def _fixed(text: str, start: int, end: int) -> _Layer:
    """Unpacked bytes, all of whose characters come from one place."""
    return _Layer(text, np.broadcast_to(start, len(text)), np.broadcast_to(end, len(text)), True)


def _of_bits(at: np.ndarray, to: np.ndarray, data: bytes, bits: int) -> _Layer:
    """Bytes decoded from characters with ``bits`` bits each, one character a byte."""
    ends = np.arange(1, len(data) + 1) * 8
    return _Layer(data.decode("latin-1"), at[(ends - 8) // bits], to[(ends - 1) // bits])


def _decoded(layer: _Layer, pattern: re.Pattern, least: int, bits: int) -> Iterator[_Layer]:
    """The bytes of each run of base64 (6 bits) or hexadecimal digits (4 bits).

    A run may have joined its neighbours, such as the parts of a path, so decoding starts
    from each place within a group of characters that make whole bytes.
    """
    for a, b in _runs(layer.text, pattern):
        run, at, to = layer.text[a:b], layer.at[a:b], layer.to[a:b]
        digits = run.translate(_BREAKS)
        if len(digits) < least:
            continue
        if len(digits) < len(run):
            own = np.frombuffer(run.encode(), np.uint8) > 32
            at, to = at[own], to[own]
        for first in range(2 if bits == 4 else 4):
            part = digits[first:]
            if bits == 4:
                data = bytes.fromhex(part[: len(part) // 2 * 2])
            else:
                part = part[: len(part) - (len(part) % 4 == 1)].encode().translate(_URL_SAFE)
                data = base64.b64decode(part + b"=" * (-len(part) % 4))
            yield _of_bits(at[first:], to[first:], data, bits)


def _runs(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Runs with all their lines, and each line alone: the next may be mere words."""
    for m in pattern.finditer(text):
        yield m.span()
        if "\n" in m[0]:
            for line in LINE.finditer(text, *m.span()):
                yield line.span()


def _stretches(layer: _Layer) -> Iterator[_Layer]:
    """The readable parts of decoded bytes, and what is packed within them."""
    for m in STRETCH.finditer(layer.text):
        a, b = m.span()
        yield _Layer(m[0], layer.at[a:b], layer.to[a:b])
    yield from _binary(layer)
    if not layer.binary:
        yield from _deflated(layer)


def _deflated(layer: _Layer) -> Iterator[_Layer]:
    """What a run or a whole layer decodes to, opened as deflated data without a header, which must fill it."""
    if not BYTES.fullmatch(layer.text):
        return
    data = layer.text.encode("latin-1")
    packed = _Packed(data, 0, DEFLATE)
    size = sum(map(len, packed.blocks()))
    # An alignment of base64 or hexadecimal digits may leave up to two bytes more.
    if packed.whole and size >= STRETCH_LEAST and packed.end >= len(data) - 2:
        for piece in _pieces(_Packed(data, 0, DEFLATE).blocks()):
            yield _fixed(piece.decode("latin-1"), int(layer.at[0]), int(layer.to[-1]))


def _binary(layer: _Layer) -> Iterator[_Layer]:
    """UTF-16 text and compressed data among the characters below 256 of a layer."""
    for m in WIDE_STRETCH.finditer(layer.text):
        a, b = m.span()
        yield _Layer(m[0].replace("\x00", ""), layer.at[a:b:2], layer.to[a + 1 : b : 2])
    for run in BYTES.finditer(layer.text):
        data, at = run[0].encode("latin-1"), 0
        while m := PACKED.search(data, at):
            packed = _Packed(data, m.start())
            found = any([len(block) for block in packed.blocks()])
            at = m.start() + 1 if packed.damaged else packed.end
            if found:
                start = int(layer.at[run.start() + m.start()])
                end = int(layer.to[run.start() + packed.end - 1])
                for piece in _pieces(_Packed(data, m.start()).blocks()):
                    yield _fixed(piece.decode("latin-1"), start, end)


def _unescaped(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """A layer with every escape of ``pattern`` replaced and all else kept."""
    parts, at, to = [], [], []
    done, changed = 0, False
    for m in pattern.finditer(layer.text):
        a, b = m.span()
        new = decode(m)
        if new is None:
            continue
        changed = True
        parts += [layer.text[done:a], new]
        at += [layer.at[done:a], np.full(len(new), layer.at[a])]
        to += [layer.to[done:a], np.full(len(new), layer.to[b - 1])]
        done = b
    if not changed:
        return None
    parts.append(layer.text[done:])
    at.append(layer.at[done:])
    to.append(layer.to[done:])
    return _Layer("".join(parts), np.concatenate(at), np.concatenate(to))


def _url_bytes(m: re.Match) -> str:
    return bytes.fromhex("".join(URL_UNIT.findall(m[0]))).decode("latin-1")


def _url_text(m: re.Match) -> str:
    text = _url_bytes(m)
    try:
        return text.encode("latin-1").decode()
    except UnicodeDecodeError:
        return text


def _slash_text(m: re.Match) -> str | None:
    code = int(m[5], 8) if m[5] else int(m[1] or m[2] or m[3] or m[4] or m[6], 16)
    return chr(code) if code < 0xD800 or 0xDFFF < code < 0x110000 else None


def _inner(layer: _Layer) -> Iterator[_Layer]:
    """The layers directly inside one."""
    text = layer.text
    if "%" in text and (plain := _unescaped(layer, URL_ESCAPE, _url_text)):
        yield plain
        raw = _unescaped(layer, URL_ESCAPE, _url_bytes)
        if BINARY.search(raw.text):
            yield from _binary(raw)
            yield from _deflated(raw)
            if "+" in text:  # a space in forms
                spaced = layer._replace(text=text.replace("+", " "))
                yield from _binary(_unescaped(spaced, URL_ESCAPE, _url_bytes))
    if ("\\" in text or "%" in text) and (plain := _unescaped(layer, SLASH_ESCAPE, _slash_text)):
        yield plain
        if BINARY.search(plain.text):
            yield from _binary(plain)
            yield from _deflated(plain)
    for pattern, least, bits in ((BASE64_RUN, BASE64_LEAST, 6), (HEX_RUN, HEX_LEAST, 4)):
        for decoded in _decoded(layer, pattern, least, bits):
            yield from _stretches(decoded)


def all_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and base with the decoded layers' spans, both in order."""
    if not text:
        return [], []

    def ordered(spans: set[Span]) -> list[Span]:
        return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))

    base = set(base_spans(text))
    found = set(base)
    if _encoded(text):
        at = np.arange(len(text))
        top = _Layer(text, at, at + 1)
        seen = {_mark(top)}
        # Layers still to open, breadth first; unpacked pieces are finished one by one.
        work = [(iter(()), deque([top]))]
        while work:
            inner, queue = work[-1]
            layer = next(inner, None)
            if layer is None:
                work.pop()
                if queue:
                    work.append((_inner(queue.popleft()), queue))
                continue
            # The same text from the same place is a cycle or a second way to it.
            mark = _mark(layer)
            if mark in seen:
                continue
            seen.add(mark)
            if layer.binary:
                work.append((_stretches(layer), deque()))
                continue
            for kind, a, b in base_spans(layer.text):
                found.add(Span(kind, int(layer.at[a]), int(layer.to[b - 1])))
            queue.append(layer)
    return ordered(base), ordered(found)


def _mark(layer: _Layer) -> tuple:
    text = hashlib.blake2b(layer.text.encode(), digest_size=16).digest()
    return text, layer.binary, int(layer.at[0]), int(layer.to[-1])


def _encoded(text: str) -> bool:
    return (
        "%" in text
        or "\\" in text
        or BASE64_RUN.search(text) is not None
        or HEX_RUN.search(text) is not None
    )


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``base_spans`` and ``spans``, arrays of kind, start and end."""
    prepare(documents.sparkSession)
    kept = others(documents, "base_spans", "spans")
    rows = documents.select(*[field(c) for c in kept])
    schema = T.StructType(list(rows.schema))
    schema.add("base_spans", T.ArrayType(SPAN)).add("spans", T.ArrayType(SPAN))
    place = kept.index(text)

    def spans(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [all_spans(t) for t in batch.column(place).to_pylist()]
        columns = [
            pa.array([[s._asdict() for s in pair[k]] for pair in both], _ARROW) for k in (0, 1)
        ]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *columns], names=[*kept, "base_spans", "spans"]
        )

    return mapped(rows, spans, schema)


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(documents: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``documents`` with every span of secrets replaced; ``n_chars`` follows if present.

    Overlapping spans become one mark.  Texts without spans stay as they are.
    """
    prepare(documents.sparkSession)
    names = documents.columns
    place = names.index("text")
    counted = names.index("n_chars") if "n_chars" in names else None

    def clean(text: str | None) -> str | None:
        spans = all_spans(text)[1]
        if not spans:
            return text
        parts, done = [], 0
        for _, start, end in spans:
            if start >= done:
                parts += [text[done:start], mark]
            done = max(done, end)
        return "".join([*parts, text[done:]])

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns)
        old = columns[place].to_pylist()
        new = [clean(t) for t in old]
        columns[place] = pa.array(new, columns[place].type)
        if counted is not None:
            counts = columns[counted].to_pylist()
            counts = [n if a is b else len(b) for n, a, b in zip(counts, old, new)]
            columns[counted] = pa.array(counts, columns[counted].type)
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return mapped(documents, rows, documents.schema)
