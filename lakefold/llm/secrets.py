"""Secret scans with a recursive decoding worklist.

A text is scanned for the base kinds.  Then its encoded parts are unwrapped:
percent escapes, `\\u` / `\\x` escapes and base64 runs (in one line and wrapped over
lines, whatever letters come before them); bytes of any of them that are
gzip, zlib or bzip2 streams are decompressed, all members of a stream.  Every new layer goes on the worklist, is
scanned, and unwrapped in turn until no new layer appears.  Escapes inside escapes
are undone one level at a time down to STEPS levels, and besides that to their end in
one pass, however deep, so a chain of them takes linear time; of the levels between
those only the last is scanned.  A layer that was met before for the same range (by digest) is not entered again, so cycles end.
Decoded bytes are scanned whatever else they hold, also as UTF-16.  Each layer maps its characters to the character ranges of the text it came
from; a finding is reported by its range in the original text.

Defined results: a null or empty text has no findings; ties (the same kind and
range found twice) are one span; texts are scanned whole; repeated rows give
repeated results; other columns are ignored.  Decompression is streamed: what a
stream holds beyond LAYER_BYTES is scanned in overlapping windows of that size; an
encoded run that crosses a border goes whole into the next window, however long.
"""

from __future__ import annotations

import array
import base64
import bz2
import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import blocks

# The kinds in their order, with pattern and least length.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so a run under 16 never matches
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
BREAK = re.compile(r"[ \t]*\r?\n[ \t]*")
WIDE = re.compile(rb"\x00?(?:[\t\n\r\x20-\x7e]\x00){15,}[\t\n\r\x20-\x7e]?")  # ASCII in UTF-16 of either byte order
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\x78[\x01\x5e\x9c\xda]")
PERCENT_BYTE = re.compile(rb"%([0-9A-Fa-f]{2})")
ESCAPED_BYTE = re.compile(rb"\\x([0-9A-Fa-f]{2})|\\u00([0-9A-Fa-f]{2})|\\([abfnrtv0\\'\"])")
LETTERS = dict(zip((b"a", b"b", b"f", b"n", b"r", b"t", b"v", b"0", b"\\", b"'", b'"'), (b"\a", b"\b", b"\f", b"\n", b"\r", b"\t", b"\v", b"\0", b"\\", b"'", b'"')))
BLANK = re.compile(rb"[ \t\r\n]")
UNFINISHED = re.compile(rb"[ \t]*+(?:[A-Za-z0-9+/_.=%\\-]++|[ \t]*+\n\r?[ \t]*+)*+")  # backwards
TRIGGER = re.compile(r"[%\\]")
PARTIAL = re.compile(r"%[0-9A-Fa-f]?|\\(?:x[0-9A-Fa-f]?|u[0-9A-Fa-f]{0,3})?")
STEPS = 8
LAYER_BYTES = 4 << 20
OVERLAP = 64 << 10


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base kinds, in order."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def _decompressor(head: bytes):
    """(decompressor, its errors) of a stream that begins so; none if it is none."""
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor(), (OSError, ValueError)
    if head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return zlib.decompressobj(47), (zlib.error,)
    return None


def _inflated(pieces: Iterator[bytes], first: bytes) -> Iterator[bytes]:
    """What a gzip, zlib or bzip2 stream and the members that follow it hold, at most LAYER_BYTES at a time;
    nothing if it is none.  `first` begins the stream, `pieces` has the rest."""
    data = first
    while opened := _decompressor(data):
        stream, errors = opened
        try:
            while True:
                piece = stream.decompress(data, LAYER_BYTES)
                if piece:
                    yield piece
                if stream.eof:
                    break
                data = getattr(stream, "unconsumed_tail", b"")  # bzip2 keeps its own
                if not data and (len(piece) < LAYER_BYTES or getattr(stream, "needs_input", False)):
                    data = next(pieces, None)
                    if data is None:
                        return
        except errors:
            return
        data = stream.unused_data
        if isinstance(pieces, _Whole):
            pieces.left = len(data)
        data = data.lstrip(b"\0")  # gzip members may be padded
        while len(data) < 4 and (more := next(pieces, None)) is not None:
            data = (data + more).lstrip(b"\0")


def _open_end(piece: bytes) -> int:
    """The length of what may be an unfinished encoded run at the end of a piece."""
    return UNFINISHED.match(piece[::-1]).end()


def _windows(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Pieces with the end of the one before in front, so that nothing is cut in two: OVERLAP bytes, and
    before them the whole of an encoded run that goes on."""
    held, waits = [], False
    for piece in pieces:
        held.append(bytes(piece))
        size = _open_end(held[-1])
        waits = size == len(piece)
        if not waits:
            window = b"".join(held)
            yield window
            held = [window[max(0, len(window) - size - OVERLAP):]]
    if waits:
        yield b"".join(held)


class Layer:
    """A text and, per character, the range of the original text it stands for (None: itself);
    `steps` is how many levels of escapes were undone one by one to reach it."""

    __slots__ = ("text", "start", "end", "steps")

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None, steps: int = 0):
        self.text, self.start, self.end, self.steps = text, start, end, steps

    def origin(self, a: int, b: int) -> tuple[int, int]:
        """The original range of the characters a..b - 1."""
        if self.start is None:
            return a, b
        return int(self.start[a:b].min()), int(self.end[a:b].max())

    def spliced(self, parts: list[tuple[int, int, str, list[tuple[int, int]]]]) -> "Layer":
        """This layer with each range (a, b) replaced by a text whose characters stand for given ranges of it."""
        texts, starts, ends, at = [], [], [], 0

        def own(a: int, b: int):
            texts.append(self.text[a:b])
            starts.append(np.arange(a, b) if self.start is None else self.start[a:b])
            ends.append(np.arange(a + 1, b + 1) if self.end is None else self.end[a:b])

        for a, b, text, ranges in parts:
            own(at, a)
            texts.append(text)
            mapped = [self.origin(x, y) for x, y in ranges]
            starts.append(np.array([x for x, _ in mapped], np.int64))
            ends.append(np.array([y for _, y in mapped], np.int64))
            at = b
        own(at, len(self.text))
        return Layer("".join(texts), np.concatenate(starts), np.concatenate(ends), self.steps + 1)


def _by_bytes(data: bytes, units: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """Text of bytes that each come from a range, undecodable ones replaced, with a range per character."""
    text = data.decode("utf-8", "replace")
    if len(text) == len(data):
        return text, units
    ranges, at = [], 0
    for c in text:
        width = 1 if c == "�" else len(c.encode())
        ranges.append((units[min(at, len(units) - 1)][0], units[min(at + width, len(units)) - 1][1]))
        at = min(at + width, len(units) - 1) if at + width >= len(units) else at + width
    return text, ranges


def _percent(layer: Layer) -> Layer | None:
    parts = []
    for m in PERCENT.finditer(layer.text):
        units = [(i, i + 3) for i in range(m.start(), m.end(), 3)]
        text, ranges = _by_bytes(bytes.fromhex(m.group().replace("%", "")), units)
        parts.append((m.start(), m.end(), text, ranges))
    return layer.spliced(parts) if parts else None


def _escapes(layer: Layer) -> Layer | None:
    parts = []
    for m in ESCAPE.finditer(layer.text):
        chars, ranges = [], []
        for e in ESCAPED.finditer(layer.text, m.start(), m.end()):
            code = int(e[1] or e[2], 16)
            if 0xDC00 <= code < 0xE000 and chars and 0xD800 <= ord(chars[-1]) < 0xDC00:  # the second half of a pair
                chars[-1] = chr(0x10000 + (ord(chars[-1]) - 0xD800 << 10) + code - 0xDC00)
                ranges[-1] = (ranges[-1][0], e.end())
            else:
                chars.append(chr(code))
                ranges.append((e.start(), e.end()))
        parts.append((m.start(), m.end(), "".join(c if not 0xD800 <= ord(c) < 0xE000 else "�" for c in chars), ranges))
    return layer.spliced(parts) if parts else None


def _peeled(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of a text whose escapes are undone until none is left, and where each of them starts and
    ends; bytes above 127 that percent escapes stood for are negative.

    One pass: characters that may still become part of an escape wait in `open_`, and what an
    escape stands for is looked at like a character that was read."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)
    done = [array.array("i") for _ in range(3)]
    open_ = [array.array("i") for _ in range(3)]

    def settle():
        for out, waiting in zip(done, open_):
            out.extend(waiting)
            del waiting[:]

    at, n = 0, len(text)
    while at < n:
        if not open_[0]:  # up to the next escape nothing changes
            m = TRIGGER.search(text, at)
            to = m.start() if m else n
            for out, part in zip(done, (codes[at:to], np.arange(at, to, dtype=np.int32), np.arange(at + 1, to + 1, dtype=np.int32))):
                out.frombytes(part.tobytes())
            at = to
            if at == n:
                break
        code, start, end = int(codes[at]), at, at + 1
        at += 1
        while True:
            for waiting, value in zip(open_, (code, start, end)):
                waiting.append(value)
            if code in (0x25, 0x5C):
                break
            size = next((k for k in range(2, min(6, len(open_[0])) + 1) if open_[0][-k] in (0x25, 0x5C)), 0)
            tail = "".join(map(chr, open_[0][-size:])) if size and min(open_[0][-size:]) >= 0 else ""
            if PERCENT.fullmatch(tail) or ESCAPE.fullmatch(tail):
                code, start = int(tail[1 + (tail[0] != "%"):], 16), open_[1][-size]
                if tail[0] == "%" and code > 127:
                    code = -code
                for waiting in open_:
                    del waiting[-size:]
            else:
                if not (tail and PARTIAL.fullmatch(tail)):
                    settle()
                break
    settle()
    return tuple(np.frombuffer(x, np.int32) for x in done)


def _to_the_end(layer: Layer) -> Iterator[Layer]:
    """The layers below all the escapes of a layer, however deep: the text, and what is UTF-16 or a stream in its bytes."""
    codes, start, end = _peeled(layer.text)
    bounds = lambda at: (start[at], end[at]) if layer.start is None else (layer.start[start[at]], layer.end[end[at] - 1])
    texts, own, at = [], [], 0
    kind = np.where(codes < 0, 1, np.where((codes >= 0xD800) & (codes < 0xE000), 2, 0)).astype(np.uint8)
    for m in re.finditer(rb"\x01+|\x02+", kind.tobytes()):
        a, b = m.span()
        texts.append(codes[at:a].tobytes().decode("utf-32-le"))
        own.append(np.stack([np.arange(at, a), np.arange(at, a)]))
        part = codes[a:b]
        if kind[a] == 2:  # halves of pairs
            text = part.astype(np.uint16).tobytes().decode("utf-16-le", "replace")
            after = np.cumsum([2 if ord(c) > 0xFFFF else 1 for c in text]) + a
            own.append(np.stack([np.concatenate([[a], after[:-1]]), after - 1]))
        else:
            text, ranges = _by_bytes((-part).astype(np.uint8).tobytes(), [(i, i + 1) for i in range(a, b)])
            own.append(np.array(ranges).T - [[0], [1]])
        texts.append(text)
        at = b
    texts.append(codes[at:].tobytes().decode("utf-32-le"))
    own.append(np.stack([np.arange(at, len(codes)), np.arange(at, len(codes))]))
    first, last = np.concatenate(own, axis=1)
    yield Layer("".join(texts), bounds(first)[0], bounds(last)[1], STEPS)
    raw = np.where(codes < 0, -codes, np.where(codes < 256, codes, 0x3F)).astype(np.uint8).tobytes()
    if MAGIC.search(raw) or WIDE.search(raw):
        yield from _opened(raw, bounds, None, False)


def _runs(text: str) -> Iterator[tuple[int, int, str, np.ndarray | None]]:
    """(start, end, letters, place of each letter, None if they follow each other) of the base64 runs of a text:
    those of single lines, and those that go on over line breaks."""
    for m in BASE64.finditer(text):
        yield m.start(), m.end(), m.group().rstrip("="), None
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            run = BREAK.sub("", m.group()).rstrip("=")
            if len(run) >= 16:
                letter = np.ones(m.end() - m.start(), bool)
                for gap in BREAK.finditer(text, m.start(), m.end()):
                    letter[gap.start() - m.start():gap.end() - m.start()] = False
                yield m.start(), m.end(), run, (m.start() + np.flatnonzero(letter)[:len(run)]).astype(np.int32)


def _escaped_bytes(layer: Layer, escape: re.Pattern, plain: Callable[[re.Match], bytes]) -> Iterator[Layer]:
    """Layers of the bytes that escapes stand for, among the bytes that stand for themselves, besides their
    text: what is UTF-16 or a compressed stream."""
    data = layer.text.encode("latin-1", "replace")  # a byte for each character
    raw = escape.sub(plain, data)
    if not (MAGIC.search(raw) or WIDE.search(raw)):
        return
    kept = np.ones(len(data), bool)
    for m in escape.finditer(data):
        kept[m.start() + 1:m.end()] = False
    first = np.flatnonzero(kept)
    last = np.append(first[1:], len(data)) - 1

    def where(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (first[at], last[at] + 1) if layer.start is None else (layer.start[first[at]], layer.end[last[at]])

    yield from _opened(raw, where, None, False)


def _base64(layer: Layer) -> Iterator[Layer]:
    """Layers of the base64 runs.  What comes before the
    encoded part may belong to the alphabet as well, so a run is decoded from each of its first four characters."""
    for a, b, run, place in _runs(layer.text):
        letters = run.replace("-", "+").replace("_", "/")
        for skip in range(4):
            n = len(run) - skip - ((len(run) - skip) % 4 == 1)  # a single last letter is no byte
            data = base64.b64decode(letters[skip:skip + n] + "=" * (-n % 4))

            def where(at: np.ndarray, skip=skip, n=n) -> tuple[np.ndarray, np.ndarray]:
                first, last = skip + at * 4 // 3, np.minimum(skip + (at * 4 + 6) // 3, skip + n) - 1
                first, last = (a + first, a + last) if place is None else (place[first], place[last])
                return (first, last + 1) if layer.start is None else (layer.start[first], layer.end[last])

            yield from _opened(data, where, layer.origin(a, b)[1])


def _opened(data: bytes, where: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], b: int | None, whole: bool = True) -> Iterator[Layer]:
    """Layers of decoded bytes: the bytes themselves, if there may be something in them, what is UTF-16 in them
    and the compressed streams in them.  `where` tells the ranges of bytes, `b` is where streams end (None: where
    they do by themselves); without `whole`, only UTF-16 and streams."""
    text = data.decode("latin-1") if whole else ""  # what is searched for is ASCII, so one character a byte serves for any bytes
    if base_spans(text) or _encoded(text):
        yield Layer(text, *where(np.arange(len(data))))
    for m in WIDE.finditer(data):
        own = m.start() + np.flatnonzero(np.frombuffer(m.group(), np.uint8))
        yield Layer(m.group().replace(b"\0", b"").decode("ascii"), *where(own))
    at, view = 0, memoryview(data)
    while m := MAGIC.search(data, at):
        stream = _Whole(view[m.start():])
        end = b
        if end is None:
            for _ in _inflated(stream, next(stream)):
                pass
            gap = BLANK.search(data, m.start())
            end = len(data) - stream.left if stream.left is not None else gap.start() if gap else len(data)
            end = int(where(np.array([end - 1]))[1][0])
            stream = _Whole(view[m.start():])
        yield from _unpacked(stream, int(where(np.array([m.start()]))[0][0]), end)
        at = m.start() + 1 if stream.left is None else len(data) - stream.left


class _Whole:
    """A stream in one piece; `left` is the number of bytes after its end, None if it has none."""

    def __init__(self, data):
        self.data, self.left = data, None

    def __iter__(self):
        return self

    def __next__(self):
        if self.data is None:
            raise StopIteration
        data, self.data = self.data, None
        return data


def _unpacked(pieces: Iterator[bytes], a: int, b: int, met: frozenset = frozenset()) -> Iterator[Layer]:
    """Layers of a compressed stream, and of streams inside it: all their characters stand for the
    whole run.  A stream that begins like one around it is not opened again."""
    first = next(pieces, None)
    if first is None:
        return
    inside = _inflated(pieces, first)
    held = None if met and hashlib.sha256(first).digest() in met else next(inside, None)
    if held is not None:
        yield from _unpacked(itertools.chain([held], inside), a, b, met | {hashlib.sha256(first).digest()})
    elif met:
        for window in _windows(itertools.chain([first], pieces)):
            for part in [window, *(m.group().replace(b"\0", b"") for m in WIDE.finditer(window))]:
                text = part.decode("latin-1")
                if base_spans(text) or _encoded(text):
                    yield Layer(text, np.broadcast_to(np.int64(a), len(text)), np.broadcast_to(np.int64(b), len(text)))


def _encoded(text: str) -> bool:
    """Whether a text may have encoded parts."""
    return bool(PERCENT.search(text) or ESCAPE.search(text)) or bool(BASE64.search(text)) or "\n" in text and any(
        len(BREAK.sub("", m.group())) >= 16 for m in WRAPPED.finditer(text))


def _unwrapped(layer: Layer) -> Iterator[Layer]:
    """The layers right below one."""
    if layer.steps < STEPS:
        nested = False
        for new in (_percent(layer), _escapes(layer)):
            if new is not None and new.text:
                nested = nested or bool(PERCENT.search(new.text) or ESCAPE.search(new.text))
                yield new
        if nested and not layer.steps:
            yield from _to_the_end(layer)
    if PERCENT.search(layer.text):
        yield from _escaped_bytes(layer, PERCENT_BYTE, lambda m: bytes([int(m[1], 16)]))
    if ESCAPE.search(layer.text):
        yield from _escaped_bytes(layer, ESCAPED_BYTE, lambda m: bytes([int(m[1] or m[2], 16)]) if m[1] or m[2] else LETTERS[m[3]])
    for new in _base64(layer):
        if new.text:
            yield new


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) of a text, each (start, end, kind number) by start, then kind."""
    base = base_spans(text)
    if not _encoded(text):
        return base, base
    found, met, work = set(base), set(), [_unwrapped(Layer(text))]
    while work:
        new = next(work[-1], None)
        if new is None:
            work.pop()
            continue
        mark = hashlib.sha256(repr(new.origin(0, len(new.text))).encode() + new.text.encode("utf-8", "replace")).digest()
        if mark not in met:
            met.add(mark)
            found.update((*new.origin(a, b), kind) for a, b, kind in base_spans(new.text))
            work.append(_unwrapped(new))
    return base, sorted(found, key=lambda s: (s[0], s[2], s[1]))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in spans)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `base_spans` and `spans` (kind:start:end by start, then kind, comma-joined)
    and the number of base spans of each kind."""
    df = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows = [scan(x.as_py() or "") for x in block.column(1)]
            counts = [pa.array([sum(s[2] == k for s in base) for base, _ in rows], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), *counts, pa.array([_joined(base) for base, _ in rows], pa.string()),
                 pa.array([_joined(spans) for _, spans in rows], pa.string())],
                names=["key", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])

    kind = df.schema["key"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return df.mapInArrow(run, f"key {kind}, {counts}, base_spans string, spans string").withColumnRenamed("key", key)


def secret_report(docs: DataFrame) -> DataFrame:
    return find_secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex",
                                     F.sha2("base_spans", 256).alias("base_sha256"), "spans")
