"""Secrets in whole texts, also below nested encodings.

Base rules run on the text itself. Then a worklist unwraps encoded parts: percent escapes,
backslash-u escapes, base64, UTF-16, and zlib or gzip streams, in any nesting. Every new layer,
text or not, is scanned and searched for further parts; a layer that was seen before is not taken up again,
so the work ends. Streams are inflated to their end, in portions. A finding in a layer is mapped back to the stretch of the text it came from.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.storage import map_texts

#: The rules and their least lengths. `assign` is judged by its second group.
RULES = {
    "assign": (
        re.compile(
            rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
            rb"([A-Za-z0-9+/_.=-]+)",
            re.IGNORECASE,
        ),
        2,
        8,
    ),
    "access": (re.compile(rb"AKIA[A-Z0-9]+"), 0, 16),
    # Runs of 32 or more are the same as all runs of which the shorter are dropped.
    "hex": (re.compile(rb"[0-9a-f]{32,}"), 0, 32),
}
KINDS = tuple(RULES)
#: A word of `assign` may stand where one of these letters does; the rest of a text is skipped.
_HINT = re.compile(rb"passw|secret|token|api_?key", re.IGNORECASE)
_PERCENT = re.compile(rb"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(rb"(?:\\u[0-9A-Fa-f]{4})+")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
#: A run that goes on in the next lines; only the last line may be shorter than a run.
_WRAPPED = re.compile(
    rb"[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]{16,}+)*+"
    rb"(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]{1,15}+)?+={0,2}"
)
_LINE = re.compile(rb"[A-Za-z0-9+/_-]+")
#: UTF-16 of ASCII in either byte order; no finding is shorter. All rules and encodings are ASCII.
_LITTLE = re.compile(rb"(?:[\x01-\x7f]\x00){12,}")
_BIG = re.compile(rb"(?:\x00[\x01-\x7f]){12,}")
#: gzip, and zlib without a preset dictionary: two bytes that are a multiple of 31.
_HEAD = re.compile(
    b"|".join(
        [b"\x1f\x8b\x08"]
        + [
            re.escape(bytes([method, flags]))
            for method in range(0x08, 0x80, 0x10)
            for flags in range(256)
            if (method << 8 | flags) % 31 == 0 and not flags & 0x20
        ]
    ),
    re.DOTALL,
)
_MEMBER = re.compile(rb"\x00*+\x1f\x8b")
#: Most bytes that are inflated at once.
_STEP = 1 << 20
#: What may go on behind the end of a portion, read backwards: base64 runs and escapes, also
#: over line ends, and `assign`. Anything else that may be open is shorter than the least.
_OPEN_RUN = re.compile(
    rb"\r?[A-Za-z0-9+/_=%\\.\x00-]*+(?:[ \t]*+\n\r?[A-Za-z0-9+/_=%\\.\x00-]{16,}+)*+[ \t\r\n]*+"
)
_OPEN_ASSIGN = re.compile(
    rb"[A-Za-z0-9+/_.=-]*+[\"']?\x20*+[:=]?\x20*+[\"']?[A-Za-z_]{0,16}"
)
_OPEN_LEAST = 4096
_STANDARD = bytes.maketrans(b"-_", b"+/")
#: Streams are inflated and scanned in portions: one may hold a thousand times its size.
PORTION_BYTES = 8 << 20


class Finding(NamedTuple):
    """A secret at bytes start:end of the text, in the text itself or `depth` layers below."""

    start: int
    end: int
    kind: str
    depth: int


class _Layer(NamedTuple):
    data: bytes
    #: Byte i came from bytes begin[i]:end[i] of the text; whole: all from begin[0]:end[0].
    begin: np.ndarray
    end: np.ndarray
    depth: int

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if len(self.begin) == 1:
            return int(self.begin[0]), int(self.end[0])
        return int(self.begin[start]), int(self.end[end - 1])


def matches(data: bytes) -> Iterator[tuple[int, int, str]]:
    for kind, (rule, group, least) in RULES.items():
        if kind == "assign" and not _HINT.search(data):
            continue
        for m in rule.finditer(data):
            if m.end(group) - m.start(group) >= least:
                yield m.start(), m.end(), kind


def _unescape(layer: _Layer, rule: re.Pattern, decode) -> _Layer | None:
    """The layer with every escape of one form replaced, or nothing without such an escape."""
    out, begin, end, at = [], [], [], 0
    n = len(layer.data)
    one = len(layer.begin) == 1
    whole = layer.begin if one else None

    def keep(i: int, j: int) -> None:
        out.append(layer.data[i:j])
        if not one:
            begin.append(layer.begin[i:j])
            end.append(layer.end[i:j])

    for m in rule.finditer(layer.data):
        raw, sizes, width = decode(m[0])
        keep(at, m.start())
        out.append(raw)
        if not one:
            first = m.start() + np.repeat(np.arange(len(sizes)) * width, sizes)
            begin.append(layer.begin[first])
            end.append(layer.end[first + width - 1])
        at = m.end()
    if not at:
        return None
    keep(at, n)
    if one:
        return _Layer(b"".join(out), whole, layer.end, layer.depth + 1)
    return _Layer(b"".join(out), np.concatenate(begin), np.concatenate(end), layer.depth + 1)


def _percent(escape: bytes) -> tuple[bytes, list[int], int]:
    raw = bytes.fromhex(escape.replace(b"%", b"").decode())
    return raw, [1] * len(raw), 3


def _unicode(escape: bytes) -> tuple[bytes, list[int], int]:
    units = [int(escape[i + 2 : i + 6], 16) for i in range(0, len(escape), 6)]
    chars = [chr(u).encode("utf-8", "replace") for u in units]
    return b"".join(chars), [len(c) for c in chars], 6


def _narrow(layer: _Layer) -> Iterator[_Layer]:
    """The stretches of UTF-16, each by itself: the bytes around may be of another kind."""
    if b"\x00" not in layer.data:
        return
    for rule, at in ((_LITTLE, 0), (_BIG, 1)):
        for m in rule.finditer(layer.data):
            text = m[0][at::2]
            if not _holds(text):
                continue
            begin, end = layer.begin, layer.end
            if len(begin) > 1:
                begin, end = begin[m.start() : m.end() : 2], end[m.start() + 1 : m.end() : 2]
            yield _Layer(text, begin, end, layer.depth + 1)


class _Stream:
    """The compressed stream at data[start:], to its end or as far as it can be read.

    Once its portions were taken, data[start:end] is what was read, and `done` is where the
    last complete member ended, or else still `start`; `size` is set by _streams."""

    def __init__(self, data: bytes, start: int):
        self.data, self.start, self.size = data, start, 0
        self.end = self.done = start

    def __iter__(self) -> Iterator[bytes]:
        view, at, step, full = memoryview(self.data), self.start, 256, False
        zipped = view[at] == 0x1F
        unpack = zlib.decompressobj(wbits=47)
        while at < len(view) or full:
            part, before = view[at : at + step], unpack.copy()
            try:
                out = unpack.decompress(part, _STEP)
            except zlib.error:
                # What stands before the fault is still read.
                if len(part) <= 1:
                    return
                unpack, step = before, len(part) // 2
                continue
            # At the end of a stream, both may hold what is left.
            left = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            at += len(part) - len(left)
            step, full = min(2 * step, 1 << 16), len(out) == _STEP
            self.end = at
            if out:
                yield out
            if not unpack.eof:
                continue
            self.done, full = at, False
            # The members of a gzip file are one content; there may be zeros between them.
            if not (zipped and (m := _MEMBER.match(self.data, at))):
                return
            at = m.end() - 2
            unpack, step = zlib.decompressobj(wbits=31), 256


def _streams(data: bytes) -> Iterator[_Stream]:
    """Compressed streams at any place; inside one that ended well there are no others."""
    at = 0
    while m := _HEAD.search(data, at):
        stream = _Stream(data, m.start())
        stream.size = sum(map(len, stream))
        at = max(stream.done, m.start() + 1)
        yield stream


def _open(data: bytes) -> int:
    """Where that begins which may go on behind the end: a run, a match or a stream."""
    back = data[::-1]
    tail = max(_OPEN_LEAST, _OPEN_RUN.match(back).end(), _OPEN_ASSIGN.match(back).end())
    at = max(0, len(data) - tail)
    return min([at, *(s.start for s in _streams(data) if s.end == len(data))])


def _portions(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The content in portions, each of which begins with what was open in the one before.

    An open part is kept whole, however long; then the next portion is at least twice as long."""
    held, want, new = bytearray(), PORTION_BYTES, False
    for chunk in chunks:
        held += chunk
        new = True
        if len(held) < want:
            continue
        data = bytes(held)
        yield data
        del held[: _open(data)]
        want, new = max(PORTION_BYTES, 2 * len(held)), False
    if new:
        yield bytes(held)


def _decoded(body: bytes) -> bytes:
    """Content of base64 characters (either alphabet), whatever it is."""
    body = body[: len(body) - (len(body) % 4 == 1)].translate(_STANDARD)
    return base64.b64decode(body + b"=" * (-len(body) % 4))


def _runs(data: bytes) -> Iterator[list[tuple[int, int]]]:
    """Base64 runs as the stretches of their lines.

    Lines of one width, of which the last may be shorter, are one run. Where the widths
    differ it may also be several, so each line is a run as well."""
    for m in _WRAPPED.finditer(data):
        lines = [x.span() for x in _LINE.finditer(data, m.start(), m.end())]
        yield lines
        widths = [j - i for i, j in lines]
        if len(set(widths[:-1])) > 1 or widths[-1] > widths[0]:
            yield from ([line] for line in lines if line[1] - line[0] >= 16)


def _unbased(layer: _Layer) -> Iterator[_Layer]:
    """The layers in base64 runs. A run may begin with characters that are not of the encoded
    part, as in a path, so it is read from each of its first four characters."""
    for lines in _runs(layer.data):
        body = b"".join(layer.data[i:j] for i, j in lines)
        places = None
        for phase in range(4):
            raw = _decoded(body[phase:])
            if not _holds(raw):
                continue
            if len(layer.begin) == 1:
                yield _Layer(raw, layer.begin, layer.end, layer.depth + 1)
                continue
            if places is None:
                places = np.concatenate([np.arange(i, j) for i, j in lines])
            # Byte i of three stands in characters 4 i / 3 and the next of the part.
            i = np.arange(len(raw))
            first = phase + i // 3 * 4 + i % 3
            yield _Layer(
                raw, layer.begin[places[first]], layer.end[places[first + 1]], layer.depth + 1
            )


def _holds(data: bytes) -> bool:
    """Whether a decoded part has a finding or may have a further layer."""
    return bool(
        b"%" in data
        or b"\\u" in data
        or _HEAD.search(data)
        or _BASE64.search(data)
        or (b"\x00" in data and (_LITTLE.search(data) or _BIG.search(data)))
        or next(matches(data), None)
    )


def _mark(layer: _Layer) -> tuple[bytes, int, int]:
    """Content and place: the same content from another place is another layer."""
    return hashlib.sha256(layer.data).digest(), int(layer.begin[0]), int(layer.end[-1])


def _below(layer: _Layer) -> Iterator[_Layer]:
    """The layers right below one, one at a time."""
    for byte, rule, decode in (
        (b"%", _PERCENT, _percent),
        (b"\\u", _UNICODE, _unicode),
    ):
        if byte in layer.data and (found := _unescape(layer, rule, decode)):
            yield found
    for stream in _streams(layer.data):
        if stream.size:
            begin, end = (np.array([x]) for x in layer.origin(stream.start, stream.end))
            for portion in _portions(stream):
                yield _Layer(portion, begin, end, layer.depth + 1)
    yield from _narrow(layer)
    yield from _unbased(layer)


def layers(data: bytes) -> Iterator[_Layer]:
    """Every layer below a text, each with those below it before the next one.

    A layer comes again only if it is met nearer to the text."""
    if not data:
        return
    # Nothing that any of the decoders begins with.
    escaped = b"%" in data or b"\\u" in data or b"\x00" in data
    if not escaped and not _BASE64.search(data) and not _HEAD.search(data):
        return
    place = np.arange(len(data))
    top = _Layer(data, place, place + 1, 0)
    seen = {_mark(top): 0}
    todo = [_below(top)]
    while todo:
        found = next(todo[-1], None)
        if found is None:
            todo.pop()
            continue
        if not found.data:
            continue
        mark = _mark(found)
        if seen.get(mark, found.depth + 1) <= found.depth:
            continue
        seen[mark] = found.depth
        yield found
        todo.append(_below(found))


def scan(data: bytes) -> list[Finding]:
    """Findings of a text, each place and kind once (the nearest layer counts)."""
    found = {(s, e, k): 0 for s, e, k in matches(data)}
    for layer in layers(data):
        for s, e, kind in matches(layer.data):
            start, end = layer.origin(s, e)
            # Text that escapes leave alone has its own findings already.
            key = (start, end, kind)
            found[key] = min(layer.depth, found.get(key, layer.depth))
    order = {k: i for i, k in enumerate(KINDS)}
    return [
        Finding(s, e, k, d)
        for (s, e, k), d in sorted(found.items(), key=lambda x: (x[0][0], order[x[0][2]], x[0][1]))
    ]


class _Points:
    """Code points before a byte of a UTF-8 text."""

    def __init__(self, data: bytes):
        self.data = data
        self.plain = data.isascii()

    def at(self, i: int) -> int:
        return i if self.plain else len(self.data[:i].decode("utf-8", "ignore"))


_MADE = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "findings array<struct<kind:string,start:long,end:long,depth:int>>"
)
_KIND = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())])
)


def redact(data: bytes, found: list[Finding], mark: bytes = b"[SECRET]") -> bytes:
    """The text with every stretch that holds a finding replaced by one mark."""
    out, at = [], 0
    i = 0
    while i < len(found):
        start, end = found[i].start, found[i].end
        i += 1
        while i < len(found) and found[i].start < end:
            end = max(end, found[i].end)
            i += 1
        out += [data[at:start], mark]
        at = end
    return b"".join([*out, data[at:]])


def _scan(texts: bool):
    def work(column: pa.Array) -> list[pa.Array]:
        counts: list[list[int]] = [[], [], []]
        sums, spans, lists, clean = [], [], [], []
        for value in column:
            text = value.as_py()
            data = (text or "").encode("utf-8", "surrogatepass")
            found = scan(data)
            point = _Points(data).at
            rows = [(f.kind, point(f.start), point(f.end), f.depth) for f in found]
            names = [f"{k}:{s}:{e}" for k, s, e, _ in rows]
            base = [n for n, r in zip(names, rows, strict=True) if not r[3]]
            for n, kind in zip(counts, KINDS, strict=True):
                n.append(sum(1 for r in rows if r[0] == kind and not r[3]))
            sums.append(hashlib.sha256(",".join(base).encode()).hexdigest())
            spans.append(",".join(names))
            lists.append(
                [dict(zip(("kind", "start", "end", "depth"), r, strict=True)) for r in rows]
            )
            if texts:
                clean.append(redact(data, found).decode("utf-8", "replace") if found else text)
        return [
            *(pa.array(n, pa.int64()) for n in counts),
            pa.array(sums, pa.string()),
            pa.array(spans, pa.string()),
            pa.array(lists, _KIND),
            *([pa.array(clean, pa.string())] if texts else []),
        ]

    return work


def scan_secrets(docs: DataFrame, text_col: str = "text", texts: bool = True) -> DataFrame:
    """The columns of `docs` with the secrets of its texts and, in clean_text, them replaced.

    n_assign, n_access, n_hex: matches of the base rules in the text itself, leftmost and not
    overlapping for each rule; base_sha256: digest of those as kind:start:end in code points,
    by start and then rule. spans lists these and the findings below encodings likewise;
    findings has them with their depth. Null text: no findings, and it stays null. Columns of
    these names in `docs` are replaced. Without `texts`, neither text comes back.
    """
    made = _MADE + (", clean_text string" if texts else "")
    return map_texts(docs, text_col, _scan(texts), made, texts)
