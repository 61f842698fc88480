"""Secret scans with a recursive decoding worklist.

The text is scanned as it stands; then every layer that can be unwrapped from
it -- percent-encoded URLs, Unicode escapes, base64 tokens, and zlib or gzip
streams inside those -- becomes an item of a worklist, is scanned in turn and
unwrapped further, until no new layer appears.  Each layer carries a mapping
of its characters to the code points of the document, and what is found in it
is reported at the place it came from.  A layer equal to an earlier one in
content and mapping is not entered again, so cycles end.  All that a base64
token holds comes from the token's place: equal tokens are unwrapped once, and
every place gets the spans.

All patterns are ASCII, so layers are bytes: a document's UTF-8, and whatever
a token or escape decodes to, text or not.  A binary layer is dropped only
where a byte test says that it holds no pattern and no further layer.

A token is decoded at all four alignments, so what stands before it in its run
(``path/``, ``id_``) does not hide it; its place then begins behind the first
of '/', '_' and '-' that fits the alignment, if all found lies behind it.  Runs are also joined over single
line breaks, blanks beside them left out; what crosses lines is reported from
its first line's run to its last.

Compressed streams are unpacked in chunks, whatever they hold, with all their
members; of a stream that is cut off or broken, what it yields is scanned.  A
layer of more than ``IN_MEMORY`` bytes is spilled to a temporary file and
mapped, so a worker's memory does not follow it.  Only a caller who gives
``max_layer`` makes streams of more bytes opaque.  Texts themselves are
scanned whole, whatever their length.

Defined cases: NULL and empty text have no span; equal spans of one kind that
several layers give are one span; repeated rows give repeated results; an
empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import binascii
import hashlib
import mmap
import re
import tempfile
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
# The patterns and least lengths of the base spans.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

MIN_BASE64 = 16
IN_MEMORY = 1 << 24     # bytes of a layer beyond which it is spilled
CHUNK = 1 << 16
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_BASE64)
_LINE = re.compile(rb"[A-Za-z0-9+/_-]+")
_LINES = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?+\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_PART = re.compile(rb"(?<=[/_-])[A-Za-z0-9+]")
_STANDARD = bytes.maketrans(b"-_", b"+/")
_STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]")
_URL = re.compile(rb"%([0-9A-Fa-f]{2})")
_ESCAPE = re.compile(rb"\\u([dD][89abAB][0-9a-fA-F]{2})\\u([dD][c-fC-F][0-9a-fA-F]{2})"
                     rb"|\\u\{([0-9a-fA-F]{1,6})\}|\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})")


def _marks(chars: bytes) -> bytes:
    return bytes(0x78 if c in chars else 0x20 for c in range(256))


_IN_HEX = _marks(b"0123456789abcdef")
_IN_BASE64 = _marks(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_CONTINUED = bytes(range(0x80, 0xC0))    # bytes of UTF-8 that begin no code point


def _blocks(data, overlap: int):
    """Parts of ``data``; what is at most ``overlap`` + 1 long lies whole in one."""
    if len(data) <= IN_MEMORY:
        yield data if isinstance(data, bytes) else data[:]
        return
    for at in range(0, len(data), CHUNK):
        yield data[at:at + CHUNK + overlap]


def _worded(data) -> bool:
    return any(w in low for low in (b.lower() for b in _blocks(data, 8)) for w in _WORDS)


def _run(data, marks: bytes, least: int) -> bool:
    return any(b"x" * least in b.translate(marks) for b in _blocks(data, least))


def scan(data) -> list[tuple[str, int, int]]:
    """Base spans (kind, start, end) in bytes.  The byte searches only tell
    that a kind cannot occur."""
    out = []
    if _worded(data):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(data) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if data.find(b"AKIA") >= 0:
        out += [("access", *m.span()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= MIN_ACCESS]
    if _run(data, _IN_HEX, MIN_HEX):
        out += [("hex", *m.span()) for m in _HEX.finditer(data) if m.end() - m.start() >= MIN_HEX]
    return out


def _escaped(data) -> bool:
    return data.find(b"\\u") >= 0 or data.find(b"\\x") >= 0


def _possible(data) -> bool:
    """False only if ``data`` holds no secret and no further layer."""
    return (_run(data, _IN_BASE64, MIN_BASE64) or _worded(data) or _escaped(data) or _STREAM.search(data) is not None
            or (data.find(b"%") >= 0 and _URL.search(data) is not None)
            or (data.find(b"\n") >= 0 and any(m.end() - m.start() > MIN_BASE64 for m in _LINES.finditer(data))))


def _gathered(chunks):
    """The chunks as bytes, or as a mapped temporary file if they are large."""
    parts, size, file = [], 0, None
    for c in chunks:
        parts.append(c)
        size += len(c)
        if size > IN_MEMORY:
            file = file or tempfile.TemporaryFile()
            file.writelines(parts)
            parts = []
    if file is None:
        return b"".join(parts)
    file.writelines(parts)
    file.flush()
    return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def _cut(data, start: int, end: int):
    """data[start:end] in chunks."""
    for at in range(start, end, CHUNK):
        yield data[at:min(at + CHUNK, end)]


class Layer:
    """Decoded bytes.  ``pieces`` are (start, origin start, origin end,
    straight): from ``start`` on, bytes come one to one (straight) or all
    together from the origin's span."""

    def __init__(self, data, pieces: list[tuple[int, int, int, bool]]):
        self.data, self.pieces, self.starts = data, pieces, [p[0] for p in pieces]

    def key(self) -> bytes:
        return hashlib.sha1(hashlib.sha1(self.data).digest() + repr(self.pieces).encode()).digest()

    def plain(self) -> bool:
        """Whether it is the document itself."""
        return len(self.pieces) == 1 and self.pieces[0][3]

    def single(self) -> bool:
        """Whether everything in it comes from one place."""
        return len(self.pieces) == 1 and not self.pieces[0][3]

    def origin(self, start: int, end: int) -> tuple[int, int]:
        a = self.pieces[bisect_right(self.starts, start) - 1]
        b = self.pieces[bisect_right(self.starts, max(end - 1, start)) - 1]
        return (a[1] + start - a[0] if a[3] else a[1]), (b[1] + end - b[0] if b[3] else b[2])


def _rewritten(layer: Layer, found) -> Layer | None:
    """The layer with each ((start, end), decoded) put in place; None if
    nothing was found."""
    pieces, at, size = [], 0, 0
    track = not layer.single()

    def straight(start: int):
        """This layer from ``at`` to ``start``: cut where its origin's pieces change."""
        nonlocal size
        if track:
            cut = [at] + [s for s in layer.starts[bisect_right(layer.starts, at):bisect_left(layer.starts, start)]]
            for i, s in enumerate(cut):
                e = cut[i + 1] if i + 1 < len(cut) else start
                p = layer.pieces[bisect_right(layer.starts, s) - 1]
                pieces.append((size + s - at, p[1] + s - p[0], p[1] + e - p[0], True) if p[3]
                              else (size + s - at, p[1], p[2], False))
        size += start - at
        return _cut(layer.data, at, start)

    def parts():
        nonlocal at, size
        for (start, end), decoded in found:
            if at < start:
                yield from straight(start)
            if track:
                pieces.append((size, *layer.origin(start, end), False))
            yield decoded
            size += len(decoded)
            at = end
        if 0 < at < len(layer.data):
            yield from straight(len(layer.data))

    data = _gathered(parts())
    return Layer(data, pieces if track else layer.pieces) if at else None


def _url(layer: Layer) -> Layer | None:
    return _rewritten(layer, ((m.span(), bytes([int(m[1], 16)])) for m in _URL.finditer(layer.data)))


def _unescaped(m: re.Match) -> bytes:
    if m[1]:
        return chr(0x10000 + ((int(m[1], 16) - 0xD800) << 10) + int(m[2], 16) - 0xDC00).encode()
    code = int(m[3] or m[4] or m[5], 16)
    return (chr(code) if code < 0xD800 or 0xDFFF < code <= 0x10FFFF else "�").encode()


def _unicode(layer: Layer) -> Layer | None:
    return _rewritten(layer, ((m.span(), _unescaped(m)) for m in _ESCAPE.finditer(layer.data)))


def _before_fault(box, part: bytes) -> list[bytes]:
    """What a stream yields up to the byte that breaks it."""
    out = []
    try:
        for i in range(len(part)):
            out.append(box.decompress(part[i:i + 1]))
    except zlib.error:
        pass
    return out


def _streams(data, max_layer: int | None):
    """(start, end, content) of each zlib or gzip stream in ``data``; members
    that follow one another are one stream.  A broken one has what it yields."""
    at = 0
    while m := _STREAM.search(data, at):
        end = again = m.start() + 1
        size = 0

        def chunks():
            nonlocal end, again, size
            box, place = zlib.decompressobj(47), m.start()
            while True:
                part = box.unconsumed_tail
                if not part:
                    part = data[place:place + CHUNK]
                    place += len(part)
                spare = box.copy()
                try:
                    out = [box.decompress(part, CHUNK)]
                except zlib.error:
                    out, end = _before_fault(spare, part), place
                size += sum(map(len, out))
                if max_layer is not None and size > max_layer:
                    return
                yield from out
                if end == place:
                    return
                if box.eof:
                    again = place - len(box.unused_data) - len(box.unconsumed_tail)
                    if not _STREAM.match(data, again):
                        end = again
                        return
                    box, place = zlib.decompressobj(47), again
                elif not part and not out[0]:
                    end = place
                    return

        content = _gathered(chunks())
        if max_layer is not None and size > max_layer:
            content = b""
        if len(content):
            yield m.start(), end, content
        at = again


def _tokens(data):
    """(lines, end) of each base64 token of one line, then of several joined:
    the lines' spans and where the padding ends."""
    for m in _BASE64.finditer(data):
        yield [_LINE.match(data, m.start()).span()], m.end()
    if data.find(b"\n") >= 0:
        for m in _LINES.finditer(data):
            if m.end() - m.start() > MIN_BASE64:
                yield [line.span() for line in _LINE.finditer(data, *m.span())], m.end()


def _binary(body: bytes) -> bytes:
    """Base64 decoded as far as whole bytes go."""
    body = body[:-1] if len(body) % 4 == 1 else body
    return binascii.a2b_base64(body + b"=" * (-len(body) % 4))


def _decoded(data, lines: list[tuple[int, int]]) -> list:
    """The token's content with its first 0, 1, 2 and 3 characters left out,
    empty where it cannot hold anything."""
    if sum(e - s for s, e in lines) <= IN_MEMORY:
        body = b"".join(data[s:e] for s, e in lines).translate(_STANDARD)
        found = [_binary(body[skip:]) for skip in range(4)]
        if not _possible(b"\0".join(found)):
            return []
    else:
        def chunks(skip: int):
            rest = b""
            for s, e in lines:
                for part in _cut(data, s, e):
                    rest += part.translate(_STANDARD)
                    if len(rest) >= skip + 4:
                        n = (len(rest) - skip) // 4 * 4 + skip
                        yield _binary(rest[skip:n])
                        rest, skip = rest[n:], 0
            yield _binary(rest[skip:])

        found = [_gathered(chunks(skip)) for skip in range(4)]
    return [f if _possible(f) else b"" for f in found]


def _part(data, start: int, end: int, skip: int) -> int:
    """Where in the run start:end a token of that alignment can begin."""
    if skip:
        for m in _PART.finditer(data, start, end):
            if (m.start() - start) % 4 == skip:
                return m.start()
    return start


def _kinds(content, max_layer: int | None, known: dict) -> frozenset[str]:
    """Kinds in a token's content and all layers in it."""
    digest = hashlib.sha1(content).digest()
    if digest not in known:
        inner = _walk(Layer(content, [(0, 0, 0, False)]), max_layer, known)
        known[digest] = frozenset(kind for kind, _, _ in inner)
    return known[digest]


def _line_pieces(lines: list[tuple[int, int]], skip: int) -> list[tuple[int, int, int, bool]]:
    """Pieces of a token's content whose origins are numbers of lines."""
    pieces, c = [(0, 0, 0, False)], -skip
    for i, (s, e) in enumerate(lines[:-1]):
        c += e - s
        if c <= 0:
            pieces = [(0, i + 1, i + 1, False)]
            continue
        if c % 4:  # a byte of both lines
            at = 3 * c // 4
            first = pieces.pop()[1] if pieces[-1][0] == at else i
            pieces.append((at, first, i + 1, False))
        pieces.append((-(-3 * c // 4), i + 1, i + 1, False))
    return pieces


def _walk(first: Layer, max_layer: int | None, known: dict) -> set[tuple[str, int, int]]:
    """Spans of a layer and of all layers in it.  ``known``: the kinds in a
    token, by the digest of its content."""
    spans, work, seen = set(), [first], set()
    while work:
        layer = work.pop()
        data = layer.data
        spans.update((kind, *layer.origin(s, e)) for kind, s, e in scan(data))
        new = []
        if data.find(b"%") >= 0:
            new.append(_url(layer))
        if _escaped(data):
            new.append(_unicode(layer))
        if not layer.plain():
            new += [Layer(content, [(0, *layer.origin(s, e), False)]) for s, e, content in _streams(data, max_layer)]
        if data.find(b"\n") >= 0 or _run(data, _IN_BASE64, MIN_BASE64):
            for lines, end in _tokens(data):
                for skip, content in enumerate(_decoded(data, lines)):
                    if not len(content):
                        continue
                    if layer.single():
                        new.append(Layer(content, layer.pieces))
                    elif len(lines) > 1:
                        inner = _walk(Layer(content, _line_pieces(lines, skip)), max_layer, known)
                        spans.update((kind, *layer.origin(lines[i][0], end if j == len(lines) - 1 else lines[j][1]))
                                     for kind, i, j in inner if i < j)
                    else:
                        kinds = _kinds(content, max_layer, known)
                        if kinds:
                            start = lines[0][0]
                            part = _part(data, *lines[0], skip)
                            if part > start and (len(content) > IN_MEMORY or not kinds <= _kinds(
                                    content[3 * (part - start - skip) // 4:], max_layer, known)):
                                part = start
                            spans.update((kind, *layer.origin(part, end)) for kind in kinds)
        new = [inner for inner in new if inner is not None]
        if new:
            seen.add(layer.key())
        for inner in new:
            if (key := inner.key()) not in seen:
                seen.add(key)
                work.append(inner)
    return spans


def _points(raw: bytes, spans) -> list[tuple[str, int, int]]:
    """Spans in bytes of a UTF-8 text as spans in code points."""
    if raw.isascii():
        return list(spans)
    point, at, n = {}, 0, 0
    for p in sorted({p for _, s, e in spans for p in (s, e)}):
        n += len(raw[at:p].translate(None, _CONTINUED))
        point[p], at = n, p
    return [(kind, point[s], point[e]) for kind, s, e in spans]


def all_spans(text: str | bytes, max_layer: int | None = None) -> tuple[list, list]:
    """(base spans, all spans) in code points of a text or its UTF-8, each
    sorted by start, kind as listed, end."""
    raw = text.encode() if isinstance(text, str) else text

    def key(span):
        return span[1], KINDS.index(span[0]), span[2]

    spans = _walk(Layer(raw, [(0, 0, len(raw), True)]), max_layer, {})
    return sorted(_points(raw, scan(raw)), key=key), sorted(_points(raw, spans), key=key)


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


SCHEMA = ("doc_id long, base array<struct<kind:string,start:long,end:long>>, "
          "spans array<struct<kind:string,start:long,end:long>>")
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_layer: int | None = None) -> DataFrame:
    """One row per document: its base spans and all its spans, in code points
    of the document, end exclusive."""
    def run(batches):
        for b in batches:
            found = [all_spans(raw, max_layer) if raw else ([], []) for raw in b.column(1).to_pylist()]
            as_rows = [[[{"kind": k, "start": s, "end": e} for k, s, e in f[i]] for f in found] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(as_rows[0], _SPANS), pa.array(as_rows[1], _SPANS)],
                                             names=["doc_id", "base", "spans"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("binary").alias("raw")).mapInArrow(run, SCHEMA)
