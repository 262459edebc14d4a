"""Secret scanning with a recursive decoding worklist.

Layer 0 is the text itself.  A worklist then unwraps every layer further:
percent-encoding, Unicode and byte escapes, base64 (both alphabets, with line
breaks, at each of its four alignments, so that a prefix such as a URL path
does not hide it), UTF-16 among decoded bytes, and gzip, zlib, bzip2 and xz
streams in bytes that any of these gave.  Every new layer is scanned again and
put on the worklist; a layer seen before is not, so the worklist reaches a
fixpoint even on streams that decode to themselves.  Each layer knows where its
characters came from in the layer above, so every match is reported as a span
of the original text; places are worked out for matches only.

Decoded bytes are read as UTF-8.  A byte that is not part of a character stays
in the layer as a mark of its own, which no kind of secret contains: it costs
only itself and is kept for the decompressors.

Kinds are ``assign`` (a key-like name with a value of eight or more
characters), ``access`` (an access-key id) and ``hex`` (a long lower-case hex
run).  Matches in a decoded layer count only where they touch decoded
characters, so they never repeat or replace layer 0's.

Layers are drawn one at a time, and inflated streams in blocks with an overlap,
each scanned and dropped before the next: memory does not grow with the
inflated size.  All members of a stream are read, and streams that begin a
stream are inflated as streams.  Base64, escapes or streams further inside a
stream are unwrapped within a block of ``BLOCK`` characters.

Defined cases: a null or empty text has no spans; a text of any length is
scanned whole; repeated rows are scanned each; an empty table gives no rows;
columns other than the id and the text are ignored by ``scan_secrets`` and kept
by ``redact_secrets``, whatever their names.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import small_batches

# The three kinds of secret, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE, MIN_ACCESS = 8, 16

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\x[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})+|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_ESCAPE_PART = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_BREAK = r"(?:\r?\n|\\r\\n|\\n)[ \t]*"
_BASE64_LINES = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}+(?:{_BREAK}[A-Za-z0-9+/_-]{{16,}}+)*+(?:{_BREAK}[A-Za-z0-9+/_-]++)?={{0,2}}")
_BREAKS = re.compile(_BREAK)
_URL_SAFE = str.maketrans("-_", "+/")
# How gzip, zlib, bzip2 and xz streams begin.
_STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00")

#: Characters per block of an inflated stream and the overlap of neighbouring blocks.
BLOCK, OVERLAP = 1 << 22, 1 << 16
#: Bytes handed to or taken from a decompressor at once.
CHUNK = 1 << 18

Span = tuple[str, int, int]


def scan(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, failing ones dropped, by start and then kind."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


class _Layer:
    """A text, the layer it was decoded from, and how its stretches map to stretches there."""

    __slots__ = ("text", "parent", "up", "decoded")

    def __init__(self, text: str, parent: _Layer | None = None, up: Callable[[int, int], tuple[int, int]] | None = None, decoded: Callable[[int, int], bool] | None = None) -> None:
        self.text, self.parent, self.up, self.decoded = text, parent, up, decoded

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The stretch of the original text that characters ``a`` to ``b`` came from."""
        layer = self
        while layer.parent is not None:
            a, b = layer.up(a, b)
            layer = layer.parent
        return a, b

    def fresh(self, a: int, b: int) -> bool:
        """Whether characters ``a`` to ``b`` hold a decoded one."""
        if self.parent is None:
            return False
        return self.decoded is None or self.decoded(a, b)

    def key(self) -> bytes:
        return _digest(self.text)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


class _Seen:
    """The layers met so far.  The same text is a layer of its own elsewhere, not where its place overlaps an earlier one's."""

    def __init__(self) -> None:
        self.places: dict[bytes, list[tuple[int, int]]] = {}

    def add(self, layer: _Layer) -> bool:
        """Whether the layer is new."""
        a, b = layer.span(0, len(layer.text))
        places = self.places.setdefault(layer.key(), [])
        i = bisect_right(places, (a, b))
        if (i and places[i - 1][1] > a) or (i < len(places) and places[i][0] < b):
            return False
        places.insert(i, (a, b))
        return True


def _text_of(data: bytes) -> str:
    """UTF-8 text; each byte that is not part of a character becomes a mark that keeps it."""
    return data.decode("utf-8", "surrogateescape")


def _n_bytes(text: str) -> int:
    return len(text.encode("utf-8", "surrogateescape"))


def _replaced(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """The layer with every match of ``pattern`` decoded.

    ``decode(match)`` gives a text or None, ``decode(match, n)`` the number of
    the match's characters that the first ``n`` characters of that text take.
    """
    parts, at, shift = [], 0, 0
    begins, ends, olds, stops = array("q"), array("q"), array("q"), array("q")  # of each decoded piece: here, and in the layer above
    for m in pattern.finditer(layer.text):
        if (new := decode(m[0])) is None:
            continue
        a, b = m.span()
        parts += [layer.text[at:a], new]
        begins.append(a + shift)
        ends.append(a + shift + len(new))
        olds.append(a)
        stops.append(b)
        shift += len(new) - (b - a)
        at = b
    if not parts:
        return None

    def back(x: int) -> int:
        i = bisect_right(begins, x) - 1
        if i < 0:
            return x
        if x >= ends[i]:
            return x - ends[i] + stops[i]
        return olds[i] + decode(layer.text[olds[i] : stops[i]], x - begins[i])

    def end(b: int) -> int:
        i = bisect_right(begins, b - 1) - 1
        if i < 0:
            return b
        if b > ends[i]:
            return b - ends[i] + stops[i]
        return olds[i] + decode(layer.text[olds[i] : stops[i]], b - begins[i])

    def up(a: int, b: int) -> tuple[int, int]:
        return back(a), end(b)

    def decoded(a: int, b: int) -> bool:
        i = bisect_right(ends, a)
        return (i < len(begins) and begins[i] < b) or layer.fresh(*up(a, b))

    return _Layer("".join([*parts, layer.text[at:]]), layer, up, decoded)


def _percent(match: str, n: int | None = None):
    text = _text_of(bytes.fromhex(match.replace("%", "")))
    return text if n is None else 3 * _n_bytes(text[:n])


def _escapes(match: str, n: int | None = None):
    """Escaped code points and bytes; a UTF-16 surrogate pair becomes one character, half a pair a mark."""
    if match.startswith("\\x"):
        text = _text_of(bytes.fromhex(match.replace("\\x", "")))
        return text if n is None else 4 * _n_bytes(text[:n])
    if match.startswith("&#"):
        code = int(match[3:-1], 16) if match[2] in "xX" else int(match[2:-1])
        if not (0 < code < 0x110000) or 0xD800 <= code < 0xE000:
            return None
        return chr(code) if n is None else n * len(match)
    codes, cuts = [], [0]
    for m in _ESCAPE_PART.finditer(match):
        code = int(m[1] or m[2], 16)
        if codes and 0xDC00 <= code < 0xE000 and 0xD800 <= codes[-1] < 0xDC00:
            codes[-1] = 0x10000 + ((codes[-1] - 0xD800) << 10) + code - 0xDC00
            cuts[-1] = m.end()
        else:
            codes.append(code)
            cuts.append(m.end())
    if n is not None:
        return cuts[n]
    return "".join("�" if 0xD800 <= c < 0xE000 or c >= 0x110000 else chr(c) for c in codes)


def _machine(data: bytes):
    """A decompressor for a stream with these first bytes; None when it is not one."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(data) > 2 and data[0] & 15 == 8 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj(15)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _inflated(source: Iterator[bytes]) -> Iterator[bytes]:
    """Chunks of a compressed stream, of all its members; nothing when it is not one."""
    todo = b""
    try:
        while True:
            while len(todo) < 6 and (more := next(source, None)) is not None:
                todo = (todo + more).lstrip(b"\0")  # padding between members
            if (machine := _machine(todo)) is None:
                return
            while not machine.eof:
                out = machine.decompress(todo, CHUNK)
                todo = getattr(machine, "unconsumed_tail", b"")
                if out:
                    yield out
                elif not todo and not machine.eof and getattr(machine, "needs_input", True):
                    if (more := next(source, None)) is None:
                        return
                    todo = more
            todo = machine.unused_data.lstrip(b"\0")
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        return


def _chunks(data: bytes, at: int) -> Iterator[bytes]:
    return (data[i : i + CHUNK] for i in range(at, len(data), CHUNK))


def _blocks(data: bytes, at: int) -> Iterator[str]:
    """Overlapping blocks of text of a compressed stream from byte ``at`` on, and of the streams nested in it."""
    depth, seen = 0, set()
    while True:
        depth += 1
        chunks: Iterator[bytes] = _chunks(data, at)
        for _ in range(depth):
            chunks = _inflated(chunks)
        decoder, rest, mark, some = codecs.getincrementaldecoder("utf-8")("surrogateescape"), "", hashlib.blake2b(digest_size=16), False
        for chunk in chunks:
            some = True
            mark.update(chunk)
            rest += decoder.decode(chunk)
            while len(rest) >= BLOCK:
                yield rest[:BLOCK]
                rest = rest[BLOCK - OVERLAP :]
        rest += decoder.decode(b"", True)
        if rest:
            yield rest
        if not some or mark.digest() in seen:  # no stream, or one that holds itself
            return
        seen.add(mark.digest())


def _byte_layers(layer: _Layer, data: bytes, up: Callable[[int, int], tuple[int, int]]) -> Iterator[_Layer]:
    """The UTF-16 readings and the compressed streams of bytes; ``up`` maps stretches of bytes to ``layer``."""
    if b"\0" in data:
        for first in (0, 1):
            units = np.frombuffer(data, "<u2", (len(data) - first) // 2, first)
            if len(units):
                points = np.where((units >= 0xD800) & (units < 0xE000), 0xFFFD, units).astype("<u4")
                yield _Layer(points.tobytes().decode("utf-32-le"), layer, lambda a, b, first=first: up(first + 2 * a, first + 2 * b))
    starts = [m.start() for m in _STREAM.finditer(data)]
    if _machine(data) is not None and starts[:1] != [0]:
        starts.insert(0, 0)
    for at in starts:
        whole = up(at, len(data))
        for block in _blocks(data, at):
            yield _Layer(block, layer, lambda a, b, whole=whole: whole)


def _base64_layers(layer: _Layer) -> Iterator[_Layer]:
    """The readings of every base64 run, alone and with the lines that follow it, at each alignment."""
    for pattern in (_BASE64, _BASE64_LINES):
        for m in pattern.finditer(layer.text):
            lines, at = array("q"), array("q")  # where the lines' characters begin: among all, and in the text
            pieces, a = [], m.start()
            for cut in [*_BREAKS.finditer(layer.text, a, m.end()), None]:
                piece = layer.text[a : cut.start() if cut else m.end()]
                lines.append(lines[-1] + len(pieces[-1]) if pieces else 0)
                at.append(a)
                pieces.append(piece)
                a = cut.end() if cut else a
            if pattern is _BASE64_LINES and len(pieces) == 1:
                continue
            run = "".join(pieces).rstrip("=").translate(_URL_SAFE)
            yield from _aligned(layer, run, lines, at, m.end())


def _aligned(layer: _Layer, run: str, lines: array, at: array, stop: int) -> Iterator[_Layer]:
    def place(i: int) -> int:
        k = bisect_right(lines, i) - 1
        return at[k] + i - lines[k]

    for first in range(4):
        n = len(run) - first
        n -= n % 4 == 1
        if n < 8:
            return
        data = base64.b64decode(run[first : first + n] + "=" * (-n % 4))

        def up(a: int, b: int, first=first, n=n, size=len(data)) -> tuple[int, int]:
            """Bytes to characters; the end of the last byte takes the padding along."""
            return place(first + a * 4 // 3), (stop if b >= size else place(first + min((b * 4 + 2) // 3, n) - 1) + 1)

        yield from _byte_layers(layer, data, up)  # first, as their places are the wider ones
        text = _text_of(data)
        yield _Layer(text, layer, lambda a, b, up=up, text=text: up(_n_bytes(text[:a]), _n_bytes(text[:b])))


_ENDS = re.compile(r"[^!-~]")
_BINARY = re.compile("[\0\x01\x8b\x9c\xda\xfd\udc8b\udc9c\udcda\udcfd]|BZh|x\\^")


def _pieces(layer: _Layer) -> Iterator[_Layer]:
    """The readings as bytes of a decoded layer's stretches between white space that was not itself decoded."""
    text = layer.text
    if layer.parent is None or not _BINARY.search(text):
        return
    if layer.decoded is None:
        cuts = [-1, len(text)]
    else:
        cuts = [-1, *(m.start() for m in _ENDS.finditer(text) if not layer.fresh(m.start(), m.end())), len(text)]
    for a, b in zip(cuts, cuts[1:]):
        a += 1
        piece = text[a:b]
        if not _BINARY.search(piece) or not layer.fresh(a, b):
            continue
        readings = [piece]
        if "+" in piece:
            readings.append(re.sub(r"\+", lambda m, a=a: "+" if layer.fresh(a + m.start(), a + m.end()) else " ", piece))  # as forms write a space
        for reading in readings:
            data = reading.encode("utf-8", "surrogateescape")
            yield from _byte_layers(layer, data, lambda x, y, a=a, data=data: (a + len(_text_of(data[:x])), a + len(_text_of(data[:y]))))
        if any("\x80" <= c <= "\xff" for c in piece) and max(piece) <= "\xff":  # bytes written as code points
            yield from _byte_layers(layer, piece.encode("latin-1"), lambda x, y, a=a: (a + x, a + y))


def _unwrapped(layer: _Layer) -> Iterator[_Layer]:
    text = layer.text
    if "%" in text and (new := _replaced(layer, _PERCENT, _percent)):
        yield new
    if ("\\" in text or "&#" in text) and (new := _replaced(layer, _ESCAPE, _escapes)):
        yield new
    yield from _base64_layers(layer)
    yield from _pieces(layer)


def find_secrets(text: str | None) -> tuple[list[Span], list[Span]]:
    """(spans of layer 0, further spans found in decoded layers), both in order and in code points of ``text``."""
    if not text:
        return [], []
    base = scan(text)
    if not ("%" in text or "\\" in text or "&#" in text or _BASE64.search(text)):
        return base, []
    found: dict[tuple[str, bytes], set[tuple[int, int]]] = {}
    seen = _Seen()
    work = [_unwrapped(_Layer(text))]  # depth first: a layer of each depth at a time
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        if not layer.text or not seen.add(layer):
            continue
        for kind, a, b in scan(layer.text):
            if layer.fresh(a, b):
                found.setdefault((kind, _digest(layer.text[a:b])), set()).add(layer.span(a, b))
        work.append(_unwrapped(layer))
    more = {(kind, a, b) for (kind, _), spans in found.items() for a, b in _outermost(spans)}
    return base, _in_order(list(more - set(base)))


def _outermost(spans: set[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans not inside another: one match may be read by several ways, say from a stream and from bytes it stores as they are."""
    last = -1
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if b > last:
            last = b
            yield a, b


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str | None, mark: str = "[{kind}]") -> str | None:
    """``text`` with every span, merged where spans overlap, replaced by its first kind's mark."""
    if not text:
        return text
    base, more = find_secrets(text)
    if not base and not more:
        return text
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in _in_order(base + more):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], mark.format(kind=kind)]
        at = b
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_decoded): one row per input row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digests, joined = [], []
            for text in batch.column(1).to_pylist():
                base, more = find_secrets(text)
                kinds = [s[0] for s in base]
                for k, name in enumerate(KINDS):
                    counts[k].append(kinds.count(name))
                counts[3].append(len(more))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(_in_order(base + more) if more else base))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(digests, pa.string()), pa.array(joined, pa.string()), pa.array(counts[3], pa.int64())],
                [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded"],
            )

    docs = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return docs.mapInArrow(run, f"`{id_col}` long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long")


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with all found spans of ``text_col`` replaced; ``length_col``, if given, is set to the new length in code points."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([redacted(t) for t in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if length_col:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.coalesce(F.length(text_col).cast(kind), F.col(length_col)))
    return out
