"""Secret scans through nested encodings.

Every text is a layer. A worklist takes a layer, scans it, and puts on the list
what each decoder makes of it: URL escapes, Unicode escapes, base64 runs and
compressed base64 runs are unwrapped in place, so an assignment whose value
alone is encoded is still seen as one. Bytes that are not UTF-8 are replaced one
by one, and base64 runs that hardly read are layers of their own. It ends when no decoder gives a layer
that was not seen before, which also ends cycles. Each layer carries, for every
code point, the code points of the original text it stems from, so spans always
refer to the original.

The work is done document by document in the tasks; memory holds one text and
its layers. Of compressed runs a layer holds at most ``MAX_UNPACKED`` unpacked
bytes. What unpacks to more is read as a stream (:class:`Streams`) of any length:
secrets in it are reported as spans of the whole run. :func:`scan` and
:func:`secret_report` count such runs in ``n_refused``, :func:`redact` masks all
of them.

Defined results: null text counts as empty; spans found on several layers count
once; equal rows give equal results; other columns are ignored by :func:`scan`
and returned unchanged by :func:`redact`.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from stormfare.llm.text import only

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("passw", "secret", "token", "api_key", "apikey")
#: Runs of the least length, each taken whole: what the base patterns find and do not drop.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
#: Runs over single line breaks, as wrapped at some column.
BREAK = r"[ \t]*+\r?\n[ \t]*+"
BLOCK = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-](?:(?:{BREAK})?+[A-Za-z0-9+/_-]){{11,}}+={{0,2}}")
URL_SAFE = str.maketrans("-_", "+/")
#: First bytes of gzip, zlib, bzip2 and xz data.
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00")
CHUNK = 64 << 10
MAX_UNPACKED = 1 << 20
#: Characters of a window of a stream, of those read again where it cannot be cut, and of the text around a run.
WINDOW, OVERLAP, EDGE = 1 << 20, 32 << 10, 4 << 10
#: Unpacked bytes that show packed data to be such.
MIN_OPEN = 64
SPACES = re.compile(" {3,}")
#: Where no pattern goes on: behind characters of no pattern, in blank lines, between short plain words.
SAFE = re.compile(r"""[^A-Za-z0-9+/_.=:\x20"'%\\\t\r\n-]|\n\n|(?<=[A-Za-z]\x20)[A-Za-z]{1,10}(?=\x20[A-Za-z]{1,10}\x20[A-Za-z])""")
MASK = "[secret]"
#: Control characters other than white space, and bytes that are not UTF-8.
UNREADABLE = re.compile("[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f\udc80-\udcff]")
#: The share of readable characters that lets a base64 run be replaced by what it says.
READABLE = 0.85
BAD_BYTE = re.compile("[\udc80-\udcff]")
#: What decoded bytes need to hold for a secret, or a run that hides one, to be in them.
WORTH = re.compile(
    rb"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f]{2}|"
    rb"[A-Za-z0-9+/_-](?:(?:[ \t]*+\r?\n[ \t]*+)?+[A-Za-z0-9+/_-]){11}")

_IS_HEX = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))


class Layer:
    """A text, and for each of its code points the range of the original it stems from."""

    __slots__ = ("text", "starts", "ends")

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def original(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def alone(self, text: str, first: np.ndarray, last: np.ndarray) -> Layer:
        """A layer of a new text, whose code points have these source ranges here."""
        if self.starts is not None:
            first, last = self.starts[first], self.ends[last - 1]
        return Layer(text, first, last)

    def replaced(self, parts: list[tuple[int, int, str, np.ndarray, np.ndarray]]) -> Layer:
        """The layer with ranges replaced; each new code point has its source range here."""
        texts, starts, ends, at = [], [], [], 0

        def keep(a: int, b: int) -> None:
            if b > a:
                texts.append(self.text[a:b])
                starts.append(np.arange(a, b))
                ends.append(np.arange(a + 1, b + 1))

        for a, b, new, new_starts, new_ends in parts:
            keep(at, a)
            texts.append(new)
            starts.append(new_starts)
            ends.append(new_ends)
            at = b
        keep(at, len(self.text))
        return self.alone("".join(texts), np.concatenate(starts), np.concatenate(ends))


def scan_layer(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets that stand in a text as it is."""
    found = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if b"1" * 24 in text.encode("latin-1", "replace").translate(_IS_HEX):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def _as_text(data: bytes) -> str:
    """Bytes as UTF-8; each byte that is not is a surrogate of its own, so positions can be told."""
    return data.decode("utf-8", "surrogateescape")


def _readable(text: str) -> float:
    """The share of characters that read."""
    return 1 - len(UNREADABLE.findall(text)) / len(text)


class TooLarge(Exception):
    """Compressed runs unpack to more than a layer may hold."""


def _unpacked(data: bytes, at: int) -> Iterator[bytes]:
    """What the gzip, zlib, bzip2 and xz members from a place on unpack to, in chunks; where to go on, whether none is cut off."""
    while m := PACKED.match(data, at):
        is_zlib = m[0][:1] in b"\x1f\x78"
        machine = (zlib.decompressobj(47) if is_zlib
                   else bz2.BZ2Decompressor() if m[0][:1] == b"B" else lzma.LZMADecompressor())
        place, left = at, b""
        try:
            while not machine.eof:
                given, left = left, b""
                if not given and (is_zlib or machine.needs_input):
                    given = data[place:place + CHUNK]
                    place += len(given)
                out = machine.decompress(given, CHUNK)
                if is_zlib:
                    left = machine.unconsumed_tail
                if out:
                    yield out
                elif not given and not left:
                    break
        except (zlib.error, OSError, lzma.LZMAError, EOFError):
            pass
        if not machine.eof:
            return m.end(), False
        # Members may be padded with zeros.
        at = place = place - len(machine.unused_data)
        while data[place:place + 1] == b"\0":
            place += 1
        if PACKED.match(data, place):
            at = place
    return at, True


def _unpack(data: bytes, at: int, most: int) -> tuple[bytes, int, bool]:
    """The members from a place on, in one piece."""
    out, total, chunks = [], 0, _unpacked(data, at)
    while True:
        try:
            out.append(next(chunks))
        except StopIteration as end:
            return b"".join(out), *end.value
        total += len(out[-1])
        if total > most:
            raise TooLarge


def _whole(a: int, b: int, text: str) -> tuple:
    """A replacement all of whose code points stem from the whole range."""
    return a, b, text, np.full(len(text), a), np.full(len(text), b)


def _by_bytes(a: int, text: str, first, last) -> tuple[str, np.ndarray, np.ndarray]:
    """Source ranges of the code points of decoded bytes, from those of the bytes."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    lengths[(code >= 0xDC80) & (code <= 0xDCFF)] = 1
    begin = np.cumsum(lengths) - lengths
    return BAD_BYTE.sub("\ufffd", text), a + first(begin), a + last(begin + lengths - 1)


def from_url(text: str) -> list[tuple]:
    parts = []
    for m in URL_RUN.finditer(text) if "%" in text else ():
        plain = _as_text(bytes.fromhex(m[0].replace("%", "")))
        parts.append((m.start(), m.end(), *_by_bytes(
            m.start(), plain, lambda k: 3 * k, lambda k: 3 * k + 3)))
    return parts


def from_escapes(text: str) -> list[tuple]:
    if "\\" not in text:
        return []
    found = [(m.start(), m.end(), int(m[0][2:], 16)) for m in ESCAPE.finditer(text)]
    parts, i = [], 0
    while i < len(found):
        a, b, code = found[i]
        i += 1
        if 0xD800 <= code < 0xDC00 and i < len(found) and found[i][0] == b and 0xDC00 <= found[i][2] < 0xE000:
            code = 0x10000 + ((code - 0xD800) << 10) + found[i][2] - 0xDC00
            b = found[i][1]
            i += 1
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            parts.append(_whole(a, b, chr(code)))
    return parts


def _base64_bytes(body: str) -> bytes:
    """What a run without its closing signs decodes to; a last character of its own says nothing."""
    body = body[:len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _plain_part(start: int, end: int, plain: str, places: np.ndarray) -> tuple:
    """A replacement by decoded bytes, from the places of the run's characters."""
    return start, end, *_by_bytes(
        0, plain, lambda k: places[k * 8 // 6], lambda k: places[(k * 8 + 7) // 6] + 1)


def from_base64(text: str) -> tuple[list, list, list]:
    """Runs that read without a flaw, runs and blocks that mostly do, and what else may hide something.

    A block is taken whole, and from each of its first four characters: whatever
    stands before the encoded bytes, one of these is on their grid.
    """
    clear, mostly, rest = [], [], []
    for block in BLOCK.finditer(text):
        body, places, runs = _characters(block)
        for m in runs:
            run = m[0].rstrip("=")
            data = _base64_bytes(run.translate(URL_SAFE))
            plain = _as_text(data)
            share = _readable(plain)
            if share >= READABLE:
                start = block.start() + m.start()
                part = _plain_part(start, block.start() + m.end(), plain, np.arange(start, start + len(run)))
                mostly.append(part)
                if share == 1 and len(run) % 4 != 1:
                    clear.append(part)
        for at in range(4):
            data = _base64_bytes(body[at:])
            if at and not WORTH.search(data):
                continue
            plain = _as_text(data)
            if at == 0 and _readable(plain) >= READABLE:
                part = _plain_part(block.start(), block.end(), plain, places)
                while mostly and mostly[-1][0] >= block.start():
                    mostly.pop()
                mostly.append(part)
            elif WORTH.search(data):
                rest.append(_plain_part(block.start(), block.end(), plain, places[at:]))
    return clear, mostly, rest


def _characters(block: re.Match) -> tuple[str, np.ndarray, list[re.Match]]:
    """The characters of a block without its line breaks, their places, and its unbroken runs."""
    whole = block[0].rstrip("=")
    parts = whole.split()
    if len(parts) == 1:
        places = np.arange(block.start(), block.start() + len(whole))
    else:
        places = block.start() + np.flatnonzero(np.frombuffer(whole.encode(), np.uint8) > 32)
    return "".join(parts).translate(URL_SAFE), places, list(BASE64_RUN.finditer(block[0]))


def from_compressed(text: str, refused: list[tuple[int, int, bytes]]) -> tuple[list, list]:
    """Replacements by what compressed data in base64 unpacks to: one for each block, and the further ones.

    Together they hold at most ``MAX_UNPACKED`` bytes; runs beyond are ``refused``: start, end, packed bytes.
    """
    parts, rest, room = [], [], MAX_UNPACKED
    for block in BLOCK.finditer(text):
        body, places, _ = _characters(block)
        first = True
        for grid in range(4):
            data, done = _base64_bytes(body[grid:]), 0
            while m := PACKED.search(data, done):
                start = int(places[grid + m.start() * 8 // 6])
                try:
                    out, done, whole = _unpack(data, m.start(), room)
                except TooLarge:
                    refused.append((start, block.end(), data[m.start():]))
                    break
                end = block.end() if not whole or done >= len(data) else int(places[grid + (done * 8 - 1) // 6]) + 1
                if whole and out or WORTH.search(out):
                    room -= len(out)
                    part = _whole(start, end, BAD_BYTE.sub("\ufffd", _as_text(out)))
                    if first and whole:
                        parts.append(part)
                        first = False
                    else:
                        rest.append(part)
    return parts, rest


class Streams:
    """Kinds of secrets in runs too large to be held, each run read once, window by window.

    All that a run unpacks to stands for the whole run, so only the kinds matter,
    not the places. Windows end where no pattern and no encoded run can go on;
    where there is no such place the next window begins with the last ``OVERLAP``
    characters again, in which what makes a secret fits unless it is encoded over
    and over, or is packed: a packed run within the run is held until it ends.
    """

    def __init__(self):
        self.known: dict[bytes, tuple[set[int], str, str]] = {}

    def read(self, data: bytes) -> tuple[set[int], str, str]:
        """Kinds found, and the first and last characters, which may belong to a secret of the text around."""
        name = hashlib.sha256(data).digest()
        if name not in self.known:
            self.known[name] = set(), "", ""  # a run that holds itself ends here
            self.known[name] = self._read(data)
        return self.known[name]

    def _read(self, data: bytes) -> tuple[set[int], str, str]:
        decoder = codecs.getincrementaldecoder("utf-8")("surrogateescape")
        kinds, seen, head, buffer, enough = set(), set(), None, "", WINDOW

        def look(part: str) -> None:
            if part not in seen and len(kinds) < len(KINDS):
                if len(seen) < 4:  # windows that repeat, as in a run of one character
                    seen.add(part)
                kinds.update(kind for _, kind, _ in examine(part, self)[1])

        for chunk in _unpacked(data, 0):
            # No pattern tells two spaces from more.
            buffer += SPACES.sub("  ", BAD_BYTE.sub("\ufffd", decoder.decode(chunk)))
            if len(buffer) >= enough:
                head = buffer[:EDGE] if head is None else head
                end, keep = _cut(buffer)
                look(buffer[:end])
                buffer = buffer[keep:]
                enough = max(WINDOW, 2 * len(buffer))
        look(buffer)
        return kinds, buffer[:EDGE] if head is None else head, buffer[-EDGE:]


def _cut(buffer: str) -> tuple[int, int]:
    """Where a window ends, and from where on the next one begins."""
    for tail in (EDGE, len(buffer)):
        begin, last = max(0, len(buffer) - tail), None
        for last in SAFE.finditer(buffer, begin):
            pass
        if last:
            return last.end(), last.end()
    open_run = None
    for open_run in BLOCK.finditer(buffer):
        pass
    if open_run and open_run.end() == len(buffer):
        body, _, _ = _characters(open_run)
        if any(_goes_on(_base64_bytes(body[grid:])) for grid in range(4)):
            begin = open_run.start()
            return begin, max(0, begin - OVERLAP)
    return len(buffer), max(0, len(buffer) - OVERLAP)


def _goes_on(data: bytes) -> bool:
    """Whether packed data begins here that the end of the bytes cuts off."""
    at = 0
    while m := PACKED.search(data, at):
        size, chunks = 0, _unpacked(data, m.start())
        try:
            while True:
                size += len(next(chunks))
        except StopIteration as end:
            at, whole = end.value
        if size >= MIN_OPEN and not whole:
            return True
        at = max(at, m.end())
    return False


def _inner_layers(layer: Layer, refused: list[tuple[int, int, bytes]]) -> Iterator[Layer]:
    """What each decoder makes of a layer: runs replaced in place, runs that hardly read as layers of their own."""
    clear, mostly, rest = from_base64(layer.text)
    packed, more = from_compressed(layer.text, refused)
    # A name that happens to decode stays a name in the layer of the clear runs.
    in_place = [from_url(layer.text), from_escapes(layer.text), clear, packed]
    if len(mostly) != len(clear) or any(a[:2] != b[:2] for a, b in zip(mostly, clear)):
        in_place.append(mostly)
    for parts in in_place:
        if parts:
            yield layer.replaced(parts)
    for _, _, text, first, last in rest + more:
        yield layer.alone(text, first, last)


def examine(text: str, streams: Streams | None = None) -> tuple[list, list, list[tuple[int, int]]]:
    """Base spans, all spans, both (start, kind, end) in order, and the ranges (start, end) too large to be held.

    With ``streams`` such ranges are read through, and the spans hold what they hide.
    """
    base = sorted(scan_layer(text))
    spans, seen, work, refused = set(base), {(text, (0, len(text)))}, [Layer(text)], set()
    while work:
        layer, left = work.pop(), []
        for inner in _inner_layers(layer, left):
            # One text may stand at several places, as a layer of its own at each.
            known = inner.text, inner.original(0, len(inner.text)) if inner.text else None
            if known in seen:
                continue
            seen.add(known)
            work.append(inner)
            for start, kind, end in scan_layer(inner.text):
                first, last = inner.original(start, end)
                spans.add((first, kind, last))
        for a, b, data in left:
            refused.add(layer.original(a, b))
            if streams is not None:
                spans.update(_streamed(layer, a, b, streams.read(data)))
    return base, sorted(spans), sorted(refused)


def _streamed(layer: Layer, a: int, b: int, found: tuple[set[int], str, str]) -> Iterator[tuple[int, int, int]]:
    """Spans of a run that was read as a stream, and those it has together with the text around."""
    kinds, head, tail = found
    first, last = layer.original(a, b)
    yield from ((first, kind, last) for kind in kinds)
    before, after = layer.text[max(0, a - EDGE):a], layer.text[b:b + EDGE]
    for start, kind, end in scan_layer(before + head):
        if start < len(before) < end:
            yield layer.original(a - len(before) + start, b)[0], kind, last
    for start, kind, end in scan_layer(tail + after):
        if start < len(tail) < end:
            yield first, kind, layer.original(a, b + end - len(tail))[1]


def find_secrets(text: str) -> tuple[list, list, int]:
    """Base spans, all spans, both (start, kind, end) in order, and the number of runs too large to be held.

    These runs are not looked into here; :func:`scan` reads them as streams.
    """
    base, spans, refused = examine(text)
    return base, spans, len(refused)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, overlapping ones joined, replaced by a mask."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join(out) + text[at:]


_SPANS = "array<struct<kind:string,start:long,end:long>>"


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        base_column, all_column, refused_column = [], [], []
        for value in batch.column(1):
            base, spans, refused = examine(value.as_py() or "", Streams())
            base_column.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in base])
            all_column.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
            refused_column.append(len(refused))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(base_column, kind), pa.array(all_column, kind),
             pa.array(refused_column, pa.int64())],
            names=["key", "base", "spans", "n_refused"],
        )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base spans and all spans of every document, as arrays of (kind, start, end)."""
    taken = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = taken.schema["key"].dataType.simpleString()
    found = taken.mapInArrow(
        _scan_batches, f"key {kind}, base {_SPANS}, spans {_SPANS}, n_refused long")
    return found.withColumnRenamed("key", key)


def spans_text(name: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with all secrets and runs left packed masked; an integer column of that name gets the new length.

    A column of that name and another type stays as it is. Texts without secrets come back as they were, null ones included.
    """
    at = docs.columns.index(text)
    counted = length in docs.columns and isinstance(docs.schema[length].dataType, IntegralType)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lengths = [], []
            known = batch.column(batch.schema.names.index(length)).to_pylist() if counted else None
            for i, value in enumerate(batch.column(at)):
                value = value.as_py()
                _, spans, refused = examine(value, Streams()) if value else ([], [], [])
                # Runs too large to be held are masked whole.
                spans = sorted(spans + [(a, -1, b) for a, b in refused])
                new = redacted(value, spans) if spans else value
                texts.append(new)
                if known is not None:
                    lengths.append(len(new) if spans else known[i])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            if known is not None:
                place = batch.schema.names.index(length)
                columns[place] = pa.array(lengths, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(masked, docs.schema)


def secret_report(docs: DataFrame) -> DataFrame:
    found = scan(only(docs, "doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS),
        F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"), "n_refused",
    )
