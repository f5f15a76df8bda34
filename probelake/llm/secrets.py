"""Secret scans: a worklist of decoded layers, unwrapped until nothing new comes, each scanned like the text.

A layer is a text whose characters know which span of the document they come from. From a layer come: itself
with URL escapes resolved, itself with Unicode escapes resolved, and the texts of its base64 runs, inflated if
they are compressed, as often as they are. A layer seen before (same text from the same place) is not unpacked again,
so data that unpacks to itself ends. Spans found in a layer are mapped to the document; base spans are never lost to them.

Compressed data is inflated as a stream and scanned whole, however much it holds, in pieces that end where no secret
and nothing encoded can go on. Layers are taken from the worklist as they come, the last first, so that no more than a
piece is held for each level of nesting.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probelake.llm.common import map_texts, record, texts

# The kinds of secrets, in this order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex")
LEAST_ASSIGN = 12
LEAST_ACCESS = 18

#: What every text with an assignment has in its lower-cased bytes; a cheap test before the pattern.
HINT = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']? *[:=]""")
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(
    r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\u\{[0-9a-fA-F]{1,6}\}"
    r"|\\x[0-9a-fA-F]{2}|&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: A run over several lines, the last of them maybe short.
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]{16,})*\r?\n[ \t]*[A-Za-z0-9+/_-]+={0,2}")
BREAK = re.compile(r"\s+")
#: Where compressed data may begin behind what was glued to it.
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
#: Bytes inflated at a time, at the beginning and later on.
FIRST, BLOCK = 1 << 10, 1 << 16
#: Bytes of a piece. It ends before one of these, as no secret, escape or base64 run has them, at an even place for UTF-16.
PIECE = 1 << 22
ENDING = re.compile(rb"[!()*,<>?@\[\]^`|~$]")
#: Where there is no such place in so many bytes, pieces overlap, and the document is marked as ``cut``.
LONGEST, OVERLAP = 1 << 25, 1 << 20
REDACTED = "[secret]"


class Layer(NamedTuple):
    """A text; its characters come from starts[i]:ends[i] of the document, or all from ``whole``."""

    text: str
    starts: list[int] | None = None
    ends: list[int] | None = None
    whole: tuple[int, int] | None = None

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.starts is None:
            return start, end
        return self.starts[start], self.ends[end - 1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets that are written plainly, leftmost and not overlapping per kind."""
    found = []
    if HINT.search(text.encode("utf-8", "surrogatepass").lower()):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _resolved(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match replaced by (character, escape length) pairs that ``decode`` gives."""
    if layer.whole:  # all characters come from one place
        changed = pattern.sub(lambda m: "".join(c for c, _ in decode(m[0]) or [(m[0], 0)]), layer.text)
        return None if changed == layer.text else Layer(changed, whole=layer.whole)
    text, starts, ends, at, changed = [], [], [], 0, False
    for m in pattern.finditer(layer.text):
        decoded = decode(m[0])
        if decoded is None:
            continue
        changed = True
        for i in range(at, m.start()):
            a, b = layer.place(i, i + 1)
            starts.append(a)
            ends.append(b)
        text.append(layer.text[at : m.start()])
        at = m.start()
        for char, length in decoded:
            a, b = layer.place(at, at + length)
            text.append(char)
            starts.append(a)
            ends.append(b)
            at += length
        at = m.end()
    if not changed:
        return None
    for i in range(at, len(layer.text)):
        a, b = layer.place(i, i + 1)
        starts.append(a)
        ends.append(b)
    return Layer("".join(text) + layer.text[at:], starts, ends, layer.whole)


def _url(run: str) -> list[tuple[str, int]] | None:
    """The characters of a run of escapes; bytes that are not UTF-8 stay escaped."""
    decoded = bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape")
    found, at = [], 0
    for c in decoded:
        if "\udc80" <= c <= "\udcff":
            found += [(x, 1) for x in run[at : at + 3]]
            at += 3
        else:
            found.append((c, 3 * len(c.encode())))
            at += found[-1][1]
    return found if any(n > 1 for _, n in found) else None


def _unicode(escape: str) -> list[tuple[str, int]] | None:
    if escape[0] == "&":
        code = int(escape[3:-1], 16) if escape[2] in "xX" else int(escape[2:-1])
    elif len(escape) == 12 and escape[1] == "u" and escape[2] != "{":
        code = 0x10000 + (int(escape[2:6], 16) - 0xD800 << 10) + int(escape[8:], 16) - 0xDC00
    else:
        code = int(escape[2:].strip("{}"), 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return [(chr(code), len(escape))]


def _machine(data: bytes):
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 1 and (data[0] * 256 + data[1]) % 31 == 0:
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _texts(data: bytes) -> list[str]:
    """The texts that bytes may hold: UTF-8 or else Latin-1, and UTF-16 if they look like it; none if they look random."""
    found = []
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        found.append(data.decode("utf-16", "replace"))
    elif data.count(0) * 4 >= len(data):
        found += [data.decode(code, "replace") for code in ("utf-16-le", "utf-16-be")]
    try:
        found.append(data.decode())
    except UnicodeDecodeError:
        # One character for each byte: nothing that is written in ASCII is lost, whatever else there is.
        found.append(data.decode("latin-1"))
    return found


class Blocks:
    """Bytes from ``start`` on, block by block, and how far whole members have been read."""

    def __init__(self, data: memoryview, start: int):
        self.data, self.start, self.given, self.read = data, start, start, start

    def __iter__(self) -> Iterator[bytes]:
        size = FIRST
        while self.given < len(self.data):
            block = bytes(self.data[self.given : self.given + size])
            self.given += len(block)
            yield block
            size = BLOCK


def _members(blocks: Iterable[bytes], done: Callable[[int], None] = lambda left: None) -> Iterator[bytes]:
    """What all members of compressed data hold, as it comes; nothing if it is not compressed.

    ``done`` is told after each member how many of the bytes given were not needed for it.
    """
    source, rest = iter(blocks), b""
    while True:
        while len(rest) < 6 and (block := next(source, b"")):
            rest = (rest + block).lstrip(b"\0")
        if (machine := _machine(rest)) is None:
            return
        full = False
        while not machine.eof:
            if not rest and not full and getattr(machine, "needs_input", True) and not (rest := next(source, b"")):
                return
            try:
                if getattr(machine, "needs_input", True):
                    out, rest = machine.decompress(rest, PIECE), b""
                else:
                    out = machine.decompress(b"", PIECE)
            except (zlib.error, OSError, lzma.LZMAError, EOFError):
                return
            rest = getattr(machine, "unconsumed_tail", b"") or rest
            full = len(out) == PIECE
            if out:
                yield out
        rest = machine.unused_data + rest
        done(len(rest))
        rest = rest.lstrip(b"\0")


def _pieces(stream: Iterable[bytes]) -> Iterator[tuple[bytes, bool]]:
    """A stream in pieces of about ``PIECE`` bytes or less, and whether one had to be cut anywhere."""
    held = b""
    for out in stream:
        held += out
        while len(held) >= PIECE:
            places = [m.start() for m in ENDING.finditer(held, max(0, len(held) - BLOCK)) if m.start() % 2 == 0]
            if not places:
                places = [m.start() for m in ENDING.finditer(held) if m.start() % 2 == 0]
            if places and places[-1]:
                yield held[: places[-1]], False
                held = held[places[-1] :]
            elif len(held) >= LONGEST:
                yield held, True
                held = held[-OVERLAP:]
            else:
                break
            if len(held) < PIECE:
                break
    if held:
        yield held, False


def _unpacked(data: memoryview, start: int) -> Iterator[tuple[str, bool]]:
    """The texts of what is compressed from ``start`` on, unpacked as often as it is, and whether they were cut.

    Returns the place up to which whole members were read.
    """
    seen, read, depth = set(), start, 0
    while True:
        depth += 1
        blocks = Blocks(data, start)

        def done(left: int, blocks: Blocks = blocks) -> None:
            blocks.read = blocks.given - left

        stream: Iterator[bytes] = _members(blocks, done)
        for _ in range(depth - 1):
            stream = _members(stream)
        digest, some = hashlib.md5(), False
        for piece, cut in _pieces(stream):
            some = True
            digest.update(piece)
            for text in _texts(piece):
                yield text, cut
        read = max(read, blocks.read)
        if not some or digest.digest() in seen:
            return read
        seen.add(digest.digest())


def _base64(run: str) -> Iterator[tuple[str, bool]]:
    """The texts that a base64 run holds, from each of its first four characters on, and whether they were cut."""
    bare = BREAK.sub("", run).rstrip("=").replace("-", "+").replace("_", "/")
    for first in range(4):
        part = bare[first : len(bare) - ((len(bare) - first) % 4 == 1)]
        data = base64.b64decode(part + "=" * (-len(part) % 4))
        for text in _texts(data):
            yield text, False
        read = 0
        for start in (0, *(m.start() for m in PACKED.finditer(data) if m.start())):
            if start >= read:  # what a member before holds has been unpacked
                read = max(read, (yield from _unpacked(memoryview(data), start)))


def _inside(layer: Layer) -> Iterator[tuple[Layer | None, bool]]:
    if "%" in layer.text:
        yield _resolved(layer, URL, _url), False
    if "\\" in layer.text or "&#" in layer.text:
        yield _resolved(layer, UNICODE, _unicode), False
    wrapped = WRAPPED.finditer(layer.text) if "\n" in layer.text else ()
    for m in chain(BASE64.finditer(layer.text), wrapped):
        whole = layer.place(m.start(), m.end())
        for text, cut in _base64(m[0]):
            yield Layer(text, whole=whole), cut


def layers(text: str) -> Iterator[tuple[Layer, bool]]:
    """The layers inside a text, each once, and whether it was cut."""
    work, seen = [_inside(Layer(text))], set()
    while work:
        found = next(work[-1], None)
        if found is None:
            work.pop()
            continue
        new, cut = found
        if new is None or not new.text:
            continue
        place = new.place(0, len(new.text))
        key = hashlib.md5(new.text.encode("utf-8", "surrogatepass")).digest(), place
        if key not in seen:
            seen.add(key)
            yield new, cut
            work.append(_inside(new))


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], bool]:
    """Base spans, all spans, and whether a layer was cut; spans are (start, kind, end)."""
    base, cut_any = base_spans(text), False
    found = set(base)
    for layer, cut in layers(text):
        cut_any |= cut
        for start, kind, end in base_spans(layer.text):
            a, b = layer.place(start, end)
            found.add((a, kind, b))
    return base, sorted(found), cut_any


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with what the spans cover replaced."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join(out) + text[at:]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


FOUND = [
    ("doc_id", pa.int64()),
    ("n_assign", pa.int64()),
    ("n_access", pa.int64()),
    ("n_hex", pa.int64()),
    ("base_spans", pa.string()),
    ("spans", pa.string()),
    ("cut", pa.bool_()),
]


def _found(piece: pa.RecordBatch):
    results = [scan(t) for t in texts(piece)]
    counts = [[sum(k == kind for _, k, _ in base) for base, _, _ in results] for kind in range(3)]
    spans = [[_joined(r[i]) for r in results] for i in range(2)]
    ids = piece.column("doc_id").cast(pa.int64())
    yield record(FOUND, [ids, *counts, *spans, [r[2] for r in results]])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_spans, spans, cut.

    Spans are ``kind:start:end`` in code points of the whole text, end exclusive, by start, then kind, joined by
    commas; the counts are of base spans. A null or empty text has none (empty strings); rows with null or equal
    ids are scanned each; an empty table gives an empty result; other columns are not read.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string, cut boolean"
    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), _found, schema)


def redact(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with secrets in ``text`` replaced by ``REDACTED`` and ``n_chars`` set anew.

    Texts without secrets, null texts among them, stay as they are.
    """
    names, schema = docs.columns, docs.schema

    def work(piece: pa.RecordBatch):
        before = piece.column("text").to_pylist()
        after = [t if not t or not (found := scan(t)[1]) else redacted(t, found) for t in before]
        columns = {n: piece.column(n) for n in names}
        columns["text"] = pa.array(after, piece.column("text").type)
        if "n_chars" in columns:
            kind = columns["n_chars"].type
            lengths = zip(columns["n_chars"].to_pylist(), before, after)
            columns["n_chars"] = pa.array([n if a == b else len(b) for n, a, b in lengths], kind)
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return map_texts(docs, work, schema)
