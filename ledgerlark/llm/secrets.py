"""Secret scan with a worklist of decoded layers.

Every text is scanned as it stands. Then its percent escapes and its ``\\uXXXX`` / ``\\xXX`` escapes are decoded
in place, and each run of base64, also over line ends, into the bytes or the gzip, zlib, bzip2 or xz streams that it holds
(bytes that are no UTF-8 are replaced). Each gives a new layer, which is scanned and searched for encoded runs again until no new layer appears. A layer
whose content and place were met before is not entered twice, so self-reproducing archives end.
What is found in a layer is mapped back to code points of the text: exactly through escapes, to
groups of four through base64, to the whole run through a compressed stream.

NULL and empty texts give no spans. Rows are handled one by one, so repeated rows give repeated
results, an empty table gives an empty one and other columns of the table play no part.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque

from pyspark.sql import DataFrame

from ledgerlark.llm.common import id_and_text, per_text, read, sha256, span_text
from ledgerlark.llm.registry import query

KINDS = {"assign": 0, "access": 1, "hex": 2}
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_KEYWORD = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

#: Full lines of base64 and padding (1), the first line (2), a shorter last line (3).
_WRAPPED = re.compile(
    r"(([A-Za-z0-9+/_-]{16,})(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]{16,})*={0,2})"
    r"((?:(?<!=)[\x20\t]*\r?\n[\x20\t]*(?:[A-Za-z0-9+/_-]+={0,2}|={1,2}))?)"
)

#: A decoded stream longer than this is taken for a bomb and not entered (a parameter of ``scan``).
MAX_LAYER = 1 << 26


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the plain rules, leftmost and not overlapping within a kind."""
    spans = []
    if _KEYWORD.search(text):
        spans += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return spans + [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]


def _decoded(raw: bytes) -> tuple[str, list[int]]:
    """The text and how many bytes each code point takes; a byte that is not UTF-8 gives one replacement character."""
    text = raw.decode("utf-8", "surrogateescape")
    width = [1 if c < "\x80" or "\udc80" <= c <= "\udcff" else len(c.encode()) for c in text]
    return re.sub("[\udc80-\udcff]", "\ufffd", text), width


def _tool(raw: bytes):
    if raw[:2] == b"\x1f\x8b":
        return zlib.decompressobj(47)
    if raw[:1] == b"\x78" and len(raw) > 5 and int.from_bytes(raw[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _expanded(raw: bytes, limit: int) -> bytes | None:
    """The content of compressed streams one after another, as far as they can be read and with what follows them as it
    stands; None if ``raw`` is none. What expands beyond ``limit`` gives nothing."""
    out = b""
    while (tool := _tool(raw)) is not None:
        try:
            out += tool.decompress(raw, limit + 1 - len(out))
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return out + raw if out else None
        if len(out) > limit:
            return b""
        if not tool.eof:  # cut off
            return out
        raw = tool.unused_data
        if not raw:
            return out
    return out + raw if out else None


def _from_escapes(layer: str, start: int, end: int, unit: str):
    """Decoded text of layer[start:end] and, per code point, the (start, end) it came from."""
    chars: list[str] = []
    places: list[tuple[int, int]] = []
    pos = start
    if unit == "url":
        for m in _URL.finditer(layer, start, end):
            a, b = m.span()
            chars += layer[pos:a]
            places += [(i, i + 1) for i in range(pos, a)]
            raw = bytes.fromhex(m[0].replace("%", ""))
            at = a
            for c in raw.decode("utf-8", "replace"):
                width = 3 * (len(c.encode()) if c != "�" else 1)
                chars.append(c)
                places.append((at, min(b, at + width)))
                at = min(b - 1, at + width)
            pos = b
    else:
        for m in _UNICODE.finditer(layer, start, end):
            chars += layer[pos : m.start()]
            places += [(i, i + 1) for i in range(pos, m.start())]
            code = int(m[0][2:], 16)
            if chars and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(chars[-1]) < 0xDC00:
                chars[-1] = chr(0x10000 + ((ord(chars[-1]) - 0xD800) << 10) + code - 0xDC00)
                places[-1] = (places[-1][0], m.end())
            else:
                chars.append(chr(code))
                places.append((m.start(), m.end()))
            pos = m.end()
    chars += layer[pos:end]
    places += [(i, i + 1) for i in range(pos, end)]
    return "".join("�" if 0xD800 <= ord(c) < 0xE000 else c for c in chars), places


def _base64_runs(layer: str):
    """(start, end) of the runs of each line, and of those that go on over line ends, with and without a short last line."""
    yield from (m.span() for m in _BASE64.finditer(layer))
    if "\n" in layer:
        for m in _WRAPPED.finditer(layer):
            if "\n" in m[1]:
                yield m.start(), m.end(1)
            if m[3]:
                yield m.span()


def _inner_layers(layer: str, limit: int):
    """(name, text, places) of every encoded run; places[i] is where code point i came from."""
    for name, sign, pattern in (("url", "%", _URL), ("unicode", "\\", _UNICODE)):
        if sign in layer:
            if pattern.search(layer):
                yield name, *_from_escapes(layer, 0, len(layer), name)
    for start, end in _base64_runs(layer):
        run = layer[start:end]
        at = [i for i, c in enumerate(run, start) if not c.isspace()]
        body = "".join(run.split()).rstrip("=").replace("-", "+").replace("_", "/")
        if len(body) % 4 == 1:
            body = body[:-1]
        try:
            raw = base64.b64decode(body + "=" * (-len(body) % 4))
        except (binascii.Error, ValueError):
            continue
        out = _expanded(raw, limit)
        if out is not None:
            text, _ = _decoded(out)
            if text:
                yield "compressed", text, [(start, end)] * len(text)
            continue
        text, width = _decoded(raw)
        places, byte = [], 0
        for w in width:
            places.append((at[byte // 3 * 4], at[min(len(at), (byte + w - 1) // 3 * 4 + 4) - 1] + 1))
            byte += w
        yield "base64", text, places


def decoded_spans(text: str, limit: int = MAX_LAYER) -> tuple[set[tuple[int, str, int]], int]:
    """Spans found in decoded layers, mapped to ``text``, and the number of layers entered."""
    found: set[tuple[int, str, int]] = set()
    seen: set[bytes] = set()
    entered = 0
    work: deque = deque([(text, None)])
    while work:
        layer, origin = work.popleft()
        for _, inner, places in _inner_layers(layer, limit):
            if origin is not None:
                places = [(origin[a][0], origin[b - 1][1]) for a, b in places]
            mark = hashlib.blake2b(
                f"{places[0][0]}:{places[-1][1]}:{inner}".encode("utf-8", "surrogatepass"), digest_size=16
            ).digest()
            if mark in seen:
                continue
            seen.add(mark)
            entered += 1
            found.update((places[a][0], kind, places[b - 1][1]) for a, kind, b in base_spans(inner))
            work.append((inner, places))
    return found, entered


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_layer: int = MAX_LAYER) -> DataFrame:
    """Per row: counts and digest of the plain spans, all spans as text, and the number of layers decoded."""

    def make():
        def one(text: str):
            base = base_spans(text)
            count = [sum(k == kind for _, k, _ in base) for kind in KINDS]
            more, layers = decoded_spans(text, max_layer)
            return *count, sha256(span_text(base, KINDS)), span_text({*base, *more}, KINDS), layers

        return one

    return per_text(
        id_and_text(docs, id_col, text_col), make,
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long",
    )


@query()
def op8_secrets(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))
