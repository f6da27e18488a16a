"""Text pages of PDF files, with the standard library: objects, Flate streams, the page tree and the operators that show text.

Fonts are read through their ToUnicode maps; without one a byte is a Latin character. Encrypted files and other filters are errors; scanned pages have no text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"^(.*?)\bstream\r?\n(.*?)\r?\n?endstream", re.S)
_TOKEN = re.compile(
    rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/<>\[\]()]+|[+-]?\d*\.?\d+|[A-Za-z'\"*]+", re.S
)
_REFERENCE = re.compile(rb"(\d+)\s+\d+\s+R")
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _objects(data: bytes) -> dict[int, bytes]:
    """The bodies of all objects by number, the last of repeated ones, with those that are packed into object streams."""
    found = {int(m.group(1)): m.group(3) for m in _OBJECT.finditer(data)}
    for body in list(found.values()):
        if re.search(rb"/Type\s*/ObjStm\b", body.partition(b"stream")[0]):
            content = _stream(body)
            count, first = (int(re.search(rb"/%s\s+(\d+)" % k, body).group(1)) for k in (b"N", b"First"))
            numbers = [int(n) for n in content[:first].split()[: 2 * count]]
            ends = [*numbers[3::2], len(content) - first]
            for number, low, high in zip(numbers[::2], numbers[1::2], ends, strict=True):
                found.setdefault(number, content[first + low : first + high])
    return found


def _stream(body: bytes) -> bytes:
    m = _STREAM.search(body)
    if m is None:
        return b""
    head, content = m.groups()
    filters = re.findall(rb"/(\w+Decode)", head)
    for name in filters:
        if name != b"FlateDecode":
            raise ValueError(f"unsupported filter {name.decode()}")
        unpacker = zlib.decompressobj()
        content = unpacker.decompress(content) + unpacker.flush()
    if filters and (p := re.search(rb"/Predictor\s+(\d+)", head)) and int(p.group(1)) > 1:
        raise ValueError("unsupported predictor")
    return content


def _referred(body: bytes, key: bytes) -> list[int]:
    """The objects that a key names, one or a list."""
    m = re.search(rb"/" + key + rb"\b\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body, re.S)
    return [int(n) for n in _REFERENCE.findall(m.group(1))] if m else []


def _pages(objects: dict[int, bytes]) -> list[tuple[bytes, bytes]]:
    """(page, resources) in the order of the page tree; a page without resources has its parent's."""
    catalog = next((b for b in objects.values() if re.search(rb"/Type\s*/Catalog\b", b)), None)
    out, stack = [], [(n, b"") for n in reversed(_referred(catalog, b"Pages"))] if catalog else []
    seen: set[int] = set()
    while stack:
        number, above = stack.pop()
        if number in seen or number not in objects:
            continue
        seen.add(number)
        body = objects[number]
        own = body if b"/Font" in body else b"".join(objects.get(n, b"") for n in _referred(body, b"Resources")) or above
        if kids := _referred(body, b"Kids"):
            stack += [(n, own) for n in reversed(kids)]
        else:
            out.append((body, own))
    return out


def _unicode_map(text: bytes) -> tuple[dict[int, str], int]:
    """What the codes of a font stand for, and the bytes of a code."""
    table, size = {}, 1
    shown = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", text, re.S):
        for code, target in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            size = max(size, len(code) // 2)
            table[int(code, 16)] = shown(target)
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", text, re.S):
        for low, high, target in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            size, begin = max(size, len(low) // 2), shown(target)
            for k in range(min(int(high, 16) - int(low, 16) + 1, 65536)):
                table[int(low, 16) + k] = begin[:-1] + chr(ord(begin[-1]) + k)
    return table, size


def _literal(token: bytes) -> bytes:
    """The bytes of a string in parentheses or of one in hexadecimal digits."""
    if token.startswith(b"<"):
        digits = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())

    def escape(m: re.Match) -> bytes:
        e = m.group(1)
        return bytes([int(e, 8) & 255]) if e.isdigit() else b"" if e in (b"\n", b"\r", b"\r\n") else _ESCAPES.get(e, e)

    return re.sub(rb"\\([0-7]{1,3}|\r\n|.)", escape, token[1:-1], flags=re.S)


def _shown(data: bytes, font: tuple[dict[int, str], int] | None) -> str:
    if font is None or not font[0]:
        return data.decode("cp1252", "replace")
    table, size = font
    codes = (int.from_bytes(data[k : k + size], "big") for k in range(0, len(data), size))
    return "".join(table.get(c, chr(c) if size == 1 else "") for c in codes)


def _text(content: bytes, fonts: dict[bytes, tuple[dict[int, str], int]]) -> Iterator[str]:
    """Pieces of text and line ends of a content stream."""
    operands: list[bytes] = []
    font, in_array, height = None, False, None
    for token in _TOKEN.findall(content):
        if token in (b"[", b"]"):
            in_array = token == b"["
            continue
        if token[:1] in b"(</" or in_array or re.fullmatch(rb"[+-]?\d*\.?\d+", token):
            operands.append(token)
            continue
        if token == b"Tf":
            font = next((fonts.get(o[1:]) for o in operands if o.startswith(b"/")), None)
        elif token in (b"Tj", b"TJ", b"'", b'"'):
            if token in (b"'", b'"'):
                yield "\n"
            for o in operands:
                if o[:1] in b"(<":
                    yield _shown(_literal(o), font)
                elif token == b"TJ" and float(o) < -180:
                    yield " "
        elif token == b"T*" or (token in (b"Td", b"TD") and len(operands) == 2 and float(operands[1])):
            yield "\n"
        elif token == b"Tm" and len(operands) == 6:
            if height is not None and float(operands[5]) != height:
                yield "\n"
            height = float(operands[5])
        elif token == b"ET":
            yield "\n"
        operands = []


def read_pdf(data: bytes) -> list[str]:
    """The text of each page, in order."""
    if not data.lstrip().startswith(b"%PDF"):
        raise ValueError("not a PDF file")
    if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", data):
        raise ValueError("the file is encrypted")
    objects = _objects(data)
    tree = _pages(objects)
    if not tree:
        raise ValueError("the file has no pages")
    pages = []
    for page, resources in tree:
        fonts = {}
        named = re.search(rb"/Font\s*(<<.*?>>|\d+\s+\d+\s+R)", resources, re.S)
        listed = b"" if named is None else objects.get(int(named.group(1).split()[0]), b"") if named.group(1)[:1].isdigit() else named.group(1)
        for name, number in re.findall(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R", listed):
            maps = _referred(objects.get(int(number), b""), b"ToUnicode")
            fonts[name] = _unicode_map(_stream(objects[maps[0]])) if maps and maps[0] in objects else ({}, 1)
        content = b"\n".join(_stream(objects[n]) for n in _referred(page, b"Contents") if n in objects)
        lines = "".join(_text(content, fonts)).splitlines()
        pages.append("\n".join(line.strip() for line in lines if line.strip()))
    return pages
