"""Texts of PDF pages with the standard library alone: the default reader of the harvest.

Understood are classic and compressed object tables, Flate streams with predictors,
page trees, simple and composite fonts with a ToUnicode map, and the text operators.
Text is put out in the order of the content stream; a move to another line is a line
feed and a wide gap a space.  Encrypted documents and scanned pages give no text.
"""

from __future__ import annotations

import re
import zlib

_TOKEN = re.compile(
    rb"%[^\r\n]*|(?P<hex><[0-9A-Fa-f\s]*>)|(?P<open><<|\[)|(?P<close>>>|\])|(?P<str>\()|(?P<name>/[^\x00\s()<>\[\]{}/%]*)"
    rb"|(?P<ref>\d+\s+\d+\s+R(?![A-Za-z]))|(?P<num>[+-]?(?:\d+\.?\d*|\.\d+))|(?P<word>[^\x00\s()<>\[\]{}/%]+)"
)
_ESCAPES = {ord("n"): 10, ord("r"): 13, ord("t"): 9, ord("b"): 8, ord("f"): 12}


class Name(str):
    """A name such as ``/Type``, without its slash."""


class Ref(int):
    """The number of an object elsewhere in the file."""


class Word(bytes):
    """An operator or keyword."""


def _literal(data: bytes, at: int) -> tuple[bytes, int]:
    out, depth = bytearray(), 1
    while at < len(data):
        c = data[at]
        at += 1
        if c == 92 and at < len(data):
            c = data[at]
            at += 1
            digits = re.compile(rb"[0-7]{1,3}").match(data, at - 1)
            if digits:
                out.append(int(digits[0], 8) & 255)
                at = digits.end()
            elif c not in (10, 13):
                out.append(_ESCAPES.get(c, c))
            continue
        depth += (c == 40) - (c == 41)
        if not depth:
            break
        out.append(c)
    return bytes(out), at


def values(data: bytes, at: int = 0):
    """(value, place after it) of one object after the other."""
    stack: list = []
    while True:
        m = _TOKEN.search(data, at)
        if not m:
            return
        at = m.end()
        kind = m.lastgroup
        if kind is None:
            continue
        if kind == "open":
            stack.append((m[0], []))
            continue
        if kind == "close":
            if not stack:
                continue
            opened, items = stack.pop()
            value = items if opened == b"[" else dict(zip(items[::2], items[1::2]))
        elif kind == "hex":
            digits = re.sub(rb"\s", b"", m[0][1:-1])
            value = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        elif kind == "str":
            value, at = _literal(data, at)
        elif kind == "name":
            value = Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda h: bytes([int(h[1], 16)]), m[0][1:]).decode("latin-1"))
        elif kind == "ref":
            value = Ref(m[0].split()[0])
        elif kind == "num":
            value = float(m[0]) if b"." in m[0] else int(m[0])
        else:
            value = Word(m[0])
        if stack:
            stack[-1][1].append(value)
        else:
            yield value, at


def _unpredicted(data: bytes, parms: dict) -> bytes:
    """Rows of PNG predictors undone: none, sub, up, average, Paeth."""
    if not isinstance(parms, dict) or parms.get("Predictor", 1) < 10:
        return data
    wide = max(1, parms.get("Colors", 1) * parms.get("BitsPerComponent", 8) // 8)
    size = -(-parms.get("Columns", 1) * parms.get("Colors", 1) * parms.get("BitsPerComponent", 8) // 8)
    out, above = bytearray(), bytearray(size)
    for first in range(0, len(data), size + 1):
        kind, row = data[first], bytearray(data[first + 1 : first + 1 + size])
        for i in range(len(row)):
            a, b, c = row[i - wide] if i >= wide else 0, above[i], above[i - wide] if i >= wide else 0
            nearest = min((a, b, c), key=lambda x: (abs(a + b - c - x), (a, b, c).index(x)))  # noqa: B023
            row[i] = (row[i] + (0, a, b, (a + b) // 2, nearest)[min(kind, 4)]) & 255
        out += row
        above = row + bytearray(size - len(row))
    return bytes(out)


class Document:
    """The objects of a file, read when asked for."""

    def __init__(self, data: bytes):
        self.data = data
        self.places = {int(m[1]): m.end() for m in re.finditer(rb"(?<![0-9])(\d+)\s+\d+\s+obj\b", data)}  # of several the last one holds
        self.objects: dict[int, tuple] = {}
        for number in list(self.places):
            value, stream = self.load(number)
            if isinstance(value, dict) and value.get("Type") == "ObjStm" and stream is not None:
                head = [v for v, _ in values(stream[: self.get(value["First"])])]
                for inner, offset in zip(head[::2], head[1::2]):
                    found = next(values(stream, value["First"] + offset), None)
                    if found and int(inner) not in self.places:
                        self.objects[int(inner)] = (found[0], None)

    def load(self, number: int) -> tuple:
        """(value, decoded stream or None) of an object."""
        if number in self.objects:
            return self.objects[number]
        self.objects[number] = (None, None)
        if number not in self.places:
            return None, None
        found = next(values(self.data, self.places[number]), None)
        if not found:
            return None, None
        value, at = found
        stream = None
        begin = re.compile(rb"\s*stream\r?\n").match(self.data, at)
        if isinstance(value, dict) and begin:
            size = self.get(value.get("Length"))
            end = begin.end() + size if isinstance(size, int) and re.compile(rb"\s*endstream").match(self.data, begin.end() + size) else self.data.find(b"endstream", begin.end())
            stream = self._decoded(self.data[begin.end() : end], value)
        self.objects[number] = (value, stream)
        return self.objects[number]

    def get(self, value):
        return self.load(value)[0] if isinstance(value, Ref) else value

    def _decoded(self, data: bytes, info: dict) -> bytes | None:
        filters, parms = self.get(info.get("Filter")), self.get(info.get("DecodeParms"))
        for k, name in enumerate(filters if isinstance(filters, list) else [filters] if filters else []):
            if name not in ("FlateDecode", "Fl"):
                return None
            data = zlib.decompressobj().decompress(data)
            own = self.get(parms[k]) if isinstance(parms, list) and k < len(parms) else parms
            data = _unpredicted(data, own)
        return data

    def pages(self) -> list[dict]:
        """Pages in reading order, with what they inherit."""
        root = next((v for n in list(self.places) + list(self.objects) if isinstance(v := self.load(n)[0], dict) and v.get("Type") == "Catalog"), None)
        out, seen = [], set()

        def walk(ref, above: dict) -> None:
            node = self.get(ref)
            if not isinstance(node, dict) or (isinstance(ref, Ref) and int(ref) in seen):
                return
            seen.add(int(ref) if isinstance(ref, Ref) else -len(seen))
            own = above | {k: node[k] for k in ("Resources",) if k in node}
            if "Kids" in node:
                for kid in self.get(node["Kids"]) or []:
                    walk(kid, own)
            else:
                out.append(own | node)

        if root:
            walk(root.get("Pages"), {})
        return out


def _cmap(stream: bytes) -> tuple[dict[bytes, str], set[int]]:
    """Texts by code, and the lengths of codes, of a ToUnicode map."""
    text = lambda raw: raw.decode("utf-16-be", "replace")
    found, lengths, stack = {}, set(), []
    for value, _ in values(stream):
        if not isinstance(value, Word):
            stack.append(value)
            continue
        if value == b"endcodespacerange":
            lengths |= {len(x) for x in stack if isinstance(x, bytes)}
        elif value == b"endbfchar":
            found |= {a: text(b) for a, b in zip(stack[::2], stack[1::2]) if isinstance(b, bytes)}
        elif value == b"endbfrange":
            for a, b, to in zip(stack[::3], stack[1::3], stack[2::3]):
                first, last = int.from_bytes(a, "big"), int.from_bytes(b, "big")
                for k in range(min(last - first + 1, 1 << 16)):
                    put = to[k] if isinstance(to, list) and k < len(to) else (int.from_bytes(to, "big") + k).to_bytes(max(2, len(to)), "big") if isinstance(to, bytes) else b""
                    found[(first + k).to_bytes(len(a), "big")] = text(put)
        stack = []
    return found, lengths or {len(a) for a in found}


def _reader(document: Document, font) -> object:
    """How a font's strings read."""
    info = document.get(font)
    info = info if isinstance(info, dict) else {}
    stream = document.load(info["ToUnicode"])[1] if isinstance(info.get("ToUnicode"), Ref) else None
    if stream:
        found, lengths = _cmap(stream)

        def mapped(raw: bytes) -> str:
            out, at = [], 0
            while at < len(raw):
                size = next((n for n in sorted(lengths) if raw[at : at + n] in found), max(lengths, default=1))
                out.append(found.get(raw[at : at + size], ""))
                at += size
            return "".join(out)

        return mapped
    if info.get("Subtype") == "Type0":
        return lambda raw: ""
    coding = "mac-roman" if "MacRoman" in str(document.get(info.get("Encoding"))) else "cp1252"
    return lambda raw: raw.decode(coding, "replace")


def _page_text(document: Document, page: dict) -> str:
    contents = page.get("Contents")
    contents = document.get(contents) if isinstance(document.get(contents), list) else [contents]
    stream = b"\n".join(document.load(c)[1] or b"" for c in contents if isinstance(c, Ref))
    resources = document.get(page.get("Resources")) or {}
    fonts = document.get(resources.get("Font")) or {}
    readers = {name: _reader(document, ref) for name, ref in fonts.items()}
    out, held, read, line = [], [], (lambda raw: raw.decode("cp1252", "replace")), None

    def feed(y=None) -> None:
        nonlocal line
        if out and not out[-1].endswith("\n") and (y is None or y != line):
            out.append("\n")
        line = y

    for value, _ in values(stream):
        if not isinstance(value, Word):
            held.append(value)
            continue
        if value == b"Tf" and len(held) >= 2:
            read = readers.get(held[-2], read)
        elif value in (b"Td", b"TD") and len(held) >= 2 and held[-1]:
            feed()
        elif value == b"Tm" and len(held) >= 6:
            feed(held[-1])
        elif value in (b"T*", b"ET"):
            feed()
        elif value in (b"Tj", b"'", b'"') and held and isinstance(held[-1], bytes):
            if value != b"Tj":
                feed()
            out.append(read(held[-1]))
        elif value == b"TJ" and held and isinstance(held[-1], list):
            out += [read(x) if isinstance(x, bytes) else " " if isinstance(x, (int, float)) and x < -200 else "" for x in held[-1]]
        held = []
    return re.sub(r"[ \t]*\n", "\n", "".join(out)).strip("\n")


def read_pages(data: bytes) -> list[str]:
    """The text of each page; an encrypted document is an error."""
    if b"/Encrypt" in data:
        raise ValueError("encrypted")
    document = Document(bytes(data))
    return [_page_text(document, page) for page in document.pages()]
