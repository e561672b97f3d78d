"""PDF files read without a library: objects, text of pages in reading order of their streams, properties, XMP, images, forms.

Objects are found by their headers (so a damaged cross-reference table does no harm), object streams are unpacked, pages are
taken in the order of the page tree. Text comes from the show operators of the content streams through the fonts' ToUnicode
maps. Encrypted files and filters other than Flate give an issue, not an error.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

_OBJ = re.compile(rb"(?<!\d)(\d+)\s+(\d+)\s+obj\b")
_SPACE = b"\0\t\n\f\r "
_STOP = _SPACE + b"()<>[]{}/%"
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Name(str):
    """A name object, without its slash."""


class Ref(int):
    """A reference to an object by its number."""


class Word(str):
    """An operator or keyword."""


class Lexer:
    """Values of a byte string, one after the other."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def skip(self) -> bytes:
        d, n = self.data, len(self.data)
        while self.at < n:
            c = d[self.at : self.at + 1]
            if c in (b"%",):
                while self.at < n and d[self.at] not in b"\r\n":
                    self.at += 1
            elif c[0] in _SPACE:
                self.at += 1
            else:
                return c
        return b""

    def value(self):
        c = self.skip()
        d = self.data
        if not c:
            return None
        if d[self.at : self.at + 2] == b"<<":
            self.at += 2
            out: dict = {}
            while (c := self.skip()) and d[self.at : self.at + 2] != b">>":
                key = self.value()
                out[str(key)] = self.ref()
            self.at += 2
            return out
        if c == b"[":
            self.at += 1
            items = []
            while (c := self.skip()) and c != b"]":
                items.append(self.ref())
            self.at += 1
            return items
        if c == b"(":
            return self.literal()
        if c == b"<":
            end = d.find(b">", self.at)
            end = len(d) if end < 0 else end
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", d[self.at + 1 : end])
            self.at = end + 1
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        start = self.at
        self.at += 1
        while self.at < len(d) and d[self.at] not in _STOP:
            self.at += 1
        raw = d[start : self.at]
        if c == b"/":
            return Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda m: bytes.fromhex(m[1].decode()), raw[1:]).decode("latin-1"))
        if re.fullmatch(rb"[+-]?\d+", raw):
            return int(raw)
        if re.fullmatch(rb"[+-]?(?:\d+\.\d*|\.\d+)", raw):
            return float(raw)
        return Word(raw.decode("latin-1"))

    def ref(self):
        """A value; 'n g R' is a reference."""
        v = self.value()
        if type(v) is int:
            m = re.compile(rb"\s+\d+\s+R(?![A-Za-z])").match(self.data, self.at)
            if m:
                self.at = m.end()
                return Ref(v)
        return v

    def literal(self) -> bytes:
        d, out, depth = self.data, bytearray(), 0
        while self.at < len(d):
            c = d[self.at : self.at + 1]
            self.at += 1
            if c == b"\\":
                m = re.compile(rb"[0-7]{1,3}").match(d, self.at)
                if m:
                    out.append(int(m[0], 8) & 255)
                    self.at = m.end()
                else:
                    e = d[self.at : self.at + 1]
                    self.at += 1
                    out += b"" if e in (b"\n", b"\r") else _ESCAPES.get(e, e)
                continue
            if c == b"(":
                depth += 1
                if depth == 1:
                    continue
            elif c == b")":
                depth -= 1
                if not depth:
                    break
            out += c
        return bytes(out)


@dataclass
class Page:
    page: int
    text: str
    has_text_layer: bool
    image_count: int


@dataclass
class Scan:
    status: str = "ok"
    metadata: dict[str, str] = field(default_factory=dict)
    xmp: str = ""
    pages: list[Page] = field(default_factory=list)
    embedded: list[str] = field(default_factory=list)
    forms: dict[str, str] = field(default_factory=dict)
    issues: list[str] = field(default_factory=list)


def plain(raw) -> str:
    """A text string: UTF-16 with its mark, UTF-8 with its mark, else by single bytes."""
    if not isinstance(raw, bytes):
        return "" if raw is None else str(raw)
    if raw[:2] == b"\xfe\xff":
        return raw[2:].decode("utf-16-be", "replace")
    return raw[3:].decode("utf-8", "replace") if raw[:3] == b"\xef\xbb\xbf" else raw.decode("latin-1")


class File:
    def __init__(self, data: bytes):
        self.issues: list[str] = []
        self.values: dict[int, object] = {}
        self.streams: dict[int, bytes] = {}
        heads = list(_OBJ.finditer(data))
        for k, m in enumerate(heads):
            lex = Lexer(data[m.end() : heads[k + 1].start() if k + 1 < len(heads) else len(data)])
            v = lex.ref()
            self.values[int(m[1])] = v  # of several versions the last one counts
            if isinstance(v, dict) and lex.skip() and (s := re.compile(rb"stream(?:\r\n|\n|\r)").match(lex.data, lex.at)):
                size = v.get("Length")
                end = s.end() + size if type(size) is int and lex.data[s.end() + size :].lstrip()[:9] == b"endstream" else lex.data.rfind(b"endstream")
                self.streams[int(m[1])] = lex.data[s.end() : end if end >= 0 else len(lex.data)]
        trailers = [Lexer(data, m.end()).value() for m in re.finditer(rb"trailer", data)] + [v for n, v in self.values.items() if isinstance(v, dict) and v.get("Type") == "XRef"]
        self.trailer = {k: v for t in trailers if isinstance(t, dict) for k, v in t.items()}
        for n, v in list(self.values.items()):
            if isinstance(v, dict) and v.get("Type") == "ObjStm" and (body := self.stream(n)) is not None:
                lex = Lexer(body)
                places = [(lex.value(), lex.value()) for _ in range(int(v.get("N", 0)))]
                for number, at in places:
                    self.values.setdefault(number, Lexer(body, int(v.get("First", 0)) + at).ref())

    def get(self, v):
        seen = 0
        while isinstance(v, Ref) and seen < 50:
            v, seen = self.values.get(int(v)), seen + 1
        return v

    def at(self, v, key: str):
        v = self.get(v)
        return self.get(v.get(key)) if isinstance(v, dict) else None

    def stream(self, number: int) -> bytes | None:
        raw = self.streams.get(number)
        if raw is None:
            return None
        filters = self.at(Ref(number), "Filter")
        for f in filters if isinstance(filters, list) else [filters] if filters else []:
            if self.get(f) != "FlateDecode":
                self.issues.append(f"filter {self.get(f)}")
                return None
            try:
                raw = zlib.decompressobj().decompress(raw)
            except zlib.error:
                self.issues.append("damaged stream")
                return None
        parms = self.at(Ref(number), "DecodeParms")
        predictor = self.at(parms, "Predictor") if parms else None
        return _unpredicted(raw, int(self.at(parms, "Columns") or 1)) if isinstance(predictor, int) and predictor >= 10 else raw


def _unpredicted(raw: bytes, columns: int) -> bytes:
    """Undoes the PNG predictors (none, sub, up) of rows of single bytes."""
    out, before = bytearray(), bytes(columns)
    for k in range(0, len(raw), columns + 1):
        kind, row = raw[k], bytearray(raw[k + 1 : k + 1 + columns])
        for i in range(len(row)):
            row[i] = (row[i] + (before[i] if kind == 2 else row[i - 1] if kind == 1 and i else 0)) & 255
        out += row
        before = bytes(row) + bytes(columns - len(row))
    return bytes(out)


def unicode_map(cmap: bytes) -> tuple[int, dict[int, str]]:
    """(bytes of a code, code -> text) of a ToUnicode map."""
    out: dict[int, str] = {}
    width, lex, stack = 1, Lexer(cmap), []
    text = lambda b: b.decode("utf-16-be", "replace")
    while (v := lex.value()) is not None:
        if not isinstance(v, Word):
            stack.append(v)
            continue
        if v in ("endcodespacerange", "endbfchar", "endbfrange") and stack and isinstance(stack[0], bytes):
            width = max(width, len(stack[0]))
        if v == "endbfchar":
            out.update((int.from_bytes(a, "big"), text(b)) for a, b in zip(stack[::2], stack[1::2]) if isinstance(b, bytes))
        elif v == "endbfrange":
            for a, b, to in zip(stack[::3], stack[1::3], stack[2::3]):
                lo, hi = int.from_bytes(a, "big"), int.from_bytes(b, "big")
                for k in range(min(hi - lo + 1, 65536)):
                    if isinstance(to, list):
                        if k < len(to):
                            out[lo + k] = text(to[k])
                    elif len(to) >= 2:
                        out[lo + k] = text(to[:-2] + ((int.from_bytes(to[-2:], "big") + k) & 0xFFFF).to_bytes(2, "big"))
        stack = []
    return width, out


def shown(content: bytes, fonts: dict[str, tuple[int, dict[int, str]]]) -> str:
    """The text of a content stream: strings of the show operators, lines by the operators that move to a new line."""
    out: list[str] = []
    lex, stack, font = Lexer(content), [], None

    def add(raw) -> None:
        if isinstance(raw, bytes):
            width, table = font if font else (1, {})
            codes = [int.from_bytes(raw[k : k + width], "big") for k in range(0, len(raw), width)]
            out.append("".join(table.get(c, "" if table else chr(c)) for c in codes) if font or raw[:2] != b"\xfe\xff" else plain(raw))

    while (v := lex.value()) is not None:
        if not isinstance(v, Word):
            stack.append(v)
            continue
        if v == "Tf" and len(stack) >= 2:
            font = fonts.get(str(stack[-2]))
        elif v in ("Tj", "'", '"') and stack:
            out += ["\n"] * (v != "Tj")
            add(stack[-1])
        elif v == "TJ" and stack and isinstance(stack[-1], list):
            for x in stack[-1]:
                if isinstance(x, (int, float)) and x < -200:
                    out.append(" ")
                add(x)
        elif v in ("T*", "ET") or (v in ("Td", "TD") and len(stack) >= 2 and stack[-1] != 0):
            out.append("\n")
        elif v == "ID":  # an image inside the stream
            end = lex.data.find(b"EI", lex.at)
            lex.at = len(lex.data) if end < 0 else end + 2
        stack = []
    return re.sub(r"\n{2,}", "\n", "".join(out)).strip("\n")


def scan(data: bytes | None) -> Scan:
    """Everything that the engine reads of a PDF. Empty, protected and unreadable files have that status and no pages."""
    if not data:
        return Scan("empty")
    if b"%PDF" not in data[:1024]:
        return Scan("corrupt")
    f = File(data)
    if "Encrypt" in f.trailer:
        return Scan("password_protected")
    out = Scan()
    info = f.get(f.trailer.get("Info"))
    out.metadata = {k: plain(f.get(v)) for k, v in info.items() if f.get(v) is not None} if isinstance(info, dict) else {}
    root = f.get(f.trailer.get("Root"))
    if not isinstance(root, dict):
        root = next((v for v in f.values.values() if isinstance(v, dict) and v.get("Type") == "Catalog"), {})
    meta = root.get("Metadata")
    out.xmp = (f.stream(int(meta)) or b"").decode("utf-8", "replace") if isinstance(meta, Ref) else ""
    for k, v in re.findall(r"<((?:xmp|xmpMM|pdf|dc|photoshop):\w+)>\s*([^<]+?)\s*</", out.xmp) + re.findall(r"\s((?:xmp|xmpMM|pdf|photoshop):\w+)=\"([^\"]*)\"", out.xmp):
        out.metadata.setdefault(k, v)
    pages: list[tuple[dict, object]] = []

    def walk(node, resources, depth: int) -> None:
        node = f.get(node)
        if not isinstance(node, dict) or depth > 60:
            return
        resources = node.get("Resources", resources)
        if "Kids" in node:
            for kid in f.get(node["Kids"]) or []:
                walk(kid, resources, depth + 1)
        else:
            pages.append((node, resources))

    walk(root.get("Pages"), None, 0)
    if not pages:
        pages = [(v, v.get("Resources")) for _, v in sorted(f.values.items()) if isinstance(v, dict) and v.get("Type") == "Page"]
    maps: dict[int, tuple[int, dict[int, str]]] = {}
    for n, (node, resources) in enumerate(pages, 1):
        fonts = {}
        for name, font in (f.at(resources, "Font") or {}).items():
            to = (f.get(font) or {}).get("ToUnicode") if isinstance(f.get(font), dict) else None
            if isinstance(to, Ref):
                if int(to) not in maps:
                    maps[int(to)] = unicode_map(f.stream(int(to)) or b"")
                fonts[name] = maps[int(to)]
        parts = node.get("Contents")
        parts = [parts] if isinstance(parts, Ref) and not isinstance(f.get(parts), list) else f.get(parts) or []
        text = shown(b"\n".join(f.stream(int(p)) or b"" for p in parts if isinstance(p, Ref)), fonts)
        images = sum(f.at(x, "Subtype") == "Image" for x in (f.at(resources, "XObject") or {}).values())
        out.pages.append(Page(n, text, bool(text.strip()), images))
    names = f.at(f.at(root.get("Names"), "EmbeddedFiles"), "Names") or []
    out.embedded = [plain(f.get(x)) for x in names[::2]]
    for x in f.at(root.get("AcroForm"), "Fields") or []:
        if f.at(x, "T") is not None:
            out.forms[plain(f.at(x, "T"))] = plain(f.at(x, "V"))
    out.issues = sorted(set(f.issues))
    if not out.pages:
        out.status = "corrupt"
    elif out.issues:
        out.status = "partial"
    return out


SCHEMA = "relative_path string, status string, metadata map<string,string>, xmp string, pages array<struct<page: int, text: string, has_text_layer: boolean, image_count: int>>, embedded array<string>, forms map<string,string>, issues array<string>"


def scanned(files: DataFrame) -> DataFrame:
    """One row for each PDF of (relative_path, content); a file that breaks the reader is a row with its status."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, data in zip(pdf["relative_path"], pdf["content"]):
                try:
                    s = scan(None if data is None else bytes(data))
                except Exception as e:  # one bad file is a row, not a failed job
                    s = Scan(f"corrupt: {type(e).__name__}")
                rows.append((path, s.status, s.metadata, s.xmp, [vars(p) for p in s.pages], s.embedded, s.forms, s.issues))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in "relative_path status metadata xmp pages embedded forms issues".split()])

    return files.select("relative_path", "content").mapInPandas(run, SCHEMA)


def first_page_text(scans: DataFrame) -> DataFrame:
    """(relative_path, text): the text of the first page; files that cannot be read have the empty text."""
    return scans.selectExpr("relative_path", "coalesce(try_element_at(pages, 1).text, '') AS text")
