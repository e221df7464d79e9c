"""Text PDFs read with the standard library: pages, word boxes and plain text.

``read_words`` maps a reader over a (path, content) DataFrame such as Spark's binaryFile source gives; another reader of
the same shape can be injected. The reader here follows the text operators of unencrypted files, maps codes by the fonts'
ToUnicode tables (else Windows-1252) and takes widths from the fonts (else half the size per character).

Defined results: a page without text has no word; broken, encrypted and scanned files give no words and an error; words
are what stands between blanks of one shown string; coordinates are points from the top left, rounded to thousandths.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_REFERENCE = re.compile(rb"(\d+)\s+\d+\s+R")
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]*|[^\s/\[\]()<>]+", re.S)
_BLANKS = " \t\n\r"
_NUMBERS = re.compile(rb"-?\d*\.?\d+")
#: A string of codes shown by itself at a place; many files hold nothing else.
_SHOWN = rb"BT /([^\s/\[\]()<>]+) (-?\d*\.?\d++) Tf (-?\d*\.?\d++) Tz 1 0 0 1 (-?\d*\.?\d++) (-?\d*\.?\d++) Tm <([0-9A-Fa-f]*+)> Tj ET\n?"
_ONE_SHOWN, _ALL_SHOWN = re.compile(_SHOWN), re.compile(rb"(?:%s)*+" % _SHOWN)
#: Strings that are kept with their texts; beyond it they are made anew, which costs time only.
MEMO = 200_000
#: Words that are given to Spark at a time.
ROWS = 20_000


@dataclass(slots=True)
class Word:
    text: str
    x0: float
    x1: float
    top: float
    bottom: float


@dataclass
class Page:
    width: float
    height: float
    words: list[Word] = field(default_factory=list)


class _Table:
    """What the codes of a ToUnicode table stand for; its ranges are only looked into for the codes that occur."""

    def __init__(self, cmap: bytes = b""):
        text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
        self.chars: dict[int, str | None] = {}
        for block in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
            self.chars |= {int(a, 16): text(b) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block)}
        ranges = [r for block in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S) for r in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block)]
        self.ranges = [tuple(int(x, 16) for x in r) for r in reversed(ranges)]  # the last one counts
        self.known: dict[int, str | None] = {}
        self.strings: dict[tuple[bytes, int], tuple[str, int]] = {}

    def get(self, code: int) -> str | None:
        if code not in self.known:
            at = next((r for r in self.ranges if r[0] <= code <= r[1]), None)
            self.known[code] = self.chars.get(code) if at is None else chr(at[2] + code - at[0])
        return self.known[code]


_table = lru_cache(maxsize=64)(_Table)  # files of one origin have the same table


@dataclass
class _Font:
    table: _Table
    bytes_per_code: int
    widths: dict[int, float]
    usual: float

    def decode(self, raw: bytes) -> list[tuple[str, float]]:
        """(character, width in thousandths of the size) of each code."""
        step = self.bytes_per_code
        codes = [int.from_bytes(raw[k : k + step], "big") for k in range(0, len(raw) - step + 1, step)]
        plain = lambda c: bytes((c,)).decode("cp1252", "replace") if c < 256 else "\ufffd"
        return [(self.table.get(c) or plain(c), self.widths.get(c, self.usual)) for c in codes]


class Document:
    """The objects of a file."""

    def __init__(self, content: bytes):
        if not content.startswith(b"%PDF"):
            raise ValueError("no PDF")
        if b"/Encrypt" in content:
            raise ValueError("encrypted")
        self.objects = {int(n): body for n, body in _OBJECT.findall(content)}
        for body in list(self.objects.values()):
            if b"/ObjStm" in body.partition(b"stream")[0]:
                self._unpack(body)
        self.fonts: dict[bytes, _Font] = {}

    def _unpack(self, body: bytes) -> None:
        data, head = self.stream(body), body.partition(b"stream")[0]
        n, first = (int(re.search(rb"/%s\s+(\d+)" % key, head)[1]) for key in (b"N", b"First"))
        numbers = [int(x) for x in data[:first].split()[: 2 * n]]
        for k in range(n):
            end = first + numbers[2 * k + 3] if k + 1 < n else len(data)
            self.objects.setdefault(numbers[2 * k], data[first + numbers[2 * k + 1] : end])

    def stream(self, body: bytes) -> bytes:
        head, _, rest = body.partition(b"stream")
        data = rest.lstrip(b"\r").removeprefix(b"\n").rpartition(b"endstream")[0]
        return zlib.decompressobj().decompress(data) if b"/FlateDecode" in head else data

    def value(self, body: bytes, key: bytes) -> bytes | None:
        """What stands after a key: a referred object, a nested dictionary or list, or a plain value."""
        m = re.search(rb"/%s(?![A-Za-z0-9])\s*" % key, body)
        if not m:
            return None
        rest = body[m.end() :]
        if r := _REFERENCE.match(rest):
            return self.objects.get(int(r[1]))
        for opening, closing in ((b"<<", b">>"), (b"[", b"]")):
            if rest.startswith(opening):
                depth = 0
                for t in re.finditer(re.escape(opening) + b"|" + re.escape(closing), rest):
                    depth += 1 if t[0] == opening else -1
                    if not depth:
                        return rest[: t.end()]
        return re.match(rb"[^/\s>\]]*", rest)[0]

    def pages(self) -> Iterator[tuple[bytes, bytes]]:
        """(page, inherited MediaBox) in reading order."""
        root = next((b for b in self.objects.values() if re.search(rb"/Type\s*/Catalog\b", b)), None)
        todo = [(self.value(root, b"Pages"), b"")] if root is not None else []
        while todo:
            node, box = todo.pop(0)
            if node is None:
                continue
            box = self.value(node, b"MediaBox") or box
            if (kids := self.value(node, b"Kids")) is not None:
                todo[:0] = [(self.objects.get(int(n)), box) for n in _REFERENCE.findall(kids)]
            else:
                yield node, box

    def font(self, body: bytes) -> _Font:
        if body in self.fonts:
            return self.fonts[body]
        to_unicode = self.value(body, b"ToUnicode")
        table = _table(b"" if to_unicode is None else self.stream(to_unicode))
        wide = b"/Type0" in body
        inner = self.value(body, b"DescendantFonts") if wide else None
        if inner is not None and (r := _REFERENCE.search(inner)):
            inner = self.objects.get(int(r[1]))
        usual = float(self.value(inner, b"DW") or 500) if inner is not None else 500.0
        widths: dict[int, float] = {}
        if not wide and (listed := self.value(body, b"Widths")) is not None:
            first = int(self.value(body, b"FirstChar") or 0)
            widths = {first + k: float(w) for k, w in enumerate(_NUMBERS.findall(listed))}
        self.fonts[body] = _Font(table, 2 if wide else 1, widths, usual)
        return self.fonts[body]

    def read(self) -> list[Page]:
        out = []
        for node, box in self.pages():
            left, low, right, high = (float(x) for x in _NUMBERS.findall(box)[:4]) if box else (0.0, 0.0, 612.0, 792.0)
            page = Page(right - left, high - low)
            resources = self.value(node, b"Resources") or b""
            fonts = self.value(resources, b"Font") or b""
            known = {name: self.font(self.objects[int(n)]) for name, n in re.findall(rb"/([^\s/]+)\s+(\d+)\s+\d+\s+R", fonts) if int(n) in self.objects}
            contents = self.value(node, b"Contents") or b""
            bodies = [contents] if b"stream" in contents else [self.objects.get(int(n), b"") for n in _REFERENCE.findall(contents)]
            _show(b"\n".join(self.stream(b) for b in bodies), known, page, left, high)
            out.append(page)
        return out


def _string(token: bytes) -> bytes:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    plain = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
    return re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda m: bytes((int(m[1], 8) & 255,)) if m[1][:1].isdigit() else b"" if m[1][-1:] == b"\n" else plain.get(m[1], m[1]), token[1:-1], flags=re.S)


def _whole(word: str) -> str:
    """A word with the halves of its characters put together."""
    return word.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace") if any("\ud800" <= c <= "\udfff" for c in word) else word


def _show_strings(stream: bytes, fonts: dict[bytes, _Font], left: float, high: float) -> list[Word] | None:
    """The words of a stream that shows nothing but strings without blanks in fonts of one width, each at its own place; of another None."""
    if not _ALL_SHOWN.fullmatch(stream):
        return None
    out = []
    for name, size, scale, x, y, codes in _ONE_SHOWN.findall(stream):
        font = fonts.get(name)
        if font is None or font.widths:
            return None
        strings, key = font.table.strings, (codes, font.bytes_per_code)
        if key not in strings:
            if len(strings) >= MEMO:
                strings.clear()
            text = "".join(c for c, _ in font.decode(_string(b"<%s>" % codes)))
            strings[key] = _whole(text), len(text)
            if not set(_BLANKS).isdisjoint(text) or len(text) * font.bytes_per_code * 2 != len(codes):
                strings[key] = "", 0
        text, n = strings[key]
        if not n:
            return None
        out.append(Word(text, *_box(size, scale, x, y, n * font.usual, left, high)))
    return out


@lru_cache(maxsize=100_000)
def _box(size: bytes, scale: bytes, x: bytes, y: bytes, width: float, left: float, high: float) -> tuple[float, float, float, float]:
    """(x0, x1, top, bottom) of a string at (x, y) that is ``width`` thousandths of its size wide."""
    height, at, base = float(size), float(x) - left, high - float(y)
    return round(at, 3), round(at + width / 1000 * height * float(scale) / 100, 3), round(base - height, 3), round(base, 3)


def _show(stream: bytes, fonts: dict[bytes, _Font], page: Page, left: float, high: float) -> None:
    """Follow the text operators of a content stream and add the words that they show."""
    if (words := _show_strings(stream, fonts, left, high)) is not None:
        page.words += words
        return
    stack: list = []
    font, size, scale, leading, spacing, blank = _Font(_Table(), 1, {}, 500.0), 1.0, 1.0, 0.0, 0.0, 0.0
    line, now = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0), (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)

    def moved(m: tuple, x: float, y: float) -> tuple:
        a, b, c, d, e, f = m
        return a, b, c, d, x * a + y * c + e, x * b + y * d + f

    def show(parts: list) -> None:
        nonlocal now
        word, begin = "", 0.0

        def close() -> None:
            nonlocal word
            if word:
                height = size * abs(now[3])
                page.words.append(Word(_whole(word), round(begin - left, 3), round(now[4] - left, 3), round(high - now[5] - height, 3), round(high - now[5], 3)))
            word = ""

        for part in parts:
            if isinstance(part, float):
                if part < -200:
                    close()
                now = moved(now, -part / 1000 * size * scale, 0.0)
                continue
            for char, width in font.decode(part):
                if char in _BLANKS:
                    close()
                elif not word:
                    begin = now[4]
                word += "" if char in _BLANKS else char
                now = moved(now, (width / 1000 * size + spacing + (blank if char == " " else 0.0)) * scale, 0.0)
        close()

    for token in _TOKEN.findall(stream):
        if token[:1] in b"(<" and token[:1]:
            stack.append(_string(token))
        elif token == b"[":
            stack.append(b"[")
        elif token[:1] == b"/" or token == b"]" or _NUMBERS.fullmatch(token):
            stack.append(float(token) if _NUMBERS.fullmatch(token) else token)
        else:
            numbers = [x for x in stack if isinstance(x, float)]
            if token == b"BT":
                line = now = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
            elif token == b"Tf" and numbers:
                font, size = fonts.get(next((x[1:] for x in stack if isinstance(x, bytes) and x[:1] == b"/"), b""), font), numbers[-1]
            elif token == b"Tz" and numbers:
                scale = numbers[-1] / 100
            elif token == b"TL" and numbers:
                leading = numbers[-1]
            elif token == b"Tc" and numbers:
                spacing = numbers[-1]
            elif token == b"Tw" and numbers:
                blank = numbers[-1]
            elif token == b"Tm" and len(numbers) >= 6:
                line = now = tuple(numbers[-6:])
            elif token in (b"Td", b"TD") and len(numbers) >= 2:
                leading = -numbers[-1] if token == b"TD" else leading
                line = now = moved(line, *numbers[-2:])
            elif token in (b"T*", b"'", b'"'):
                line = now = moved(line, 0.0, -leading)
            if token in (b"Tj", b"'", b'"', b"TJ"):
                show([x for x in stack if isinstance(x, float) and token == b"TJ" or isinstance(x, bytes) and x not in (b"[", b"]") and x[:1] != b"/"])
            stack = []


def read_pdf(content: bytes) -> list[Page]:
    """The pages of a file with their words in the order in which they are shown."""
    return Document(content).read()


def _packed(data: bytes) -> bytes:
    data = zlib.compress(data, 1)
    return b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(data), data)


_EVERY_CODE = _packed(b"1 begincodespacerange <0000> <FFFF> endcodespacerange\n" + b"".join(b"1 beginbfrange <%02X00> <%02XFF> <%02X00> endbfrange\n" % (k, k, k) for k in range(256)))


@lru_cache(maxsize=100_000)
def _codes(text: str) -> tuple[bytes, int]:
    raw = text.encode("utf-16-be", "surrogatepass")
    return raw.hex().upper().encode(), len(raw) // 2


@lru_cache(maxsize=100_000)
def _placed(x0: float, x1: float, y: float, size: float, n: int) -> bytes:
    return f"BT /F1 {size:g} Tf {(x1 - x0) / (n * size * 0.5) * 100:.8f} Tz 1 0 0 1 {x0:g} {y:g} Tm <".encode()


def make_pdf(pages: list[Page]) -> bytes:
    """A file that shows each word at its box; for tests and examples."""
    objects: list[bytes] = []

    def add(body: bytes) -> int:
        objects.append(body)
        return len(objects)

    table = add(_EVERY_CODE)
    inner = add(b"<< /Type /Font /Subtype /CIDFontType2 /BaseFont /Plain /DW 500 >>")
    font = add(b"<< /Type /Font /Subtype /Type0 /BaseFont /Plain /Encoding /Identity-H /DescendantFonts [%d 0 R] /ToUnicode %d 0 R >>" % (inner, table))
    parent, kids = len(objects) + 2 * len(pages) + 1, []
    for page in pages:
        shown = []
        for w in page.words:
            codes, n = _codes(w.text)
            shown.append(_placed(w.x0, w.x1, page.height - w.bottom, w.bottom - w.top, n) + codes + b"> Tj ET")
        contents = add(_packed(b"\n".join(shown)))
        kids.append(add(b"<< /Type /Page /Parent %d 0 R /MediaBox [0 0 %g %g] /Resources << /Font << /F1 %d 0 R >> >> /Contents %d 0 R >>" % (parent, page.width, page.height, font, contents)))
    add(b"<< /Type /Pages /Kids [%s] /Count %d >>" % (b" ".join(b"%d 0 R" % k for k in kids), len(kids)))
    root = add(b"<< /Type /Catalog /Pages %d 0 R >>" % parent)
    out, places = b"%PDF-1.4\n", []
    for n, body in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    start = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
    return out + b"trailer\n<< /Size %d /Root %d 0 R >>\nstartxref\n%d\n%%%%EOF" % (len(objects) + 1, root, start)


def read_words(files: DataFrame, reader: Callable[[bytes], list[Page]] = read_pdf, id_column: str = "path") -> DataFrame:
    """(id_column, page_num, width, height, word_no, text, x0, x1, top, bottom, error) of the words of ``files`` (id_column, content); word_no counts through a page. A file that cannot be read gives one row with its error."""
    kind = dict(files.dtypes)[id_column]
    names = [id_column, "page_num", "width", "height", "word_no", "text", "x0", "x1", "top", "bottom", "error"]
    numbers = [pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.string(), *[pa.float64()] * 4, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[tuple] = []
            for key, content in zip(b.column(0), b.column(1)):
                try:
                    held += [(key.as_py(), n, p.width, p.height, k, w.text, w.x0, w.x1, w.top, w.bottom, None) for n, p in enumerate(reader(content.as_py())) for k, w in enumerate(p.words)]
                except Exception as e:  # the row carries its error
                    held.append((key.as_py(), *[None] * 9, f"{type(e).__name__}: {e}"[:200]))
                if len(held) >= ROWS:
                    yield table(held, b.schema.field(0).type)
                    held = []
            yield table(held, b.schema.field(0).type)

    def table(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(names), [key, *numbers])], names=names)

    return files.select(id_column, "content").mapInArrow(run, f"{id_column} {kind}, page_num int, width double, height double, word_no int, text string, x0 double, x1 double, top double, bottom double, error string")


def map_files(files: DataFrame, make: Callable[[list[tuple]], list[tuple]], schema: str, reader: Callable[[bytes], list[Page]] = read_pdf) -> DataFrame:
    """The rows that ``make`` makes of some [(pages, other columns of the row), ...] of ``files`` (content, ...) at a time; files that cannot be read, or are null, have the pages None."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    columns = files.columns
    assert columns[0] == "content"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for content, *others in zip(*(b.column(k) for k in range(len(columns)))):
                try:
                    pages = reader(content.as_py())
                except Exception:  # as read_words says of it
                    pages = None
                held.append((pages, *[x.as_py() for x in others]))
                n += sum(len(p.words) for p in pages or ()) + 1
                if n >= ROWS:
                    yield table(make(held))
                    held, n = [], 0
        if held:
            yield table(make(held))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * len(arrow), arrow)], names=arrow.names)

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return files.mapInArrow(run, schema)
