"""Word and presentation files read with the standard library: paragraphs, table rows, slides, pictures.

The readers are functions of bytes; ``read_office`` maps them over a (path, content) DataFrame such as Spark's
binaryFile source gives. Defined results: bytes that are no ZIP go to the HTML fallback; broken files give an empty text
and an error message; a file without text has the raw text nodes, else an empty text.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html import unescape
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_MARK = re.compile(r"mso-|Microsoft\s+Word", re.I)


def html_text(raw: str) -> str:
    """The text of a page saved by a word processor, empty without its marks; the Column form is ``functions.text.html_fallback``."""
    if not (_MARK.search(raw) or "WordDocument" in raw):
        return ""
    bare = re.sub(r"<[^>]+>", " ", re.sub(r"<(style|script)\b[^>]*>.*?</\1>", " ", raw, flags=re.S | re.I), flags=re.S)
    for entity in ("&nbsp;", "&lt;", "&gt;", "&amp;", "&quot;"):
        bare = bare.replace(entity, unescape(entity).replace("\xa0", " "))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", bare)).strip()


def _text(node: ET.Element, tag: str) -> str:
    return "".join(t.text or "" for t in node.iter(tag))


def docx_parts(content: bytes, tables: bool = True) -> list[str]:
    """Stripped non-empty paragraphs, then table rows with cells joined by a bar."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    if body is None:
        return []
    parts = [t for p in body.findall(f"{_W}p") if (t := _text(p, f"{_W}t").strip())]
    for row in body.iter(f"{_W}tr") if tables else ():
        cells = [t for c in row.findall(f"{_W}tc") if (t := _text(c, f"{_W}t").strip())]
        if cells:
            parts.append(" | ".join(cells))
    return parts or [t for n in body.iter(f"{_W}t") if (t := (n.text or "").strip())]


def docx_pages(content: bytes) -> int:
    """Sections of a document, at least one."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return max(1, len(list(ET.fromstring(z.read("word/document.xml")).iter(f"{_W}sectPr"))))


def pptx_slides(content: bytes, tables: bool = True) -> list[str]:
    """One text per slide, in order: its text frames, else its table rows."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
        trees = [ET.fromstring(z.read(n)) for n in names]
    out = []
    for tree in trees:
        in_tables = {p for table in tree.iter(f"{_A}tbl") for p in table.iter(f"{_A}p")}
        frames = [t for p in tree.iter(f"{_A}p") if p not in in_tables and (t := _text(p, f"{_A}t").strip())]
        rows = [" | ".join(c for c in cells if c) for r in tree.iter(f"{_A}tr") if any(cells := [_text(c, f"{_A}t").strip() for c in r.findall(f"{_A}tc")])] if tables else []
        out.append("\n".join(frames + rows))
    return out


def office_images(content: bytes) -> list[tuple[str, bytes]]:
    """(name, bytes) of the pictures in a document or presentation, as stored."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return [(n.rsplit("/", 1)[-1], z.read(n)) for n in sorted(z.namelist()) if re.fullmatch(r"(?:word|ppt)/media/[^/]+", n)]


def read_one(path: str, content: bytes | None) -> tuple[list[str], str | None]:
    """(texts of the file's pages, error)."""
    try:
        if content is None:
            return [], "no content"
        if not zipfile.is_zipfile(io.BytesIO(content)):
            return [html_text(content.decode("utf-8", "replace"))], None
        return (pptx_slides(content) if path.lower().endswith(".pptx") else ["\n\n".join(docx_parts(content))]), None
    except Exception as e:  # a broken file is a row with its error, not the end of the job
        return [], f"{type(e).__name__}: {e}"[:200]


def read_office(files: DataFrame) -> DataFrame:
    """(path, page_num, text, error) of ``files`` (path, content): one row per page, one with the error of a broken file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b.path, b.content):
                texts, error = read_one(path, None if content is None else bytes(content))
                rows += [(path, k, t, None) for k, t in enumerate(texts)] if error is None else [(path, 0, "", error)]
            yield pd.DataFrame(rows, columns=["path", "page_num", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, page_num int, text string, error string")


# ---- writers, for round trips -----------------------------------------------------------------------------------

_BAD_XML = re.compile("[^\\t\\n\\r\\x20-\\ud7ff\\ue000-\\ufffd\\U00010000-\\U0010ffff]")


def _xml(text: str) -> str:
    return _BAD_XML.sub("", text).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def make_docx(paragraphs: list[str], rows: list[list[str]] = (), media: dict[str, bytes] | None = None) -> bytes:
    """A minimal document of paragraphs, one table and pictures."""
    p = lambda t: f'<w:p><w:r><w:t xml:space="preserve">{_xml(t)}</w:t></w:r></w:p>'
    table = "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in row) + "</w:tr>" for row in rows) + "</w:tbl>" if rows else ""
    body = f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{_W[1:-1]}"><w:body>{"".join(map(p, paragraphs))}{table}<w:sectPr/></w:body></w:document>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", body)
        for name, content in (media or {}).items():
            z.writestr(f"word/media/{name}", content)
    return out.getvalue()


def make_pptx(slides: list[list[str]]) -> bytes:
    """A minimal presentation: one list of text frames per slide."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for k, frames in enumerate(slides, 1):
            shapes = "".join(f"<a:p><a:r><a:t>{_xml(t)}</a:t></a:r></a:p>" for t in frames)
            z.writestr(f"ppt/slides/slide{k}.xml", f'<?xml version="1.0" encoding="UTF-8"?><p:sld xmlns:p="urn:p" xmlns:a="{_A[1:-1]}">{shapes}</p:sld>')
    return out.getvalue()
