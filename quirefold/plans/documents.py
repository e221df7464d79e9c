"""Queries of PDF pages: texts written as files, read back as word boxes, and composed into reading order."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.operators import pages as P
from quirefold.operators import viewer as V
from quirefold.plans import boxes
from quirefold.plans.catalog import assets, docs
from quirefold.plans.pipeline import _joined_sql, _stack
from quirefold.plans.sqltext import HEIGHT, LINE, WIDTH, WORDS
from quirefold.sources import pdf

QUERIES: dict = {}
SQL: dict[str, str] = {}
PAGE = ["doc_id", "page_num"]


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def _texts(s, d) -> DataFrame:
    return docs(s, d).filter("text IS NOT NULL").select("doc_id", "text")


def _files(s, d, texts: DataFrame | None = None) -> DataFrame:
    """(doc_id, content): every text, or each of ``texts``, as a PDF of its word boxes; texts of one document are one file."""

    def made(rows: list[tuple]) -> tuple:
        rows.sort(key=itemgetter(1, 2))
        pages = [pdf.Page(WIDTH, HEIGHT, [pdf.Word(*r[3:]) for r in page]) for _, page in groupby(rows, key=itemgetter(1))]
        return rows[0][0], pdf.make_pdf(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the document whose words may go on in the next batch
        for b in batches:
            out = []
            for key, group in groupby(zip(*(c.to_pylist() for c in b.columns)), key=itemgetter(0)):
                if held and held[0][0] != key:
                    out.append(made(held))
                    held = []
                held.extend(group)
            yield batch(out)
        yield batch([made(held)] if held else [])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        keys, contents = zip(*rows) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(contents, pa.binary())], names=["doc_id", "content"])

    w = boxes.words(s, d, texts).select("doc_id", "page_num", "word_no", "text", "x0", "x1", "top", "bottom")
    return w.sortWithinPartitions("doc_id").mapInArrow(run, "doc_id long, content binary")


def words(s, d) -> DataFrame:
    """The word boxes read from the files; word_no counts through a page."""
    return pdf.read_words(_files(s, d), id_column="doc_id").filter("error IS NULL").drop("width", "height", "error")


def _of_pages(s, d, text) -> DataFrame:
    """(doc_id, page_num, text) of the pages of every file that have a word; ``text`` makes it of the words."""

    def make(held: list[tuple]) -> list[tuple]:
        return [(doc, n, text(page.words)) for read, doc in held for n, page in enumerate(read or ()) if page.words]

    return pdf.map_files(_files(s, d).select("content", "doc_id"), make, "doc_id long, page_num int, text string")


@query("pdf_words_source", f"WITH {WORDS} SELECT doc_id, page_num, CAST(word_no % 400 AS INTEGER) AS word_no, text, x0, x1, top, bottom FROM words")
def pdf_words_source(s, d):
    return words(s, d).select(*PAGE, "word_no", "text", "x0", "x1", "top", "bottom")


@query("pdf_text_source", f"WITH {WORDS}, {boxes._JOINED}, p AS (SELECT doc_id, page_num, string_agg(text, chr(10) ORDER BY line) AS text FROM lines GROUP BY ALL) SELECT doc_id, string_agg(text, chr(10) ORDER BY page_num) AS text, count(*) AS n_pages, CAST(sum(length(text)) AS BIGINT) AS chars FROM p GROUP BY doc_id")
def pdf_text_source(s, d):
    """Plain text of each file, its pages in order, with their number and their characters."""
    page = _of_pages(s, d, lambda boxes: "\n".join(line.text() for line in P.to_lines(boxes, merged=False)))
    parts = F.array_sort(F.collect_list(F.struct("page_num", "text")))  # the pages of one document
    return page.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"), F.count("*").alias("n_pages"), F.sum(F.length("text")).alias("chars"))


def _composed(s, d) -> DataFrame:
    return P.compose_files(_files(s, d).withColumn("assets", F.lit(None).cast(_HELD)), WIDTH, HEIGHT)


_HELD = "array<struct<page_num: int, ref_tag: string, bbox_x0: double, bbox_y0: double, bbox_x1: double, bbox_y1: double>>"


# a page of two columns: the lines across both above the body, the left column, the right one; its paragraphs as ever
_SIDED = f"""placed AS (SELECT w.*, {LINE} AS at_line, g.gap_x, st.body_y, (x0 + x1) / 2 >= coalesce(g.gap_x, 1e9) AS is_right FROM words w LEFT JOIN gaps g USING (doc_id, page_num) LEFT JOIN starts st USING (doc_id, page_num)),
zoned AS (SELECT *, CASE WHEN gap_x IS NULL THEN 'one' WHEN coalesce(top < body_y, false) AND bool_or(is_right) OVER b AND bool_or(NOT is_right) OVER b THEN 'header' WHEN is_right THEN 'right' ELSE 'left' END AS zone FROM placed WINDOW b AS (PARTITION BY doc_id, page_num, at_line)),
edged AS (SELECT *, lag(x1) OVER (PARTITION BY doc_id, page_num, zone, at_line ORDER BY x0, word_no) AS edge FROM zoned),
zlines AS (SELECT doc_id, page_num, zone, at_line, string_agg(CASE WHEN edge IS NULL OR x0 - edge < 1.0 THEN '' ELSE ' ' END || text, '' ORDER BY x0, word_no) AS text, min(top) AS top, max(bottom) AS bottom FROM edged GROUP BY ALL),
zgaps AS (SELECT *, CASE WHEN below IS NOT NULL THEN greatest(below - bottom, 0) END AS gap FROM (SELECT *, lead(top) OVER (PARTITION BY doc_id, page_num, zone ORDER BY at_line) AS below FROM zlines)),
zmedians AS (SELECT doc_id, page_num, zone, list_sort(list(gap))[len(list(gap)) // 2 + 1] AS g FROM zgaps WHERE gap > 0 GROUP BY ALL),
zended AS (SELECT l.doc_id, l.page_num, l.zone, l.at_line, l.text || CASE WHEN l.gap IS NULL THEN '' WHEN m.g IS NULL THEN chr(10) WHEN l.gap >= greatest(m.g * 2.1::DOUBLE, greatest(m.g * 1.35::DOUBLE, m.g + 1) + 3) THEN repeat(chr(10), 3) WHEN l.gap >= greatest(m.g * 1.35::DOUBLE, m.g + 1) THEN repeat(chr(10), 2) ELSE chr(10) END AS t
  FROM zgaps l LEFT JOIN zmedians m USING (doc_id, page_num, zone)),
ztexts AS (SELECT doc_id, page_num, zone, string_agg(t, '' ORDER BY at_line) AS t FROM zended GROUP BY ALL),
cols AS (SELECT doc_id, page_num, any_value(t) FILTER (WHERE zone = 'one') AS one, coalesce(any_value(t) FILTER (WHERE zone = 'header'), '') AS top_text, coalesce(any_value(t) FILTER (WHERE zone = 'left'), '') AS l, coalesce(any_value(t) FILTER (WHERE zone = 'right'), '') AS r FROM ztexts GROUP BY ALL),
{_joined_sql('cols')},
pages_text AS (SELECT doc_id, page_num, one IS NULL AS multi, CASE WHEN one IS NOT NULL THEN one ELSE {_stack('top_text', 'text')} END AS text FROM cols_j)"""
_PAGES = f"WITH {WORDS}, {boxes._COVER}, {boxes._GAPS}, {boxes._SIDES}, {boxes._STARTS}, {_SIDED}"


@query("digital_page_driver", f"{_PAGES} SELECT doc_id, page_num, text FROM pages_text")
def digital_page_driver(s, d):
    """Every page of every file in reading order."""
    return _composed(s, d).select(*PAGE, "text")


@query("digital_multicol_pages", f"{_PAGES} SELECT doc_id, page_num, text FROM pages_text WHERE multi")
def digital_multicol_pages(s, d):
    """The pages of two columns in reading order."""
    return _composed(s, d).filter("multi").select(*PAGE, "text")


@query("digital_multicol_text", f"{_PAGES} SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY page_num) AS text FROM pages_text GROUP BY doc_id")
def digital_multicol_text(s, d):
    """Every file's pages in reading order, with an empty line between them."""
    parts = F.array_sort(F.collect_list(F.struct("page_num", "text")))  # the pages of one document
    return _composed(s, d).groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n\n").alias("text"))


_VIEW = f"""sorted AS (SELECT *, CASE WHEN top < {HEIGHT} * 0.08::DOUBLE THEN 'header' WHEN top > {HEIGHT} * 0.93::DOUBLE THEN 'footer' ELSE 'main' END AS zone FROM words),
rows5 AS (SELECT doc_id, page_num, zone, round_even(top / 5, 0) * 5 AS line, string_agg(text, ' ' ORDER BY x0, word_no) AS t FROM sorted GROUP BY ALL),
one AS (SELECT doc_id, page_num, zone, string_agg(t, ' | ' ORDER BY line) AS t FROM rows5 GROUP BY ALL)"""
_MAIN = f"{WORDS.replace('words AS (', 'all_words AS (')}, words AS (SELECT * FROM all_words WHERE top BETWEEN {HEIGHT} * 0.08::DOUBLE AND {HEIGHT} * 0.93::DOUBLE), {boxes._JOINED}, {boxes._LINE_GAPS}, {boxes._MEDIANS}, {boxes._ENDS}, main AS (SELECT doc_id, page_num, string_agg(t, '' ORDER BY line) AS t FROM ended GROUP BY ALL), {_VIEW.replace('FROM words)', 'FROM all_words)')}"


@query("plumber_page_text", f"WITH {_MAIN} SELECT p.doc_id, p.page_num, array_to_string(list_filter([CASE WHEN h.t IS NOT NULL THEN '[헤더]' || chr(10) || h.t END, coalesce(m.t, '(추출된 텍스트 없음)'), CASE WHEN f.t IS NOT NULL THEN '[푸터]' || chr(10) || f.t END], lambda x: x IS NOT NULL), chr(10) || chr(10)) AS text FROM (SELECT DISTINCT doc_id, page_num FROM all_words) p LEFT JOIN main m USING (doc_id, page_num) LEFT JOIN (SELECT * FROM one WHERE zone = 'header') h USING (doc_id, page_num) LEFT JOIN (SELECT * FROM one WHERE zone = 'footer') f USING (doc_id, page_num)")
def plumber_page_text(s, d):
    """The viewer's text of each page: the header's words, the paragraphs, the footer's words."""
    return _of_pages(s, d, lambda boxes: V.page_text(boxes, HEIGHT))


@query("process_digital")
def process_digital(s, d):
    """Every page of every file with the tags of its stored assets, and their number."""
    boxed = assets(s, d).filter("bbox_x0 IS NOT NULL").withColumnRenamed("document_id", "doc_id")
    held = boxed.groupBy("doc_id").agg(F.collect_list(F.struct("page_num", "ref_tag", "bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1")).cast(_HELD).alias("assets"))  # the assets of one document
    # only the files of documents that have assets move to them
    same = lambda a: F.col(f"{a}.doc_id").eqNullSafe(F.col("h.doc_id"))
    texts, with_some = _texts(s, d).alias("t"), held.select("doc_id").alias("h")
    files = _files(s, d, texts.join(with_some, same("t"), "left_semi")).alias("f").join(held.alias("h"), same("f"), "full")
    files = files.select("content", F.coalesce("f.doc_id", "h.doc_id").alias("doc_id"), "assets")
    bare = _files(s, d, texts.join(with_some, same("t"), "left_anti")).withColumn("assets", F.lit(None).cast(_HELD))
    return P.compose_files(files.unionByName(bare), WIDTH, HEIGHT).select(*PAGE, "text", "n_assets")


boxes.SQL["compose_multicol"] = SQL["digital_page_driver"]
