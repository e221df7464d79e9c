"""Queries of the pipeline's mutations and drivers: analysis writes, marks, deletes, page texts, page joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quirefold.functions import columns as C
from quirefold.functions import text as T
from quirefold.operators import layout as L
from quirefold.operators import pages as P
from quirefold.plans import boxes, edges, texts
from quirefold.plans.catalog import assets, docs, in_time, logs, meta, pages
from quirefold.plans.sqltext import WORDS, count, lstrip, q, rstrip, strip
from quirefold.sources import office

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


# ---- writes and marks -------------------------------------------------------------------------------------------


@query("update_hash", "SELECT doc_id, md5(text) AS file_hash, 'NEW' AS status FROM documents WHERE text IS NOT NULL AND md5(text) IS DISTINCT FROM file_hash")
def update_hash(s, d):
    new = F.md5(F.col("text").cast("binary"))
    return docs(s, d).filter(F.col("text").isNotNull() & ~new.eqNullSafe(F.col("file_hash"))).select("doc_id", new.alias("file_hash"), F.lit("NEW").alias("status"))


@query("update_analysis", f"SELECT doc_id, source_type, layout_type, langs, has_formula, {texts._STRATEGY} AS strategy FROM {texts._PROFILED}")
def update_analysis(s, d):
    return texts._routed(s, d).select("doc_id", "source_type", "layout_type", F.array_join("langs", ",").alias("langs"), "has_formula", "strategy")


@query("classify_batch", f"SELECT strategy, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM (SELECT n_chars, {texts._STRATEGY} AS strategy FROM {texts._PROFILED}) GROUP BY strategy")
def classify_batch(s, d):
    return texts._routed(s, d).groupBy("strategy").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("reset_unique_errors", "SELECT doc_id, CASE WHEN doc_id IN (SELECT document_id FROM process_logs WHERE message LIKE '%500%' AND document_id IS NOT NULL) THEN 'NEW' ELSE status END AS status FROM documents")
def reset_unique_errors(s, d):
    hit = logs(s, d).filter(F.col("message").like("%500%") & F.col("document_id").isNotNull()).select(F.col("document_id").alias("doc_id")).distinct().withColumn("hit", F.lit(True))
    return docs(s, d).select("doc_id", "status").join(hit, "doc_id", "left").select("doc_id", F.when(F.col("hit"), "NEW").otherwise(F.col("status")).alias("status"))


def _mark(name: str, status: str, step: str, result: str) -> None:
    @query(name, f"SELECT doc_id AS document_id, '{status}' AS status, '{step}' AS step, '{result}' AS result FROM documents WHERE status = '{status}'")
    def run(s, d):
        return docs(s, d).filter(F.col("status") == status).select(F.col("doc_id").alias("document_id"), "status", F.lit(step).alias("step"), F.lit(result).alias("result"))


_mark("mark_uploaded", "UPLOADED", "UPLOAD", "SUCCESS")
_mark("mark_failed", "FAILED", "PIPELINE", "FAILURE")
_mark("mark_review", "REVIEW_REQUIRED", "PREPROCESS", "REVIEW_REQUIRED")


@query("verify_indexed", "SELECT doc_id, external_doc_id IS NOT NULL AS present FROM documents WHERE status = 'INDEXED'")
def verify_indexed(s, d):
    return docs(s, d).filter(F.col("status") == "INDEXED").select("doc_id", F.col("external_doc_id").isNotNull().alias("present"))


def _delete(name: str, table_name: str, of: Callable) -> None:
    @query(name, f"SELECT id FROM {table_name} WHERE document_id IS NOT NULL AND document_id NOT IN (SELECT doc_id FROM documents WHERE status = 'ANALYZING')")
    def run(s, d):
        again = docs(s, d).filter(F.col("status") == "ANALYZING").select(F.col("doc_id").alias("document_id"))
        return of(s, d).select("id", "document_id").filter("document_id IS NOT NULL").join(again, "document_id", "left_anti").select("id")


_delete("delete_assets", "document_assets", assets)
_delete("delete_pages", "page_contents", pages)
_delete("delete_metadata", "document_metadata", meta)


@query("report_fetch", "SELECT doc_id, status, created_at FROM documents")
def report_fetch(s, d):
    return in_time(s, d, docs(s, d), "created_at", "doc_id", "status", "created_at")


@query("retry", "SELECT document_id, count(DISTINCT id) AS attempts FROM process_logs WHERE step = 'UPLOAD' AND document_id IS NOT NULL GROUP BY document_id")
def retry(s, d):
    return logs(s, d).filter((F.col("step") == "UPLOAD") & F.col("document_id").isNotNull()).select("document_id", "id").distinct().groupBy("document_id").agg(F.count("*").alias("attempts"))


@query("placeholder_png", "SELECT id, octet_length(image_data) <= 100 AS placeholder FROM document_assets WHERE image_data IS NOT NULL")
def placeholder_png(s, d):
    return assets(s, d).filter("image_data IS NOT NULL").select("id", (F.octet_length("image_data") <= 100).alias("placeholder"))


# ---- page texts -------------------------------------------------------------------------------------------------


@query("digital_text", f"SELECT document_id, CASE WHEN {strip('t')} = '' THEN 0 ELSE {count('t', T.VALID)} END AS valid, CASE WHEN {strip('t')} = '' THEN 0 ELSE length(t) END AS n FROM (SELECT document_id, string_agg(coalesce(body_text, ''), chr(10) || chr(10) ORDER BY page_num, id) AS t FROM page_contents WHERE document_id IS NOT NULL GROUP BY document_id)")
def digital_text(s, d):
    parts = F.array_sort(F.collect_list(F.struct("page_num", "id", F.coalesce("body_text", F.lit("")).alias("t"))))  # the pages of one document
    joined = pages(s, d).filter("document_id IS NOT NULL").groupBy("document_id").agg(parts.alias("p")).select("document_id", F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("t"))
    valid, n = T.quality_counts(F.col("t"))
    return joined.select("document_id", valid.alias("valid"), n.alias("n"))


@query("words_to_text", f"WITH {WORDS}, {boxes._JOINED} SELECT doc_id, page_num, string_agg(text, chr(10) ORDER BY line) AS text FROM lines GROUP BY ALL")
def words_to_text(s, d):
    ordered = F.array_sort(F.collect_list(F.struct("line", "text")))  # the lines of one page
    return L.lines(boxes.words(s, d)).groupBy("doc_id", "page_num").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))


@query("words_to_paragraphs", boxes.SQL["paragraph_text"])
def words_to_paragraphs(s, d):
    return boxes.paragraph_text(s, d)


@query("find_column_gap", boxes.SQL["column_gap"])
def find_column_gap(s, d):
    return boxes.column_gap(s, d)


@query("paragraph_breaks", f"WITH {WORDS}, {boxes._JOINED}, {boxes._LINE_GAPS}, {boxes._MEDIANS}, {boxes._ENDS} SELECT doc_id, page_num, count(*) FILTER (WHERE ends_with(t, chr(10) || chr(10))) AS breaks FROM ended GROUP BY ALL")
def paragraph_breaks(s, d):
    text = L.paragraph_text(L.lines(boxes.words(s, d)))
    return text.select("doc_id", "page_num", F.regexp_count("text", F.lit("\n{2,}")).cast("long").alias("breaks"))


@query("docx_profile_source", edges.SQL["docx_source"].replace("AS path,", "AS path, 1 AS pages,", 1))
def docx_profile_source(s, d):
    """Paragraphs and sections of all texts written as documents."""
    made = edges._packed(edges._clean(docs(s, d).filter("text IS NOT NULL").select(F.col("doc_id").alias("id"), "text")), "docx")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b.path, "pages": [office.docx_pages(bytes(c)) for c in b.content], "text": ["\n\n".join(office.docx_parts(bytes(c), False)) for c in b.content]})

    return made.mapInPandas(run, "path string, pages int, text string")


@query("pptx_profile_source", "SELECT id || '.pptx' AS path, len(string_split(regexp_replace(body_text, '\\r\\n?', chr(10), 'g'), chr(10))) AS pages FROM page_contents WHERE body_text IS NOT NULL")
def pptx_profile_source(s, d):
    """Slides of all pages written as presentations, a slide per line."""
    made = edges._packed(edges._clean(pages(s, d).filter("body_text IS NOT NULL").select("id", F.col("body_text").alias("text"))), "pptx")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b.path, "pages": [max(1, len(office.pptx_slides(bytes(c), False))) for c in b.content]})

    return made.mapInPandas(run, "path string, pages long")


# ---- page functions over the stored pages -----------------------------------------------------------------------

_EMPTY = "chr(10) || chr(10)"
_LOWER = q(C.T_LOWER)


def _caption(c: str) -> str:
    return f"(regexp_matches({c}, {q(T.FIGURE_CAPTION)}) OR regexp_matches({c}, {q(T.TABLE_CAPTION)}))"


def _parts(c: str) -> str:
    return f"list_filter(string_split({strip(c)}, {_EMPTY}), lambda x: {strip('x')} <> '')"


def _stack(*texts: str) -> str:
    return f"array_to_string(list_filter([{', '.join(texts)}], lambda x: x <> ''), {_EMPTY})"


def _joined_sql(src: str) -> str:
    """Steps from ``src`` (id, l, r, ...) to ``src``_j with the joined ``text``."""
    caption = _caption(strip("x"))
    last = f"regexp_replace(lower(regexp_extract(tail, {q(C.LAST_WORD)}, 1)), '[.,;:?!]+\\z', '')"
    words = ", ".join(f"'{w}'" for w in C.MID_SENTENCE)
    return f"""{src}_a AS (SELECT *, {_parts('l')} AS ls, {_parts('r')} AS rs FROM {src}),
{src}_b AS (SELECT *, greatest(coalesce(list_position(list_transform(rs, lambda x: {caption}), false), 0) - 1, 0) AS n FROM {src}_a),
{src}_c AS (SELECT *, coalesce({rstrip('ls[len(ls)]')}, '') AS tail, coalesce({lstrip('rs[n + 1]')}, '') AS head FROM {src}_b),
{src}_d AS (SELECT *, len(ls) > 0 AND len(rs) > 0 AND NOT regexp_matches(tail, {q(C.ENDED)}) AND (regexp_matches(head, {_LOWER}) OR regexp_matches(head, {q(C.ABBREVIATION)}) OR (n > 0 AND {last} IN ({words}))) AS met,
  CASE WHEN ends_with(tail, '-') THEN left(tail, length(tail) - 1) || head ELSE tail || ' ' || head END AS glued FROM {src}_c),
{src}_j AS (SELECT *, CASE WHEN met THEN {_stack(f"array_to_string(list_append(ls[1:len(ls) - 1], glued), {_EMPTY})", f"array_to_string(list_concat(rs[1:n], rs[n + 2:len(rs)]), {_EMPTY})")} ELSE {_stack(strip('l'), strip('r'))} END AS text FROM {src}_d)"""


def _text(c: str) -> Column:
    return F.coalesce(c, F.lit(""))


@query("join_columns", f"WITH s AS (SELECT id, coalesce(header_text, '') AS l, coalesce(body_text, '') AS r FROM page_contents), {_joined_sql('s')} SELECT id, text FROM s_j")
def join_columns(s, d):
    """Header and body of each page joined as two columns."""
    return pages(s, d).select("id", C.join_columns(_text("header_text"), _text("body_text")).alias("text"))


@query("connect_columns", f"WITH s AS (SELECT id, coalesce(header_text, '') AS l, coalesce(body_text, '') AS r FROM page_contents), {_joined_sql('s')}, m AS (SELECT *, len(ls) > 0 AND len(rs) > 0 AND NOT regexp_matches({rstrip('ls[len(ls)]')}, {q(C.ENDED)}) AND regexp_matches({lstrip('rs[1]')}, {_LOWER}) AS joins, CASE WHEN ends_with(tail, '-') THEN left(tail, length(tail) - 1) ELSE tail || ' ' END || {lstrip('rs[1]')} AS mended FROM s_d) SELECT id, CASE WHEN joins THEN array_to_string(list_append(ls[1:len(ls) - 1], mended), {_EMPTY}) ELSE l END AS left_text, CASE WHEN joins THEN array_to_string(rs[2:len(rs)], {_EMPTY}) ELSE r END AS right_text FROM m")
def connect_columns(s, d):
    """Header and body of each page as two columns, connected where a sentence runs over."""
    return pages(s, d).select("id", C.connect_columns(_text("header_text"), _text("body_text")).alias("c")).select("id", F.col("c.left").alias("left_text"), F.col("c.right").alias("right_text"))


@query("insert_after", f"SELECT id, CASE WHEN coalesce(k, 0) = 0 THEN t ELSE array_to_string(list_concat(list_append(lines[1:k], '[TABLE_000]'), lines[k + 1:len(lines)]), chr(10)) END AS text FROM (SELECT *, list_position(list_transform(lines, lambda x: regexp_matches({strip('x')}, {q(T.LIST_ITEM)}) OR regexp_matches({strip('x')}, {q(T.TABLE_CAPTION)})), true) AS k FROM (SELECT id, coalesce(body_text, '') AS t, string_split(coalesce(body_text, ''), chr(10)) AS lines FROM page_contents))")
def insert_after(s, d):
    """Each page's body with a tag after its first caption of a table or its first list item."""
    return pages(s, d).select("id", C.insert_after(_text("body_text"), f"{T.LIST_ITEM}|{T.TABLE_CAPTION}", F.lit("[TABLE_000]")).alias("text"))


_AROUND = f"""s AS (SELECT id, coalesce(body_text, '') AS l0, coalesce(footer_text, '') AS r0 FROM page_contents),
f AS (SELECT *, {_parts('l0')} AS pl, {_parts('r0')} AS pr FROM s),
g AS (SELECT *, list_position(list_reverse(list_transform(pl, lambda x: {_caption(strip('x'))})), false) AS k, list_position(list_transform(pr, lambda x: {_caption(strip('x'))} OR ends_with({strip('x')}, '…') OR regexp_matches({strip('x')}, {q('^' + T.REF_TAG)})), false) AS m FROM f),
h AS (SELECT *, len(pl) - CASE WHEN coalesce(k, 0) = 0 THEN len(pl) ELSE k - 1 END AS keep, CASE WHEN coalesce(m, 0) = 0 THEN len(pr) ELSE m - 1 END AS aside FROM g),
i AS (SELECT *, len(pl) = 0 OR len(pr) = 0 OR (keep = len(pl) AND aside = 0) AS plain FROM h),
o AS (SELECT *, CASE WHEN plain THEN l0 ELSE array_to_string(pl[1:keep], {_EMPTY}) END AS l, CASE WHEN plain THEN r0 ELSE array_to_string(pr[aside + 1:len(pr)], {_EMPTY}) END AS r FROM i)"""


@query("join_columns_captions", f"WITH {_AROUND}, {_joined_sql('o')}, y AS (SELECT *, {_parts('text')} AS j FROM o_j) SELECT id, CASE WHEN plain THEN text ELSE array_to_string(list_concat(list_concat(j[1:keep], list_concat(pl[keep + 1:len(pl)], pr[1:aside])), j[keep + 1:len(j)]), {_EMPTY}) END AS text FROM y")
def join_columns_captions(s, d):
    """Body and footer of each page joined as two columns with captions."""
    return pages(s, d).select("id", C.join_columns_captions(_text("body_text"), _text("footer_text")).alias("text"))


@query("join_zones", f"""WITH s AS (SELECT id, coalesce(header_text, '') AS h, coalesce(body_text, '') AS t FROM page_contents),
e AS (SELECT *, regexp_extract({rstrip('h')}, '[^\n]*\\z') AS b, regexp_extract({lstrip('t')}, '\\A[^\n]*') AS a FROM s)
SELECT id, CASE WHEN b <> '' AND NOT regexp_matches(b, {q(C.FINISHED)}) AND regexp_matches(a, {_LOWER}) THEN {strip(f"{rstrip('h')} || ' [FIGURE_000] ' || {lstrip('t')}")} ELSE {_stack(strip('h'), "'[FIGURE_000]'", strip('t'))} END AS text FROM e""")
def join_zones(s, d):
    """A tag between header and body of each page."""
    return pages(s, d).select("id", C.join_zones(_text("header_text"), F.lit("[FIGURE_000]"), _text("body_text")).alias("text"))


@query("strip_captions", f"""SELECT id, r.done || coalesce(r.now, '') AS text FROM (SELECT id, list_reduce(list_prepend({{'done': '', 'now': NULL::VARCHAR, 'cut': false}}, list_transform(string_split(coalesce(body_text, ''), chr(10)), lambda x: {{'done': '', 'now': x, 'cut': false}})),
lambda a, b: CASE WHEN {_caption(strip('b.now'))} THEN {{'done': a.done, 'now': a.now, 'cut': true}}
WHEN a.cut AND {strip('b.now')} <> '' AND {rstrip("coalesce(a.now, '')")} <> '' AND NOT regexp_matches({rstrip('a.now')}, {q(C.FINISHED)}) AND regexp_matches({lstrip('b.now')}, {_LOWER}) THEN {{'done': a.done, 'now': {rstrip('a.now')} || ' ' || {lstrip('b.now')}, 'cut': false}}
ELSE {{'done': CASE WHEN a.now IS NULL THEN a.done ELSE a.done || a.now || chr(10) END, 'now': b.now, 'cut': a.cut AND {strip('b.now')} = ''}} END) AS r FROM page_contents)""")
def strip_captions(s, d):
    """Each page's body without caption lines."""
    return pages(s, d).select("id", C.strip_captions(_text("body_text")).alias("text"))


@query("legacy_reflow", f"SELECT id, array_to_string(list_transform(list_filter(regexp_split_to_array({strip('t')}, {q(rf'\n{T.SPACE}*\n')}), lambda x: {strip('x')} <> ''), lambda x: regexp_replace(regexp_replace({strip('x')}, {q(rf'-\n{T.SPACE}*')}, '', 'g'), {q(rf'{T.SPACE}*\n{T.SPACE}*')}, ' ', 'g')), {_EMPTY}) AS text FROM (SELECT id, coalesce(body_text, '') AS t FROM page_contents)")
def legacy_reflow(s, d):
    """Each page's paragraphs as one line."""
    return pages(s, d).select("id", C.paragraphs_reflow(_text("body_text")).alias("text"))


@query("wrap_col", f"""SELECT id, r.done || r.now AS text FROM (SELECT id, list_reduce(list_prepend({{'done': '', 'now': ''}}, list_transform(flatten(list_transform(list_filter(regexp_split_to_array(coalesce(body_text, ''), {q(T.SPACE + '+')}), lambda x: x <> ''), lambda x: regexp_extract_all(x, '(?s).{{1,33}}'))), lambda x: {{'done': '', 'now': x}})),
lambda a, b: CASE WHEN a.now = '' THEN {{'done': a.done, 'now': b.now}} WHEN length(a.now) + 1 + length(b.now) > 33 THEN {{'done': a.done || a.now || chr(10), 'now': b.now}} ELSE {{'done': a.done, 'now': a.now || ' ' || b.now}} END) AS r FROM page_contents)""")
def wrap_col(s, d):
    """Each page's body wrapped at 33 characters."""
    return pages(s, d).select("id", C.wrap(_text("body_text")).alias("text"))


def _words_of(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, {q(T.SPACE + '+')}), lambda x: x <> '')"


@query("align_rows", f"""WITH s AS (SELECT id, string_split(coalesce(body_text, ''), chr(10)) AS lines, {_words_of("coalesce(nullif(header_text, ''), body_text, '')")} AS w FROM page_contents),
n AS (SELECT *, list_transform(lines, lambda r: len({_words_of('r')})) AS sizes FROM s),
m AS (SELECT *, list_sum(sizes) AS total, len(sizes) - list_position(list_reverse(list_transform(sizes, lambda n: n > 0)), true) + 1 AS last FROM n),
t AS (SELECT *, list_transform(sizes, lambda x, i: CASE WHEN x = 0 THEN 0 WHEN i = last THEN len(w) ELSE greatest(1, CAST(round_even(x / total * len(w), 0) AS BIGINT)) END) AS takes FROM m)
SELECT id, array_to_string(list_transform(takes, lambda x, i: array_to_string(w[coalesce(list_sum(takes[1:i - 1]), 0) + 1:coalesce(list_sum(takes[1:i - 1]), 0) + x], ' ')), chr(10)) AS text FROM t""")
def align_rows(s, d):
    """The header's words (the body's where there is no header) handed out to the body's lines."""
    words = F.filter(F.split(F.coalesce(F.nullif("header_text", F.lit("")), "body_text", F.lit("")), rf"{T.SPACE}+"), lambda w: w != "")
    return pages(s, d).select("id", C.let(F.struct(F.split(_text("body_text"), "\n").alias("lines"), words.alias("w")), lambda x: F.array_join(C.align_rows(x.lines, x.w), "\n")).alias("text"))


def _cell(c: str) -> str:
    return f"coalesce(replace({c}[i + 1], '|', '\\|'), '')"


@query("make_3col_table", f"""SELECT id, array_to_string(list_concat(['| header | body | footer |', '| --- | --- | --- |'], list_transform(range(greatest(len(h), len(b), len(f))), lambda i: '| ' || {_cell('h')} || ' | ' || {_cell('b')} || ' | ' || {_cell('f')} || ' |')), chr(10)) AS text
FROM (SELECT id, string_split(coalesce(header_text, ''), chr(10)) AS h, string_split(coalesce(body_text, ''), chr(10)) AS b, string_split(coalesce(footer_text, ''), chr(10)) AS f FROM page_contents)""")
def make_3col_table(s, d):
    """Each page's three fields side by side."""
    lines = [F.split(_text(c), "\n") for c in ("header_text", "body_text", "footer_text")]
    return pages(s, d).select("id", C.markdown_table(lines, ["header", "body", "footer"]).alias("text"))


@query("inject_scanned")
def inject_scanned(s, d):
    """Each page's body with the tags of its assets at their captions or heights (pages of 800 points)."""
    held = assets(s, d).filter("bbox_y0 IS NOT NULL AND document_id IS NOT NULL").groupBy("document_id", "page_num").agg(F.array_sort(F.collect_list(F.struct("ref_tag", "asset_type", "bbox_y0"))).alias("held"))  # the assets of one page

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b.id, "text": [P.inject_scanned(t, [(a["ref_tag"], a["asset_type"], a["bbox_y0"], 800.0) for a in h]) for t, h in zip(b.body_text, b.held)]})

    return pages(s, d).filter("body_text IS NOT NULL").select("id", "document_id", "page_num", "body_text").join(held, ["document_id", "page_num"]).select("id", "body_text", "held").mapInPandas(run, "id long, text string")


@query("step_log", "SELECT step, result, count(DISTINCT id) AS n FROM process_logs GROUP BY ALL")
def step_log(s, d):
    return logs(s, d).select("id", "step", "result").distinct().groupBy("step", "result").agg(F.count("*").alias("n"))
