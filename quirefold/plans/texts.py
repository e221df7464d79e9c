"""Queries of the text operators: quality, cleaning, re-flow, gate, routing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.functions import reflow as R
from quirefold.functions import text as T
from quirefold.operators import classify
from quirefold.plans.catalog import assets, docs, pages
from quirefold.plans.sqltext import LINES, count, match, newline_norm, q, strip, sub

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def texts(s, d) -> DataFrame:
    return docs(s, d).filter("text IS NOT NULL").select("doc_id", "lang", "file_name", "text")


_BLANK = f"{strip('text')} = ''"
_COUNTS = f"CASE WHEN {_BLANK} THEN 0 ELSE {count('text', T.VALID)} END AS valid, CASE WHEN {_BLANK} THEN 0 ELSE length(text) END AS n"


@query("quality_score", f"SELECT doc_id, {_COUNTS} FROM documents WHERE text IS NOT NULL")
def quality_score(s, d):
    """Valid and all characters; the score is their ratio, kept as two integers so that engines agree."""
    valid, n = T.quality_counts(F.col("text"))
    return texts(s, d).select("doc_id", valid.alias("valid"), n.alias("n"))


@query("meets_quality", f"SELECT doc_id, n > 0 AND length(text) >= 50 AND valid * 2 >= n AS ok FROM (SELECT doc_id, text, {_COUNTS} FROM documents WHERE text IS NOT NULL)")
def meets_quality(s, d):
    return texts(s, d).select("doc_id", T.meets_quality(F.col("text")).alias("ok"))


@query("ctrl_strip", f"SELECT doc_id, {sub('text', T.CONTROL, q(''))} AS text FROM documents WHERE text IS NOT NULL")
def ctrl_strip(s, d):
    return texts(s, d).select("doc_id", T.ctrl_strip(F.col("text")).alias("text"))


@query("newline_norm", f"SELECT doc_id, {newline_norm('text')} AS text FROM documents WHERE text IS NOT NULL")
def newline_norm_(s, d):
    return texts(s, d).select("doc_id", T.newline_norm(F.col("text")).alias("text"))


_SPACES = "replace(translate(text, chr(12288) || chr(160) || chr(9), '   '), chr(65279), '')"


@query("space_norm", f"SELECT doc_id, {_SPACES} AS text FROM documents WHERE text IS NOT NULL")
def space_norm(s, d):
    return texts(s, d).select("doc_id", T.space_norm(F.col("text")).alias("text"))


@query("dehyphen", f"SELECT id, regexp_replace({newline_norm('body_text')}, {q(rf'({T.LETTER})-\n({T.LETTER})')}, '\\1\\2', 'g') AS text FROM page_contents WHERE body_text IS NOT NULL")
def dehyphen(s, d):
    return pages(s, d).filter("body_text IS NOT NULL").select("id", T.dehyphen(T.newline_norm(F.col("body_text"))).alias("text"))


@query("collapse_blank", f"SELECT doc_id, {strip('regexp_replace(' + newline_norm('text') + ', ' + q(chr(92) + 'n{4,}') + ', chr(10) || chr(10) || chr(10), ' + q('g') + ')')} AS text FROM documents WHERE text IS NOT NULL")
def collapse_blank(s, d):
    return texts(s, d).select("doc_id", T.collapse_blank(T.newline_norm(F.col("text"))).alias("text"))


@query("formula_text", f"SELECT doc_id, length(text) > 0 AND {count('text', T.MATH)} >= length(text) * 0.008::DOUBLE AS has_formula FROM documents WHERE text IS NOT NULL")
def formula_text(s, d):
    return texts(s, d).select("doc_id", T.formula_text(F.col("text")).alias("has_formula"))


_HEAD = "left(coalesce(text, ''), 3000)"


def _share(pattern: str, code: str) -> str:
    return f"CASE WHEN {count('head', pattern)} >= greatest(length(head), 1) * 0.03::DOUBLE THEN '{code}' END"


_LANGS = f"""CASE WHEN length(head) < 20 THEN CASE WHEN {match("coalesce(file_name, '')", T.HANGUL)} THEN 'kor,eng' ELSE 'eng' END
ELSE coalesce(nullif(concat_ws(',', {_share(T.HANGUL, 'kor')}, {_share(T.KANA, 'jpn')}, {_share(T.LATIN, 'eng')}), ''), 'eng') END"""


@query("detect_langs", f"SELECT doc_id, {_LANGS} AS langs FROM (SELECT *, {_HEAD} AS head FROM documents)")
def detect_langs(s, d):
    head = F.left(F.coalesce("text", F.lit("")), F.lit(3000))
    return docs(s, d).select("doc_id", F.array_join(T.detect_langs(head, F.col("file_name")), ",").alias("langs"))


@query("languages_csv", "SELECT doc_id, len(string_split(detected_languages, ',')) AS n FROM documents WHERE detected_languages IS NOT NULL")
def languages_csv(s, d):
    return docs(s, d).filter("detected_languages IS NOT NULL").select("doc_id", F.size(F.split("detected_languages", ",")).cast("long").alias("n"))


@query("josa_fix", f"SELECT id, regexp_replace(regexp_replace(body_text, {q(f'({T.CLOSED})올([' + chr(92) + 's.,;:!?]|' + chr(92) + 'z)')}, '\\1을\\2', 'g'), {q(f'({T.CLOSED})름([' + chr(92) + 's.,;:!?]|' + chr(92) + 'z)')}, '\\1를\\2', 'g') AS text FROM page_contents WHERE body_text IS NOT NULL")
def josa_fix(s, d):
    return pages(s, d).filter("body_text IS NOT NULL").select("id", T.josa_fix(F.col("body_text")).alias("text"))


_FIXED = "ocr_text"
for _a, _b in T.OCR_FIXES:
    _FIXED = f"replace({_FIXED}, '{_a}', '{_b}')"


@query("ocr_dict_fix", f"SELECT id, regexp_replace(regexp_replace({_FIXED}, {q(f'({T.CLOSED})올([' + chr(92) + 's.,;:!?]|' + chr(92) + 'z)')}, '\\1을\\2', 'g'), {q(f'({T.CLOSED})름([' + chr(92) + 's.,;:!?]|' + chr(92) + 'z)')}, '\\1를\\2', 'g') AS text FROM document_assets WHERE ocr_text IS NOT NULL")
def ocr_dict_fix(s, d):
    return assets(s, d).filter("ocr_text IS NOT NULL").select("id", T.ocr_dict_fix(F.col("ocr_text")).alias("text"))


_HTML = "'<html><style>p {mso-style: x}</style><body>' || chr(10) || '<p>' || coalesce(body_text, '') || '</p>&nbsp;&amp;&lt;b&gt;' || chr(10) || chr(10) || chr(10) || '<i>' || coalesce(header_text, '') || '</i>'"


def _html_sql() -> str:
    t = sub("html", r"(?is)<(?:style|script)\b[^>]*>.*?</(?:style|script)>", "' '")
    t = sub(t, r"(?s)<[^>]+>", "' '")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"')):
        t = f"replace({t}, '{entity}', '{char}')"
    return strip(sub(sub(t, r"[ \t]+", "' '"), r"\n{3,}", "chr(10) || chr(10)"))


@query("html_fallback", f"SELECT id, {_html_sql()} AS text FROM (SELECT id, {_HTML} AS html FROM page_contents)")
def html_fallback(s, d):
    """The stored pages wrapped as pages of a word processor, read back."""
    e = lambda c: F.coalesce(c, F.lit(""))
    html = F.concat(F.lit("<html><style>p {mso-style: x}</style><body>\n<p>"), e("body_text"), F.lit("</p>&nbsp;&amp;&lt;b&gt;\n\n\n<i>"), e("header_text"), F.lit("</i>"))
    return pages(s, d).select("id", T.html_fallback(html).alias("text"))


@query("first_nonblank_line", f"SELECT id, left(list_filter(list_transform(string_split({newline_norm('body_text')}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')[1], 200) AS title FROM page_contents WHERE body_text IS NOT NULL")
def first_nonblank_line(s, d):
    lines = F.filter(F.transform(F.split(T.newline_norm(F.col("body_text")), "\n"), T.strip), lambda x: x != "")
    return pages(s, d).filter("body_text IS NOT NULL").select("id", F.left(F.get(lines, F.lit(0)), F.lit(200)).alias("title"))


@query("ocr_char_stats", f"SELECT id, {count('body_text', '[가-힣]')} AS hangul, length({sub('body_text', T.SPACE, q(''))}) AS n FROM page_contents WHERE body_text IS NOT NULL")
def ocr_char_stats(s, d):
    t = F.col("body_text")
    return pages(s, d).filter("body_text IS NOT NULL").select("id", F.regexp_count(t, F.lit("[가-힣]")).alias("hangul"), F.length(F.regexp_replace(t, T.SPACE, "")).alias("n"))


# ---- predicates on lines ----------------------------------------------------------------------------------------


def page_lines(s, d) -> DataFrame:
    """id, line_no, line, following: the stripped lines of the stored pages."""
    parts = F.transform(F.split(T.newline_norm(F.col("body_text")), "\n"), T.strip)
    held = pages(s, d).filter("body_text IS NOT NULL").select("id", parts.alias("parts"))
    return held.select("id", "parts", F.posexplode("parts").alias("line_no", "line")).select("id", "line_no", "line", F.coalesce(F.get("parts", F.col("line_no") + 1), F.lit("")).alias("following"))


_WORDS = lambda c: f"CASE WHEN {c} = '' THEN 0 ELSE len(regexp_split_to_array({c}, {q(T.SPACE + '+')})) END"
_IS_LIST, _IS_TOC, _IS_CAP = (lambda c, p=p: match(c, p) for p in (T.LIST_ITEM, T.TOC_ENTRY, T.CAPTION))
_HEADING = f"(line <> '' AND NOT {_IS_LIST('line')} AND NOT {_IS_CAP('line')} AND length(line) <= 60 AND {_WORDS('line')} <= 10 AND NOT {match('line', '[.?!,;]' + chr(92) + 'z')} AND length(following) >= greatest(length(line) + 10, 32))"
_KEEP = (
    f"(line = '' OR following = '' OR {_IS_LIST('line')} OR {_IS_LIST('following')} OR {_IS_CAP('line')} OR {_IS_CAP('following')} OR {_HEADING} "
    f"OR (ends_with(line, ':') AND ({_IS_LIST('following')} OR length(following) <= 32)) OR ({_IS_TOC('line')} AND {_IS_TOC('following')}))"
)
_MERGE = (
    f"(CASE WHEN line = '' OR following = '' THEN false WHEN ends_with(line, '-') THEN true WHEN {match('line', R.SENTENCE_END)} AND {match('following', R.UPPER_OR_DIGIT)} THEN false "
    f"WHEN {match('following', R.LOWER)} OR {match('following', R.OPENING)} THEN true WHEN length(line) >= 45 THEN true WHEN {_WORDS('line')} >= 6 AND {_WORDS('following')} >= 3 THEN true ELSE false END)"
)


def _between(sql: str, line: str, following: str) -> str:
    """A condition on a line and the next one, for other names of the two."""
    return re.sub(r"\bfollowing\b", following, re.sub(r"\bline\b", line, sql))


def _reflow_sql(rows: str, key: str) -> str:
    """``key`` and the re-flowed text of ``rows`` (key, text): the lines folded one by one."""
    state = lambda done, now, gaps: f"{{'done': {done}, 'now': {now}, 'gaps': {gaps}, 'line': '', 'gap': false}}"
    skip = f"(b.line = '' OR {match('b.line', T.NOISE_LINE)})"
    apart = f"({_between(_KEEP, 'a.now', 'b.line')} OR NOT {_between(_MERGE, 'a.now', 'b.line')})"
    glued = "CASE WHEN ends_with(a.now, '-') THEN left(a.now, length(a.now) - 1) || b.line ELSE a.now || ' ' || b.line END"
    mark = "CASE WHEN a.gaps >= 2 THEN chr(10) || chr(10) || chr(10) ELSE chr(10) || chr(10) END"
    step = (
        f"CASE WHEN b.gap THEN {state('a.done', 'a.now', 'a.gaps + 1')} WHEN a.gaps > 0 THEN {state('a.done || a.now || ' + mark, f'CASE WHEN {skip} THEN chr(0)[2:] ELSE b.line END', '0')} "
        f"WHEN {skip} THEN a WHEN a.now = '' THEN {state('a.done', 'b.line', '0')} WHEN {apart} THEN {state('a.done || a.now || chr(10)', 'b.line', '0')} ELSE {state('a.done', glued, '0')} END"
    ).replace("chr(0)[2:]", "''")
    items = f"list_transform(string_split(t, chr(10)), lambda r: {{'done': '', 'now': '', 'gaps': 0, 'line': {strip(sub('r', ' {2,}', q(' ')))}, 'gap': r = ''}})"
    return f"SELECT {key}, CASE WHEN t = '' THEN '' ELSE r.done || r.now END AS text FROM (SELECT {key}, t, list_reduce(list_prepend({state(q(''), q(''), '0')}, {items}), lambda a, b: {step}) AS r FROM (SELECT {key}, {strip(newline_norm('text'))} AS t FROM ({rows})))"


_CLEANED = sub(_SPACES.replace("text", newline_norm(sub("text", T.CONTROL, q("")))), rf"({T.LETTER})-\n({T.LETTER})", q(r"\1\2"))


@query("clean_text", f"SELECT doc_id, {strip(sub('text', chr(92) + 'n{4,}', 'chr(10) || chr(10) || chr(10)'))} AS text FROM ({_reflow_sql(f'SELECT doc_id, {_CLEANED} AS text FROM documents WHERE text IS NOT NULL', 'doc_id')})")
def clean_text(s, d):
    return texts(s, d).select("doc_id", R.clean_text(F.col("text")).alias("text"))


@query("reflow", _reflow_sql("SELECT id, body_text AS text FROM page_contents WHERE body_text IS NOT NULL", "id"))
def reflow(s, d):
    return pages(s, d).filter("body_text IS NOT NULL").select("id", R.reflow(F.col("body_text")).alias("text"))


def _predicate(name: str, sql: str, test) -> None:
    @query(name, f"WITH {LINES} SELECT id, line_no FROM page_lines WHERE {sql}")
    def run(s, d):
        return page_lines(s, d).filter(test(F.col("line"), F.col("following"))).select("id", "line_no")


_predicate("is_list_item", _IS_LIST("line"), lambda a, b: R.is_list_item(a))
_predicate("is_toc_entry", _IS_TOC("line"), lambda a, b: R.is_toc_entry(a))
_predicate("is_caption_en", _IS_CAP("line"), lambda a, b: R.is_caption_en(a))
_predicate("find_caption", f"({match('line', T.FIGURE_CAPTION)} OR {match('line', T.TABLE_CAPTION)})", lambda a, b: a.rlike(T.FIGURE_CAPTION) | a.rlike(T.TABLE_CAPTION))
_predicate("is_short_heading", _HEADING, R.is_short_heading)
_predicate("keep_linebreak", _KEEP, R.keep_linebreak)
_predicate("merge_softwrap", _MERGE, R.merge_softwrap)


# ---- gate and routing -------------------------------------------------------------------------------------------

_GATE = f"""WITH c AS (SELECT doc_id, lang, text, {_COUNTS}, length({sub('text', T.SPACE, q(''))}) AS chars FROM documents WHERE text IS NOT NULL)
SELECT {{cols}} FROM (SELECT *, CASE WHEN chars < 50 THEN 'length' WHEN n = 0 OR valid * 2 < n THEN 'quality' END AS reason FROM c)"""


def _gated(s, d) -> DataFrame:
    valid, n = T.quality_counts(F.col("text"))
    counted = texts(s, d).select("doc_id", "lang", "text", valid.alias("valid"), n.alias("n"))
    score = F.when(F.col("n") == 0, 0.0).otherwise(F.col("valid") / F.col("n"))
    return counted.select("doc_id", "lang", "valid", "n", classify.gate(F.col("text"), score).alias("g"))


@query("gate", _GATE.replace("{cols}", "doc_id, CASE WHEN reason IS NULL THEN 'TEXT_READY' ELSE 'REVIEW_REQUIRED' END AS status, reason, chars AS char_count"))
def gate(s, d):
    return _gated(s, d).select("doc_id", "g.status", "g.reason", "g.char_count")


@query("gate_by_lang", _GATE.replace("{cols}", "lang, CASE WHEN reason IS NULL THEN 'TEXT_READY' ELSE 'REVIEW_REQUIRED' END AS status, count(*) AS n_docs, CAST(sum(valid) AS BIGINT) AS valid, CAST(sum(n) AS BIGINT) AS chars") + " GROUP BY 1, 2")
def gate_by_lang(s, d):
    return _gated(s, d).groupBy("lang", "g.status").agg(F.count("*").alias("n_docs"), F.sum("valid").alias("valid"), F.sum("n").alias("chars"))


@query("source_type", "SELECT document_id, CASE WHEN sum(length(coalesce(body_text, ''))) >= 50 * count(*) THEN 'DIGITAL' ELSE 'SCANNED' END AS kind FROM page_contents GROUP BY document_id")
def source_type(s, d):
    chars = F.sum(F.length(F.coalesce("body_text", F.lit(""))))
    return pages(s, d).groupBy("document_id").agg(classify.source_type(chars / F.count("*")).alias("kind"))


_STRATEGY = """CASE WHEN source_type = 'DOCX' THEN 'DOCX_EXTRACT' WHEN source_type = 'PPTX' THEN 'PPTX_EXTRACT' WHEN source_type = 'DIGITAL' AND layout_type = 'MULTI_COLUMN' THEN 'DIGITAL_EXTRACT_MULTI'
WHEN source_type = 'DIGITAL' THEN 'DIGITAL_EXTRACT' WHEN layout_type = 'MULTI_COLUMN' AND has_formula AND NOT kor THEN 'OCR_MULTI_FORMULA' WHEN has_formula AND NOT kor THEN 'OCR_FORMULA'
WHEN layout_type = 'MULTI_COLUMN' THEN 'OCR_MULTI_COL' WHEN jpn THEN 'OCR_JPN' WHEN kor THEN 'OCR_KOR_ENG' ELSE 'OCR_ENG' END"""
_PROFILED = f"(SELECT *, contains(langs, 'kor') AS kor, contains(langs, 'jpn') AS jpn FROM (SELECT *, {_LANGS} AS langs FROM (SELECT *, {_HEAD} AS head FROM documents)))"


def _routed(s, d) -> DataFrame:
    langs = T.detect_langs(F.left(F.coalesce("text", F.lit("")), F.lit(3000)), F.col("file_name"))
    return docs(s, d).withColumn("langs", langs).withColumn("strategy", classify.select_strategy(F.col("source_type"), F.col("layout_type"), F.col("langs"), F.col("has_formula")))


@query("select_strategy", f"SELECT doc_id, {_STRATEGY} AS strategy FROM {_PROFILED}")
def select_strategy(s, d):
    return _routed(s, d).select("doc_id", "strategy")


_PARAMS = "(VALUES " + ", ".join(f"('{n}', {q(lang) if lang else 'NULL'}, {psm or 'NULL'}, {oem or 'NULL'})" for n, lang, psm, oem in classify.STRATEGY_PARAMS) + ") p(strategy, lang, psm, oem)"


@query("strategy_params", f"SELECT d.doc_id, p.lang, CAST(p.psm AS INTEGER) AS psm, CAST(p.oem AS INTEGER) AS oem FROM documents d JOIN {_PARAMS} ON p.strategy = coalesce(d.ocr_strategy, 'OCR_KOR_ENG')")
def strategy_params(s, d):
    return classify.strategy_params(docs(s, d).select("doc_id", "ocr_strategy"), "ocr_strategy").select("doc_id", "lang", "psm", "oem")


@query("tess_config", f"SELECT d.doc_id, concat_ws(' ', '--psm ' || CAST(p.psm AS INTEGER), '--oem ' || CAST(p.oem AS INTEGER)) AS config FROM documents d JOIN {_PARAMS} ON p.strategy = coalesce(d.ocr_strategy, 'OCR_KOR_ENG')")
def tess_config(s, d):
    return strategy_params(s, d).select("doc_id", classify.tess_config(F.col("psm"), F.col("oem")).alias("config"))


@query("profile_str", f"SELECT doc_id, '[' || coalesce(source_type, '?') || '] [' || coalesce(layout_type, '?') || '] 언어:' || langs || ' | ' || CASE WHEN has_formula THEN '수식 있음' ELSE '수식 없음' END || ' | 1페이지' AS profile FROM {_PROFILED}")
def profile_str(s, d):
    part = lambda c: F.coalesce(c, F.lit("?"))
    return _routed(s, d).select("doc_id", classify.profile_str(part("source_type"), part("layout_type"), F.col("langs"), F.col("has_formula"), F.lit(1)).alias("profile"))
