"""Queries of the layout operators, over word boxes laid out from the documents' whole texts, and over stored asset boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.operators import layout as L
from quirefold.operators import pages as P
from quirefold.plans.catalog import assets, docs, pages
from quirefold.plans.sqltext import HEIGHT, LINE, WIDTH, WORDS
from quirefold.session import cut

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def words(s, d, texts: DataFrame | None = None) -> DataFrame:
    """Word boxes of all texts, or of ``texts`` (doc_id, text): eight words a line in two columns, fifty lines a page."""
    parts = F.filter(F.split("text", r"[ \n\t\r]+"), lambda x: x != "")
    # the texts are shuffled by document, not their boxes: whatever is grouped or joined by page then stays in its partition
    texts = (docs(s, d).filter("text IS NOT NULL").select("doc_id", "text") if texts is None else texts).repartition("doc_id")
    w = texts.select("doc_id", F.posexplode(parts).alias("word_no", "text"))
    line, col = F.expr("word_no div 8"), F.col("word_no") % 8
    x0 = 40 + col * 60 + F.when(col >= 4, 70).otherwise(0)
    top = 60 + 14 * (line % 50)
    return w.select("doc_id", F.expr("word_no div 8 div 50").cast("int").alias("page_num"), "word_no", "text", x0.cast("double").alias("x0"), (x0 + F.least(6 * F.length("text"), F.lit(55))).cast("double").alias("x1"), top.cast("double").alias("top"), (top + 10).cast("double").alias("bottom"))


@query("word_boxes", f"WITH {WORDS} SELECT doc_id, page_num, word_no, x0, x1, top, bottom FROM words")
def word_boxes(s, d):
    return words(s, d).drop("text")


@query("line_key", f"WITH {WORDS} SELECT doc_id, page_num, {LINE} AS line, count(*) AS n_words FROM words GROUP BY ALL")
def line_key(s, d):
    return words(s, d).groupBy("doc_id", "page_num", L.line_key(F.col("top")).alias("line")).agg(F.count("*").alias("n_words"))


@query("bin_index", f"WITH {WORDS} SELECT doc_id, word_no, least(greatest(CAST(trunc(x0 / {WIDTH} * 200) AS INTEGER), 0), 199) AS b0, least(greatest(CAST(trunc(x1 / {WIDTH} * 200) AS INTEGER), 0), 199) AS b1 FROM words")
def bin_index(s, d):
    return words(s, d).select("doc_id", "word_no", L.bin_index(F.col("x0"), F.lit(WIDTH)).alias("b0"), L.bin_index(F.col("x1"), F.lit(WIDTH)).alias("b1"))


_JOINED = f"""line_words AS (SELECT *, {LINE} AS line, lag(x1) OVER (PARTITION BY doc_id, page_num, {LINE} ORDER BY x0, word_no) AS edge FROM words),
lines AS (SELECT doc_id, page_num, line, string_agg(CASE WHEN edge IS NULL OR x0 - edge < 1.0 THEN '' ELSE ' ' END || text, '' ORDER BY x0, word_no) AS text, min(top) AS top, max(bottom) AS bottom, count(*) AS n_words FROM line_words GROUP BY ALL)"""


@query("join_line_words", f"WITH {WORDS}, {_JOINED} SELECT doc_id, page_num, line, text FROM lines")
def join_line_words(s, d):
    return L.lines(words(s, d)).select("doc_id", "page_num", "line", "text")


@query("group_lines")
def group_lines(s, d):
    """With every 37th word raised against the line above it, so that the merge has work."""
    w = words(s, d)
    raised = F.col("word_no") % 37 == 36
    return L.group_lines(w.withColumns({"top": F.when(raised, F.col("top") + 4).otherwise(F.col("top")), "x0": F.when(raised & (F.col("word_no") % 8 != 0), F.col("x0") - 4).otherwise(F.col("x0"))}))


@query("spans_both", f"WITH {WORDS} SELECT doc_id, page_num, {LINE} AS line, max(CAST((x0 + x1) / 2 < 310 AS INTEGER)) = 1 AND max(CAST((x0 + x1) / 2 >= 310 AS INTEGER)) = 1 AS both FROM words GROUP BY ALL")
def spans_both(s, d):
    mid = (F.col("x0") + F.col("x1")) / 2
    return words(s, d).groupBy("doc_id", "page_num", L.line_key(F.col("top")).alias("line")).agg((F.max(mid < 310) & F.max(mid >= 310)).alias("both"))


@query("column_split", f"WITH {WORDS} SELECT doc_id, page_num, CASE WHEN (x0 + x1) / 2 < 310 THEN 'left' ELSE 'right' END AS side, count(*) AS n FROM words GROUP BY ALL")
def column_split(s, d):
    return words(s, d).groupBy("doc_id", "page_num", L.column_side(F.col("x0"), F.col("x1"), F.lit(310.0)).alias("side")).agg(F.count("*").alias("n"))


@query("header_footer_split", f"WITH {WORDS} SELECT doc_id, page_num, CASE WHEN top < {HEIGHT} * 0.08::DOUBLE THEN 'header' WHEN top > {HEIGHT} * 0.93::DOUBLE THEN 'footer' ELSE 'main' END AS zone, count(*) AS n FROM words GROUP BY ALL")
def header_footer_split(s, d):
    return words(s, d).groupBy("doc_id", "page_num", L.zone(F.col("top"), F.lit(HEIGHT)).alias("zone")).agg(F.count("*").alias("n"))


_COVER = f"""binned AS (SELECT DISTINCT doc_id, page_num, {LINE} AS line, unnest(range(CAST(trunc(x0 / {WIDTH} * 200) AS INTEGER), least(CAST(trunc(x1 / {WIDTH} * 200) AS INTEGER), 199) + 1)) AS bin FROM words),
totals AS (SELECT doc_id, page_num, count(DISTINCT {LINE}) AS n_lines FROM words GROUP BY ALL),
cover AS (SELECT b.doc_id, b.page_num, CAST(b.bin AS INTEGER) AS bin, count(*) AS n_cover, any_value(t.n_lines) AS n_lines FROM binned b JOIN totals t USING (doc_id, page_num) GROUP BY ALL)"""


@query("line_coverage", f"WITH {WORDS}, {_COVER} SELECT doc_id, page_num, bin, n_cover, n_lines FROM cover")
def line_coverage(s, d):
    return L.line_coverage(words(s, d), WIDTH).select("doc_id", "page_num", "bin", "n_cover", "n_lines")


_GAPS = f"""side AS (SELECT doc_id, page_num, n_lines, sum(n_cover) / (n_lines * 140) AS side_mean FROM cover WHERE bin < 70 OR bin > 129 GROUP BY doc_id, page_num, n_lines),
mid AS (SELECT s.doc_id, s.page_num, s.side_mean, r.b AS bin, coalesce(c.n_cover, 0) / s.n_lines AS share FROM side s, (SELECT unnest(range(70, 130)) AS b) r LEFT JOIN cover c ON c.doc_id = s.doc_id AND c.page_num = s.page_num AND c.bin = r.b WHERE s.side_mean > 0.10::DOUBLE),
runs AS (SELECT doc_id, page_num, min(bin) AS run_start, count(*) AS run_len FROM (SELECT *, bin - row_number() OVER (PARTITION BY doc_id, page_num ORDER BY bin) AS island FROM mid WHERE share < least(0.25::DOUBLE, side_mean * 0.30::DOUBLE)) GROUP BY doc_id, page_num, island),
gaps AS (SELECT doc_id, page_num, CAST(run_start AS INTEGER) AS run_start, run_len, (run_start * 2 + run_len) / 2 / 200 * {WIDTH} AS gap_x FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY run_len DESC, run_start) AS r FROM runs) WHERE r = 1 AND run_len >= 3)"""


@query("longest_gap_run", f"WITH {WORDS}, {_COVER}, {_GAPS} SELECT doc_id, page_num, run_start, run_len FROM gaps")
def longest_gap_run(s, d):
    return L.column_gap(words(s, d), WIDTH).select("doc_id", "page_num", "run_start", "run_len")


@query("column_gap", f"WITH {WORDS}, {_COVER}, {_GAPS} SELECT doc_id, page_num, gap_x FROM gaps")
def column_gap(s, d):
    return L.column_gap(words(s, d), WIDTH).select("doc_id", "page_num", "gap_x")


def _page_sizes(w: DataFrame) -> DataFrame:
    return w.groupBy("doc_id", "page_num").agg(F.count("*").alias("n_words"), F.countDistinct(L.line_key(F.col("top"))).alias("n_lines"))


@query("layout_vote", f"""WITH {WORDS}, {_COVER}, {_GAPS}, sizes AS (SELECT doc_id, page_num, count(*) AS n_words, count(DISTINCT {LINE}) AS n_lines FROM words GROUP BY ALL),
votes AS (SELECT s.doc_id, count(*) AS n_pages, count(g.gap_x) AS n_multi FROM sizes s LEFT JOIN gaps g USING (doc_id, page_num) WHERE s.page_num < 5 AND n_words >= 6 AND n_lines >= 10 GROUP BY s.doc_id)
SELECT doc_id, n_pages, n_multi, CASE WHEN n_multi >= greatest(1, n_pages * 2 // 3) THEN 'MULTI_COLUMN' ELSE 'SINGLE_COLUMN' END AS layout_type FROM votes""")
def layout_vote(s, d):
    w = words(s, d)
    return L.layout_vote(L.column_gap(w, WIDTH), _page_sizes(w))


@query("diag_profile", f"WITH {WORDS}, {_COVER}, {_GAPS} SELECT t.doc_id, t.page_num, t.n_lines, g.run_start, g.run_len FROM totals t LEFT JOIN gaps g USING (doc_id, page_num)")
def diag_profile(s, d):
    w = words(s, d)
    return _page_sizes(w).join(L.column_gap(w, WIDTH), ["doc_id", "page_num"], "left").select("doc_id", "page_num", "n_lines", "run_start", "run_len")


_LINE_GAPS = "line_gaps AS (SELECT * EXCLUDE below, CASE WHEN below IS NOT NULL THEN greatest(below - bottom, 0) END AS gap FROM (SELECT *, lead(top) OVER (PARTITION BY doc_id, page_num ORDER BY line) AS below FROM lines))"
_MEDIANS = "medians AS (SELECT doc_id, page_num, list_sort(list(gap))[len(list(gap)) // 2 + 1] AS g FROM line_gaps WHERE gap > 0 GROUP BY ALL)"


@query("line_gaps", f"WITH {WORDS}, {_JOINED}, {_LINE_GAPS} SELECT doc_id, page_num, line, CAST(gap AS DOUBLE) AS gap FROM line_gaps")
def line_gaps(s, d):
    return L.line_gaps(L.lines(words(s, d))).select("doc_id", "page_num", "line", "gap")


@query("upper_median", f"WITH {WORDS}, {_JOINED}, {_LINE_GAPS}, {_MEDIANS} SELECT doc_id, page_num, CAST(g AS DOUBLE) AS g FROM medians")
def upper_median(s, d):
    gaps = L.line_gaps(L.lines(words(s, d))).filter("gap > 0")
    return gaps.groupBy("doc_id", "page_num").agg(L.upper_median(F.collect_list("gap")).alias("g"))


_ENDS = """ended AS (SELECT l.doc_id, l.page_num, l.line, l.text || CASE WHEN l.gap IS NULL THEN '' WHEN m.g IS NULL THEN chr(10) WHEN l.gap >= greatest(m.g * 2.1::DOUBLE, greatest(m.g * 1.35::DOUBLE, m.g + 1) + 3) THEN repeat(chr(10), 3)
WHEN l.gap >= greatest(m.g * 1.35::DOUBLE, m.g + 1) THEN repeat(chr(10), 2) ELSE chr(10) END AS t FROM line_gaps l LEFT JOIN medians m USING (doc_id, page_num))"""


@query("paragraph_text", f"WITH {WORDS}, {_JOINED}, {_LINE_GAPS}, {_MEDIANS}, {_ENDS} SELECT doc_id, page_num, string_agg(t, '' ORDER BY line) AS text FROM ended GROUP BY ALL")
def paragraph_text(s, d):
    return L.paragraph_text(L.lines(words(s, d)))


_SIDES = f"""sides AS (SELECT w.doc_id, w.page_num, {LINE} AS line, count(*) FILTER (WHERE (x0 + x1) / 2 < gap_x) AS n_left, count(*) FILTER (WHERE (x0 + x1) / 2 >= gap_x) AS n_right FROM words w JOIN gaps g USING (doc_id, page_num) GROUP BY ALL)"""
_STARTS = f"""flagged AS (SELECT *, n_left >= 2 AND n_right >= 2 AS ok FROM sides WHERE line >= {HEIGHT} * 0.1::DOUBLE),
fresh AS (SELECT *, CASE WHEN NOT ok OR coalesce(NOT lag(ok) OVER w, true) OR line - lag(line) OVER w > 30 THEN 1 ELSE 0 END AS begins FROM flagged WINDOW w AS (PARTITION BY doc_id, page_num ORDER BY line)),
islands AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id, page_num ORDER BY line) AS island FROM fresh),
starts AS (SELECT doc_id, page_num, min(y) AS body_y FROM (SELECT doc_id, page_num, island, min(line) AS y, count(*) AS n FROM islands WHERE ok GROUP BY ALL) WHERE n >= 3 GROUP BY ALL)"""


@query("body_start", f"WITH {WORDS}, {_COVER}, {_GAPS}, {_SIDES}, {_STARTS} SELECT doc_id, page_num, body_y FROM starts")
def body_start(s, d):
    w = words(s, d)
    return L.body_start(L.two_sided(w, L.column_gap(w, WIDTH)), HEIGHT)


_LOWERED = "top + CASE WHEN word_no % 400 >= 264 THEN 40 ELSE 0 END"


@query("footnote_start", f"WITH {WORDS}, keyed AS (SELECT doc_id, page_num, {LINE.replace('top', f'({_LOWERED})')} AS line FROM words GROUP BY ALL), jumps AS (SELECT *, line - lag(line) OVER (PARTITION BY doc_id, page_num ORDER BY line) AS jump FROM keyed) SELECT doc_id, page_num, min(line) AS foot_y FROM jumps WHERE line > {HEIGHT} * 0.5 AND jump > 35 GROUP BY ALL")
def footnote_start(s, d):
    """With the lowest lines of each page set down by forty points, so that there is a jump."""
    top = F.when(F.col("word_no") % 400 >= 264, F.col("top") + 40).otherwise(F.col("top"))
    lines = words(s, d).groupBy("doc_id", "page_num", L.line_key(top).alias("line")).agg(F.lit(1).alias("one"))
    return L.footnote_start(lines, HEIGHT)


@query("compose_multicol")
def compose_multicol(s, d):
    w = words(s, d)
    gaps = cut(L.column_gap(w, WIDTH))  # asked for twice
    return P.compose_pages(w, gaps, L.body_start(L.two_sided(w, gaps), HEIGHT), height=HEIGHT)


@query("compose_multicol_captions")
def compose_multicol_captions(s, d):
    w = words(s, d)
    gaps = cut(L.column_gap(w, WIDTH))  # asked for twice
    return P.compose_pages(w, gaps, L.body_start(L.two_sided(w, gaps), HEIGHT), height=HEIGHT, captions=True)


@query("page_text_with_assets")
def page_text_with_assets(s, d):
    w = words(s, d)
    gaps = cut(L.column_gap(w, WIDTH))  # asked for twice
    return P.compose_pages(w, gaps, L.body_start(L.two_sided(w, gaps), HEIGHT), assets(s, d), HEIGHT)


@query("inject_caption_refs")
def inject_caption_refs(s, d):
    return P.inject_caption_refs(pages(s, d).filter("document_id IS NOT NULL"), assets(s, d))


# ---- stored asset boxes -----------------------------------------------------------------------------------------

_BOX = "bbox_x0, bbox_y0, bbox_x1, bbox_y1"


@query("words_not_in_assets", f"WITH {WORDS} SELECT doc_id, page_num, word_no FROM words w WHERE NOT EXISTS (SELECT 1 FROM document_assets a WHERE a.document_id = w.doc_id AND a.page_num = w.page_num AND (x0 + x1) / 2 BETWEEN bbox_x0 - 2 AND bbox_x1 + 2 AND (top + bottom) / 2 BETWEEN bbox_y0 - 2 AND bbox_y1 + 2)")
def words_not_in_assets(s, d):
    return L.words_not_in_assets(words(s, d), assets(s, d).select("document_id", "page_num", *_BOX.split(", "))).select("doc_id", "page_num", "word_no")


@query("word_in_bbox", f"WITH {WORDS} SELECT a.id, count(*) AS n_words FROM words w JOIN document_assets a ON a.document_id = w.doc_id AND a.page_num = w.page_num AND (x0 + x1) / 2 BETWEEN bbox_x0 - 2 AND bbox_x1 + 2 AND (top + bottom) / 2 BETWEEN bbox_y0 - 2 AND bbox_y1 + 2 GROUP BY a.id")
def word_in_bbox(s, d):
    a = assets(s, d).select("id", F.col("document_id").alias("doc_id"), "page_num", *_BOX.split(", "))
    w = words(s, d).select("doc_id", "page_num", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("top") + F.col("bottom")) / 2).alias("y"))
    return w.join(a, ["doc_id", "page_num"]).filter("x BETWEEN bbox_x0 - 2 AND bbox_x1 + 2 AND y BETWEEN bbox_y0 - 2 AND bbox_y1 + 2").groupBy("id").agg(F.count("*").alias("n_words"))


_OVERLAP = "greatest(least(f.bbox_x1, t.bbox_x1) - greatest(f.bbox_x0, t.bbox_x0), 0) * greatest(least(f.bbox_y1, t.bbox_y1) - greatest(f.bbox_y0, t.bbox_y0), 0) / ((f.bbox_x1 - f.bbox_x0) * (f.bbox_y1 - f.bbox_y0))"
_PAIR = "t.document_id = f.document_id AND t.page_num = f.page_num AND t.asset_type = 'TABLE'"


@query("figures_not_in_tables", f"SELECT id FROM document_assets f WHERE asset_type = 'FIGURE' AND NOT EXISTS (SELECT 1 FROM document_assets t WHERE {_PAIR} AND {_OVERLAP} > 0.4::DOUBLE)")
def figures_not_in_tables(s, d):
    a = assets(s, d).select("id", "document_id", "page_num", "asset_type", *_BOX.split(", "))
    return L.figures_not_in_tables(a.filter("asset_type = 'FIGURE'"), a.filter("asset_type = 'TABLE'")).select("id")


@query("overlap", f"SELECT f.id, t.id AS table_id, {_OVERLAP} AS share FROM document_assets f JOIN document_assets t ON {_PAIR} WHERE f.asset_type = 'FIGURE' AND f.bbox_x0 IS NOT NULL AND t.bbox_x0 IS NOT NULL")
def overlap(s, d):
    a = assets(s, d).filter("bbox_x0 IS NOT NULL").select("id", "document_id", "page_num", "asset_type", *_BOX.split(", "))
    f, t = a.filter("asset_type = 'FIGURE'").alias("f"), a.filter("asset_type = 'TABLE'").alias("t")
    box = lambda n: tuple(F.col(f"{n}.bbox_{c}") for c in ("x0", "y0", "x1", "y1"))
    return f.join(t, (F.col("f.document_id") == F.col("t.document_id")) & (F.col("f.page_num") == F.col("t.page_num"))).select(F.col("f.id").alias("id"), F.col("t.id").alias("table_id"), L.overlap(box("f"), box("t")).alias("share"))


@query("detect_assets", f"SELECT id FROM document_assets f WHERE bbox_x1 - bbox_x0 >= 50 AND bbox_y1 - bbox_y0 >= 30 AND (asset_type = 'TABLE' OR NOT EXISTS (SELECT 1 FROM document_assets t WHERE {_PAIR} AND {_OVERLAP} > 0.4::DOUBLE))")
def detect_assets(s, d):
    a = assets(s, d).select("id", "document_id", "page_num", "asset_type", *_BOX.split(", "))
    big = a.filter("bbox_x1 - bbox_x0 >= 50 AND bbox_y1 - bbox_y0 >= 30")
    tables = a.filter("asset_type = 'TABLE'")
    return big.filter("asset_type = 'TABLE'").select("id").unionByName(L.figures_not_in_tables(big.filter("asset_type = 'FIGURE'"), tables).select("id"))


@query("asset_side", "SELECT id, CASE WHEN bbox_x1 <= 315 THEN 'left' WHEN bbox_x0 >= 305 THEN 'right' ELSE 'span' END AS side FROM document_assets WHERE bbox_x0 IS NOT NULL")
def asset_side(s, d):
    return assets(s, d).filter("bbox_x0 IS NOT NULL").select("id", L.asset_side(F.col("bbox_x0"), F.col("bbox_x1"), F.lit(310.0)).alias("side"))


_ZONES = """boxed AS (SELECT * FROM document_assets WHERE bbox_y0 IS NOT NULL AND document_id IS NOT NULL),
above AS (SELECT document_id, page_num, CAST(row_number() OVER w - 1 AS INTEGER) AS zone_no, coalesce(lag(bbox_y1) OVER w, 0) AS y_from, bbox_y0 - 2 AS y_to FROM boxed WINDOW w AS (PARTITION BY document_id, page_num ORDER BY bbox_y0, id)),
zones AS (SELECT * FROM above UNION ALL SELECT document_id, page_num, CAST(count(*) AS INTEGER), arg_max(bbox_y1, (bbox_y0, id)), 1e300 FROM boxed GROUP BY ALL)"""


@query("asset_to_zone", f"WITH {WORDS}, {_ZONES} SELECT w.doc_id, w.page_num, z.zone_no, count(*) AS n_words FROM words w JOIN zones z ON z.document_id = w.doc_id AND z.page_num = w.page_num AND w.top >= z.y_from AND w.top < z.y_to GROUP BY ALL")
def asset_to_zone(s, d):
    z = L.asset_zones(assets(s, d).filter("bbox_y0 IS NOT NULL AND document_id IS NOT NULL").select("id", "document_id", "page_num", "bbox_y0", "bbox_y1")).withColumnRenamed("document_id", "doc_id")
    held = z.groupBy("doc_id", "page_num").agg(F.collect_list(F.struct("zone_no", "y_from", "y_to")).alias("zones"))  # the assets of one page
    w = L.with_value(words(s, d).select("doc_id", "page_num", "top"), held, "zones", "inner")
    return w.select("doc_id", "page_num", "top", F.inline("zones")).filter("top >= y_from AND top < y_to").groupBy("doc_id", "page_num", "zone_no").agg(F.count("*").alias("n_words"))


_CHARS = """chars AS (SELECT id, CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN [bbox_x0 / 600] WHEN 2 THEN [bbox_x0 / 600, bbox_y0 / 800, bbox_x1 / 600] WHEN 3 THEN [bbox_x0 / 600, bbox_y0 / 800, bbox_x1 / 600, bbox_y1 / 800] ELSE [bbox_x0, bbox_y0] END AS fill,
bbox_y1 - bbox_y0 AS size, id % 7 <> 0 AS upright FROM document_assets WHERE bbox_x0 IS NOT NULL),
lum AS (SELECT *, CASE len(fill) WHEN 1 THEN fill[1] WHEN 3 THEN fill[1] * 0.299::DOUBLE + fill[2] * 0.587::DOUBLE + fill[3] * 0.114::DOUBLE
WHEN 4 THEN (1 - fill[1]) * (1 - fill[4]) * 0.299::DOUBLE + (1 - fill[2]) * (1 - fill[4]) * 0.587::DOUBLE + (1 - fill[3]) * (1 - fill[4]) * 0.114::DOUBLE END AS luminance FROM chars)"""


def _chars(s, d) -> DataFrame:
    """Characters with colours of all sizes, made from the stored boxes."""
    a, b, c, e = (F.col(x) / y for x, y in (("bbox_x0", 600), ("bbox_y0", 800), ("bbox_x1", 600), ("bbox_y1", 800)))
    k = F.col("id") % 5
    fill = F.when(k == 1, F.array(a)).when(k == 2, F.array(a, b, c)).when(k == 3, F.array(a, b, c, e)).when(k == 4, F.array("bbox_x0", "bbox_y0"))
    return assets(s, d).filter("bbox_x0 IS NOT NULL").select("id", fill.alias("fill"), (F.col("bbox_y1") - F.col("bbox_y0")).alias("size"), (F.col("id") % 7 != 0).alias("upright"))


@query("luminance", f"WITH {_CHARS} SELECT id, luminance FROM lum")
def luminance(s, d):
    from quirefold.functions.text import luminance as of

    return _chars(s, d).select("id", of(F.col("fill")).alias("luminance"))


@query("watermark_filter", f"WITH {_CHARS} SELECT id FROM lum WHERE upright AND NOT coalesce(luminance > 0.80::DOUBLE, false) AND NOT (size > 30 AND coalesce(luminance > 0.15::DOUBLE, false))")
def watermark_filter(s, d):
    from quirefold.functions.text import luminance as of

    lum = of(F.col("fill"))
    never = F.lit(False)
    kept = F.col("upright") & ~F.coalesce(lum > 0.80, never) & ~((F.col("size") > 30) & F.coalesce(lum > 0.15, never))
    return _chars(s, d).filter(kept).select("id")


@query("body_font_size", "SELECT document_id, arg_max(size, (n, -size)) AS size FROM (SELECT document_id, round((bbox_y1 - bbox_y0) / 10, 0) AS size, count(*) AS n FROM document_assets WHERE bbox_y0 IS NOT NULL GROUP BY ALL) GROUP BY document_id")
def body_font_size(s, d):
    n = assets(s, d).filter("bbox_y0 IS NOT NULL").groupBy("document_id", F.round((F.col("bbox_y1") - F.col("bbox_y0")) / 10, 0).alias("size")).agg(F.count("*").alias("n"))
    return n.groupBy("document_id").agg(F.max_by("size", F.struct("n", -F.col("size"))).alias("size"))


@query("words_one_line", f"WITH {WORDS}, l AS (SELECT doc_id, page_num, round_even(top / 5, 0) * 5 AS line, string_agg(text, ' ' ORDER BY x0, word_no) AS t FROM words GROUP BY ALL) SELECT doc_id, page_num, string_agg(t, ' | ' ORDER BY line) AS text FROM l GROUP BY ALL")
def words_one_line(s, d):
    from quirefold.operators.viewer import words_one_line as joined

    return joined(words(s, d))
