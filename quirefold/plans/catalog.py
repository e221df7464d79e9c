"""Queries over the stored documents, logs, pages, assets and metadata: lookups, joins, reports, state changes."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.operators import metrics, state, timestamps
from quirefold.plans.sqltimes import instants
from quirefold.session import ensure_checkpoint_dir, table
from quirefold.sources import files

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents")


def logs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "process_logs")


def pages(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "page_contents")


def assets(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "document_assets")


def meta(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "document_metadata")


def in_time(s: SparkSession, d: str, df: DataFrame, field: str, *columns: str, last_first: bool = False) -> DataFrame:
    """``columns`` of ``df`` ordered by the instant that ``field`` states in any of its formats (the first column breaks ties); rows without one come last."""
    at = timestamps.with_instants(df, {field: "_at_us"}, table(s, d, "workers"))
    return at.orderBy(F.desc_nulls_last("_at_us") if last_first else F.asc_nulls_last("_at_us"), columns[0]).select(*columns)


# ---- discovery and content hashes -------------------------------------------------------------------------------

EXTENSION = r"\.(pdf|PDF|docx|DOCX|pptx|PPTX)$"


def inbox(s: SparkSession, d: str) -> DataFrame:
    """The texts of all documents as files of a folder, under their numbers and the kinds of their file names, found again by scanning it. (The source lists no empty files.)"""
    folder = f"{ensure_checkpoint_dir(s)}/inbox-{hashlib.md5(d.encode()).hexdigest()[:12]}"
    kind = F.coalesce(F.nullif(F.regexp_extract("file_name", r"\.([A-Za-z]+)$", 1), F.lit("")), F.lit("txt"))
    files.write_files(docs(s, d).filter("text <> ''").select(F.concat_ws(".", F.col("doc_id").cast("string"), kind).alias("name"), F.encode("text", "UTF-8").alias("content")), folder)
    found = files.scan_files(s, folder)
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", "hash")


_NAMES = "(SELECT *, doc_id || '.' || coalesce(nullif(regexp_extract(file_name, '\\.([A-Za-z]+)$', 1), ''), 'txt') AS name FROM documents WHERE text <> '')"


@query("scan_files", f"SELECT name, octet_length(encode(text)) AS length FROM {_NAMES} WHERE regexp_matches(name, '{EXTENSION}')")
def scan_files(s, d):
    return inbox(s, d).select("name", "length").orderBy("name")


@query("file_hash", f"SELECT name, md5(text) AS hash FROM {_NAMES} WHERE regexp_matches(name, '{EXTENSION}')")
def file_hash(s, d):
    """Hashes of the files' bytes."""
    return inbox(s, d).select("name", "hash")


def _scan(s, d):
    files = docs(s, d).select(F.col("file_path").alias("path"), F.when(F.col("text").isNotNull(), F.col("file_hash")).alias("hash"))
    changed = F.when(F.col("status") == "TEXT_READY", F.concat(F.lit("old-"), "file_hash")).otherwise(F.col("file_hash"))
    known = docs(s, d).filter(F.col("status").isNotNull() & (F.col("status") != "NEW")).select(F.col("file_path").alias("path"), changed.alias("hash"))
    return state.scan_classify(files, known)


_SCAN_SQL = """
WITH files AS (SELECT file_path AS path, CASE WHEN text IS NOT NULL THEN file_hash END AS hash FROM documents),
known AS (SELECT file_path AS path, CASE WHEN status = 'TEXT_READY' THEN 'old-' || file_hash ELSE file_hash END AS hash FROM documents WHERE status IS NOT NULL AND status <> 'NEW'),
j AS (SELECT f.path, f.hash, k.hash AS old, EXISTS (SELECT 1 FROM known x WHERE x.hash = f.hash) AS seen FROM files f LEFT JOIN known k ON k.path = f.path),
c AS (SELECT *, CASE WHEN hash IS NULL THEN 'error' WHEN old = hash THEN 'skip' WHEN old IS NOT NULL THEN 'requeue' WHEN seen THEN 'skip'
        WHEN path = min(CASE WHEN old IS NULL AND NOT seen THEN path END) OVER (PARTITION BY hash) THEN 'register' ELSE 'skip' END AS action FROM j)
"""


@query("scan_classify", _SCAN_SQL + "SELECT path, hash, action FROM c")
def scan_classify(s, d):
    return _scan(s, d)


@query("scan_summary", _SCAN_SQL + "SELECT action, count(*) AS n FROM c GROUP BY action")
def scan_summary(s, d):
    return _scan(s, d).groupBy("action").agg(F.count("*").alias("n"))


@query("dup_hash_exists", "SELECT doc_id FROM documents WHERE file_hash IN (SELECT file_hash FROM documents GROUP BY file_hash HAVING count(*) > 1)")
def dup_hash_exists(s, d):
    many = docs(s, d).groupBy("file_hash").agg(F.count("*").alias("n")).filter("n > 1").select("file_hash")
    return docs(s, d).join(many, "file_hash", "left_semi").select("doc_id")


@query("new_paths", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM document_assets a WHERE a.file_path = d.file_path)")
def new_paths(s, d):
    return docs(s, d).join(assets(s, d).select("file_path"), "file_path", "left_anti").select("doc_id")


@query("register", "SELECT file_path, 'NEW' AS status, 0 AS retry_count FROM document_assets WHERE file_path NOT IN (SELECT file_path FROM documents) GROUP BY file_path")
def register(s, d):
    return state.register(assets(s, d).filter(F.col("file_path").isNotNull()).select("file_path").distinct(), docs(s, d)).select("file_path", "status", "retry_count")


@query("glob_union", "SELECT lower(regexp_extract(file_name, '\\.([A-Za-z]+)$', 1)) AS kind, count(*) AS n FROM documents GROUP BY 1")
def glob_union(s, d):
    d0 = docs(s, d).select(F.lower(F.regexp_extract("file_name", r"\.([A-Za-z]+)$", 1)).alias("kind"))
    return d0.groupBy("kind").agg(F.count("*").alias("n"))


# ---- lookups, filters, projections ------------------------------------------------------------------------------


@query("doc_by_id", "SELECT doc_id, file_path, status FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)")
def doc_by_id(s, d):
    return docs(s, d).orderBy("doc_id").select("doc_id", "file_path", "status").limit(1)  # a point lookup


@query("doc_by_path", "SELECT doc_id, file_path FROM documents WHERE file_path = (SELECT max(file_path) FROM documents)")
def doc_by_path(s, d):
    last = docs(s, d).agg(F.max("file_path").alias("file_path"))
    return docs(s, d).join(F.broadcast(last), "file_path", "left_semi").select("doc_id", "file_path")  # one row


@query("doc_by_hash", "SELECT file_hash, min(doc_id) AS doc_id FROM documents WHERE file_hash IS NOT NULL GROUP BY file_hash")
def doc_by_hash(s, d):
    return docs(s, d).filter("file_hash IS NOT NULL").groupBy("file_hash").agg(F.min("doc_id").alias("doc_id"))


@query("docs_by_status", "SELECT doc_id, status, created_at FROM documents WHERE status = 'FAILED'")
def docs_by_status(s, d):
    return in_time(s, d, docs(s, d).filter(F.col("status") == "FAILED"), "created_at", "doc_id", "status", "created_at")


@query("all_docs", "SELECT doc_id, file_name, created_at FROM documents")
def all_docs(s, d):
    return in_time(s, d, docs(s, d), "created_at", "doc_id", "file_name", "created_at", last_first=True)


@query("not_indexed", "SELECT doc_id, status, updated_at FROM documents WHERE status NOT IN ('INDEXED')")
def not_indexed(s, d):
    return in_time(s, d, docs(s, d).filter(~F.col("status").isin("INDEXED")), "updated_at", "doc_id", "status", "updated_at", last_first=True)


@query("name_search", "SELECT doc_id, file_name FROM documents WHERE contains(lower(file_name), 'the_') AND status IN ('INDEXED', 'FAILED')")
def name_search(s, d):
    return docs(s, d).filter(F.lower("file_name").contains("the_") & F.col("status").isin("INDEXED", "FAILED")).select("doc_id", "file_name")


@query("like_filter", "SELECT DISTINCT document_id FROM process_logs WHERE message LIKE '%timeout%' AND document_id IN (SELECT doc_id FROM documents WHERE file_name LIKE '%_the_%')")
def like_filter(s, d):
    named = docs(s, d).filter(F.col("file_name").like("%_the_%")).select(F.col("doc_id").alias("document_id"))
    return logs(s, d).filter(F.col("message").like("%timeout%")).select("document_id").distinct().join(named, "document_id", "left_semi")


@query("logs_for_doc", "SELECT id, document_id, step, result FROM process_logs WHERE document_id = (SELECT max(doc_id) FROM documents)")
def logs_for_doc(s, d):
    last = docs(s, d).agg(F.max("doc_id").alias("document_id"))
    return in_time(s, d, logs(s, d).join(F.broadcast(last), "document_id", "left_semi"), "logged_at", "id", "document_id", "step", "result")  # one row


@query("assets_for_doc", "SELECT document_id, id, page_num, asset_type, seq_in_doc, ref_tag FROM document_assets ORDER BY document_id, page_num, seq_in_doc, id")
def assets_for_doc(s, d):
    return assets(s, d).select("document_id", "id", "page_num", "asset_type", "seq_in_doc", "ref_tag").orderBy("document_id", "page_num", "seq_in_doc", "id")


@query("page_assets", "SELECT document_id, page_num, id, md5(image_data) AS image_md5 FROM document_assets WHERE page_num = 0")
def page_assets(s, d):
    return assets(s, d).filter("page_num = 0").select("document_id", "page_num", "id", F.md5("image_data").alias("image_md5"))


@query("asset_image", "SELECT id, octet_length(image_data) AS n_bytes FROM document_assets")
def asset_image(s, d):
    return assets(s, d).select("id", F.octet_length("image_data").cast("long").alias("n_bytes"))


@query("page_content", "SELECT id, document_id, page_num, coalesce(header_text, '') AS header_text, coalesce(footer_text, '') AS footer_text, coalesce(body_text, '') AS body_text FROM page_contents WHERE page_num = 0")
def page_content(s, d):
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("header_text", "footer_text", "body_text")]
    return pages(s, d).filter("page_num = 0").select("id", "document_id", "page_num", *text)


@query("metadata_get", "SELECT id, document_id, title FROM document_metadata WHERE title IS NOT NULL")
def metadata_get(s, d):
    return meta(s, d).filter("title IS NOT NULL").select("id", "document_id", "title")


@query("json_list", "SELECT id, CASE WHEN json_valid(authors) AND json_type(authors) = 'ARRAY' THEN json_array_length(authors) ELSE 0 END AS n_authors FROM document_metadata")
def json_list(s, d):
    from quirefold.functions.text import json_list as parse

    return meta(s, d).select("id", F.size(parse(F.when(F.col("authors").rlike(r"^\s*\["), F.col("authors")))).cast("long").alias("n_authors"))


@query("metadata_all", "SELECT document_id, count(*) AS n, max(title) AS title FROM document_metadata GROUP BY document_id")
def metadata_all(s, d):
    return meta(s, d).groupBy("document_id").agg(F.count("*").alias("n"), F.max("title").alias("title"))


@query("review_list", "SELECT doc_id, file_name, error_message FROM documents WHERE status = 'REVIEW_REQUIRED'")
def review_list(s, d):
    return docs(s, d).filter(F.col("status") == "REVIEW_REQUIRED").select("doc_id", "file_name", "error_message")


@query("failed_list", "SELECT doc_id, file_name, failed_step, retry_count, left(error_message, 80) AS error_message FROM documents WHERE status = 'FAILED'")
def failed_list(s, d):
    return docs(s, d).filter(F.col("status") == "FAILED").select("doc_id", "file_name", "failed_step", "retry_count", F.left("error_message", F.lit(80)).alias("error_message"))


@query("layout_label", "SELECT doc_id, CASE WHEN layout_type IS NULL THEN '—' WHEN contains(layout_type, 'MULTI') THEN 'multi' ELSE 'single' END AS label FROM documents")
def layout_label(s, d):
    return docs(s, d).select("doc_id", F.when(F.col("layout_type").isNull(), "—").when(F.col("layout_type").contains("MULTI"), "multi").otherwise("single").alias("label"))


@query("asset_size_filter", "SELECT id FROM document_assets WHERE bbox_x1 - bbox_x0 >= 50 AND bbox_y1 - bbox_y0 >= 30")
def asset_size_filter(s, d):
    return assets(s, d).filter("bbox_x1 - bbox_x0 >= 50 AND bbox_y1 - bbox_y0 >= 30").select("id")


@query("read_through_page", "SELECT p.id, coalesce(nullif(p.body_text, ''), d.text) AS text FROM page_contents p LEFT JOIN documents d ON d.doc_id = p.document_id")
def read_through_page(s, d):
    extracted = docs(s, d).select(F.col("doc_id").alias("document_id"), "text")
    return pages(s, d).select("id", "document_id", "body_text").join(extracted, "document_id", "left").select("id", F.coalesce(F.nullif("body_text", F.lit("")), "text").alias("text"))


@query("viewer_page_count", "SELECT document_id, max(page_num) + 1 AS n_pages FROM page_contents GROUP BY document_id")
def viewer_page_count(s, d):
    return pages(s, d).groupBy("document_id").agg((F.max("page_num") + 1).alias("n_pages"))


@query("distinct_statuses", "SELECT DISTINCT status FROM documents WHERE status IS NOT NULL ORDER BY status")
def distinct_statuses(s, d):
    return docs(s, d).filter("status IS NOT NULL").select("status").distinct().orderBy("status")


@query("truncate", "SELECT id, left(message, 50) AS message FROM process_logs WHERE message IS NOT NULL")
def truncate(s, d):
    return logs(s, d).filter("message IS NOT NULL").select("id", F.left("message", F.lit(50)).alias("message"))


@query("sort_logs", "SELECT DISTINCT document_id, logged_at, id FROM process_logs")
def sort_logs(s, d):
    at = timestamps.with_instants(logs(s, d).select("document_id", "logged_at", "id", "worker"), {"logged_at": "_at_us"}, table(s, d, "workers"))
    return at.drop("worker").distinct().orderBy("document_id", F.asc_nulls_last("_at_us"), "id").drop("_at_us")


@query("sample_prefix", "SELECT doc_id, left(text, 3000) AS head FROM documents WHERE text IS NOT NULL")
def sample_prefix(s, d):
    """The first 3000 characters, which the language rule reads (a feature of the surveyed classifier)."""
    return docs(s, d).filter("text IS NOT NULL").select("doc_id", F.left("text", F.lit(3000)).alias("head"))


# ---- joins ------------------------------------------------------------------------------------------------------


@query("asset_counts_named", "SELECT a.document_id, coalesce(d.file_name, 'doc_' || a.document_id) AS name, a.n FROM (SELECT document_id, count(*) AS n FROM document_assets GROUP BY document_id) a LEFT JOIN documents d ON d.doc_id = a.document_id")
def asset_counts_named(s, d):
    n = assets(s, d).groupBy("document_id").agg(F.count("*").alias("n"))
    named = docs(s, d).select(F.col("doc_id").alias("document_id"), "file_name")
    return n.join(named, "document_id", "left").select("document_id", F.coalesce("file_name", F.concat(F.lit("doc_"), F.col("document_id"))).alias("name"), "n")


@query("logs_by_doc", "SELECT d.doc_id, count(DISTINCT l.id) AS n_logs, min(l.id) AS first_id, max(l.id) AS last_id FROM documents d LEFT JOIN process_logs l ON l.document_id = d.doc_id GROUP BY d.doc_id")
def logs_by_doc(s, d):
    """Logs per document; counts and ends instead of a list, so that a document with a third of all logs is no large row."""
    n = logs(s, d).filter("document_id IS NOT NULL").select("document_id", "id").distinct().groupBy(F.col("document_id").alias("doc_id")).agg(F.count("*").alias("n_logs"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return docs(s, d).select("doc_id").join(n, "doc_id", "left").withColumn("n_logs", F.coalesce("n_logs", F.lit(0)))


@query("embed_verify", "SELECT doc_id, list_contains(['INDEXED', 'EMBEDDING_DONE'], status) AS verified FROM documents WHERE external_doc_id IS NOT NULL")
def embed_verify(s, d):
    return docs(s, d).filter("external_doc_id IS NOT NULL").select("doc_id", F.array_contains(F.array(F.lit("INDEXED"), F.lit("EMBEDDING_DONE")), F.col("status")).alias("verified"))


# ---- reports ----------------------------------------------------------------------------------------------------


@query("status_counts", "SELECT status, count(*) AS n, (SELECT count(*) FROM documents) AS of FROM documents GROUP BY status")
def status_counts(s, d):
    total = docs(s, d).agg(F.count("*").alias("of"))
    return docs(s, d).groupBy("status").agg(F.count("*").alias("n")).join(F.broadcast(total)).orderBy(F.desc("n"), "status")  # one row


@query("status_counts_fixed", "SELECT coalesce(status, 'TOTAL') AS status, count(*) AS n FROM documents WHERE status IS NOT NULL GROUP BY ROLLUP (status)")
def status_counts_fixed(s, d):
    return docs(s, d).filter("status IS NOT NULL").rollup("status").agg(F.count("*").alias("n")).select(F.coalesce("status", F.lit("TOTAL")).alias("status"), "n")


def _counts(name: str, column: str) -> None:
    @query(name, f"SELECT {column}, count(*) AS n FROM documents WHERE {column} IS NOT NULL AND {column} <> '' GROUP BY {column}")
    def run(s, d):
        return metrics.counts(docs(s, d), column)


for _name, _column in (("source_counts", "source_type"), ("layout_counts", "layout_type"), ("strategy_counts", "ocr_strategy"), ("failed_steps", "failed_step")):
    _counts(_name, _column)


@query("formula_count", "SELECT count(*) FILTER (WHERE has_formula) AS n_formula FROM documents")
def formula_count(s, d):
    return docs(s, d).agg(F.count_if("has_formula").alias("n_formula"))


@query("analyzed_count", "SELECT count(*) FILTER (WHERE source_type IS NOT NULL) AS n_analyzed FROM documents")
def analyzed_count(s, d):
    return docs(s, d).agg(F.count_if(F.col("source_type").isNotNull()).alias("n_analyzed"))


@query("asset_count_doc", "SELECT document_id, asset_type, count(*) AS n FROM document_assets GROUP BY ALL")
def asset_count_doc(s, d):
    return assets(s, d).groupBy("document_id", "asset_type").agg(F.count("*").alias("n"))


@query("asset_count_all", "SELECT document_id, count(*) FILTER (WHERE asset_type = 'TABLE') AS tables, count(*) FILTER (WHERE asset_type = 'FIGURE') AS figures FROM document_assets GROUP BY document_id")
def asset_count_all(s, d):
    kind = F.col("asset_type")
    return assets(s, d).groupBy("document_id").agg(F.count_if(kind == "TABLE").alias("tables"), F.count_if(kind == "FIGURE").alias("figures"))


_QUALITY_SQL = """SELECT count(ocr_quality_score) AS n, coalesce(CAST(sum(e) AS BIGINT), 0) AS sum_e4, coalesce(min(e), 0) AS min_e4, coalesce(max(e), 0) AS max_e4, count(*) FILTER (WHERE e >= 9900) AS n_99
FROM (SELECT ocr_quality_score, ocr_strategy, CAST(round(ocr_quality_score * 10000) AS BIGINT) AS e FROM documents) t"""


@query("quality_stats", _QUALITY_SQL)
def quality_stats(s, d):
    return metrics.quality_stats(docs(s, d))


@query("multi_quality", _QUALITY_SQL + " WHERE ocr_strategy = 'DIGITAL_EXTRACT_MULTI'")
def multi_quality(s, d):
    return metrics.quality_stats(docs(s, d).filter(F.col("ocr_strategy") == "DIGITAL_EXTRACT_MULTI"))


@query("quality_bins", " UNION ALL ".join(f"SELECT '{n}' AS bin, count(*) AS n FROM documents WHERE ocr_quality_score >= {a} AND ocr_quality_score < {b}" for n, a, b in metrics.BINS))
def quality_bins(s, d):
    return metrics.quality_bins(docs(s, d))


def _in(*values: str) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_RATES_SQL = f"""SELECT *, greatest(text_success - review, 1) AS upload_of FROM (SELECT count(*) AS total, count(*) FILTER (WHERE status IN {_in(*metrics.TEXT_SUCCESS)}) AS text_success,
count(*) FILTER (WHERE status IN {_in(*metrics.UPLOADED)}) AS uploaded, count(*) FILTER (WHERE status = 'INDEXED') AS indexed, count(*) FILTER (WHERE status = 'FAILED') AS failed, count(*) FILTER (WHERE status = 'REVIEW_REQUIRED') AS review FROM documents)"""


@query("success_rates", _RATES_SQL)
def success_rates(s, d):
    return metrics.success_rates(docs(s, d))


def _times(s, d) -> DataFrame:
    counted = logs(s, d).filter(F.col("step").isin("ANALYZE", "INDEXING") & (F.col("result") == "SUCCESS"))  # only these times are parsed
    at = timestamps.with_instants(counted.select("document_id", "step", "result", "logged_at", "worker"), {"logged_at": "at_us"}, table(s, d, "workers"))
    return metrics.elapsed(at)


_ELAPSED = f"""WITH {instants("SELECT document_id, step, logged_at AS text, worker FROM process_logs WHERE result = 'SUCCESS' AND step IN ('ANALYZE', 'INDEXING') AND document_id IS NOT NULL")},
ends AS (SELECT document_id, max(utc_us) FILTER (WHERE step = 'ANALYZE') AS a, max(utc_us) FILTER (WHERE step = 'INDEXING') AS b FROM moments GROUP BY document_id),
times AS (SELECT document_id, greatest(0, b - a) AS elapsed_us FROM ends WHERE a IS NOT NULL AND b IS NOT NULL),
stats AS (SELECT count(*) AS n, coalesce(CAST(sum(elapsed_us) AS BIGINT), 0) AS sum_us, coalesce(max(elapsed_us), 0) AS max_us, count(*) FILTER (WHERE elapsed_us <= 180000000) AS n_180, count(*) FILTER (WHERE elapsed_us <= 300000000) AS n_300 FROM times WHERE elapsed_us > 0)"""


@query("elapsed", f"{_ELAPSED} SELECT document_id, elapsed_us FROM times")
def elapsed(s, d):
    return _times(s, d)


@query("elapsed_stats", f"{_ELAPSED} SELECT * FROM stats")
def elapsed_stats(s, d):
    return metrics.elapsed_stats(_times(s, d))


_CRITERIA = {
    "text rate >= 90 %": "text_success * 10 >= total * 9", "upload rate >= 95 %": "uploaded * 100 >= upload_of * 95", "indexed >= 85 %": "indexed * 100 >= total * 85", "failed <= 5 %": "failed * 100 <= total * 5",
    "mean time <= 300 s": "t.sum_us <= t.n * 300000000", "mean quality >= 0.95": "q.sum_e4 >= q.n * 9500", "least multi-column quality >= 0.95": "m.min_e4 >= 9500",
    "mean multi-column quality >= 0.95": "m.sum_e4 >= m.n * 9500", "all within 300 s": "t.n_300 = t.n",
}


@query("criteria", f"{_ELAPSED} SELECT unnest([{', '.join(repr(k) for k in _CRITERIA)}]) AS criterion, unnest([{', '.join(_CRITERIA.values())}]) AS passed FROM ({_RATES_SQL}) r, ({_QUALITY_SQL}) q, ({_QUALITY_SQL} WHERE ocr_strategy = 'DIGITAL_EXTRACT_MULTI') m, stats t")
def criteria(s, d):
    return metrics.criteria(success_rates(s, d), quality_stats(s, d), multi_quality(s, d), elapsed_stats(s, d))


@query("latest_log", "SELECT document_id, max(id) AS id, arg_max(step, id) AS step, arg_max(result, id) AS result FROM process_logs WHERE document_id IS NOT NULL GROUP BY document_id")
def latest_log(s, d):
    return logs(s, d).filter("document_id IS NOT NULL").groupBy("document_id").agg(F.max("id").alias("id"), F.max_by("step", "id").alias("step"), F.max_by("result", "id").alias("result"))


@query("classify_totals", "SELECT source_type, layout_type, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ALL")
def classify_totals(s, d):
    return docs(s, d).groupBy("source_type", "layout_type").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("pipeline_stats", "SELECT count(*) AS scanned, count(*) FILTER (WHERE status <> 'NEW') AS processed, count(*) FILTER (WHERE status = 'INDEXED') AS indexed, count(*) FILTER (WHERE status = 'REVIEW_REQUIRED') AS review, count(*) FILTER (WHERE status = 'FAILED') AS failed FROM documents")
def pipeline_stats(s, d):
    x = F.col("status")
    return docs(s, d).agg(F.count("*").alias("scanned"), F.count_if(x != "NEW").alias("processed"), F.count_if(x == "INDEXED").alias("indexed"), F.count_if(x == "REVIEW_REQUIRED").alias("review"), F.count_if(x == "FAILED").alias("failed"))


@query("avg_chars_per_page", "SELECT document_id, CAST(sum(length(coalesce(body_text, ''))) AS BIGINT) AS chars, count(*) AS pages FROM page_contents GROUP BY document_id")
def avg_chars_per_page(s, d):
    return pages(s, d).groupBy("document_id").agg(F.sum(F.length(F.coalesce("body_text", F.lit("")))).alias("chars"), F.count("*").alias("pages"))


@query("page_join", "SELECT document_id, string_agg(coalesce(body_text, ''), chr(10) || chr(10) ORDER BY page_num, id) AS text FROM page_contents WHERE document_id IS NOT NULL GROUP BY document_id")
def page_join(s, d):
    parts = F.array_sort(F.collect_list(F.struct("page_num", "id", F.coalesce("body_text", F.lit("")).alias("t"))))  # the pages of one document
    return pages(s, d).filter("document_id IS NOT NULL").groupBy("document_id").agg(parts.alias("p")).select("document_id", F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("text"))


@query("most_common_1", "SELECT source, arg_max(status, (n, status)) AS status FROM (SELECT source, status, count(*) AS n FROM documents WHERE status IS NOT NULL GROUP BY ALL) GROUP BY source")
def most_common_1(s, d):
    n = docs(s, d).filter("status IS NOT NULL").groupBy("source", "status").agg(F.count("*").alias("n"))
    return n.groupBy("source").agg(F.max_by("status", F.struct("n", "status")).alias("status"))


@query("doc_sequence", "SELECT id, CAST(row_number() OVER (PARTITION BY document_id, asset_type ORDER BY page_num, bbox_y0 NULLS LAST, id) - 1 AS INTEGER) AS seq FROM document_assets")
def doc_sequence(s, d):
    from pyspark.sql import Window as W

    w = W.partitionBy("document_id", "asset_type").orderBy("page_num", F.asc_nulls_last("bbox_y0"), "id")  # the assets of one document
    return assets(s, d).select("id", (F.row_number().over(w) - 1).alias("seq"))


@query("asset_tags", "SELECT id, '[' || asset_type || '_' || printf('%03d', seq_in_doc) || ']' AS tag FROM document_assets")
def asset_tags(s, d):
    return assets(s, d).select("id", F.format_string("[%s_%03d]", "asset_type", "seq_in_doc").alias("tag"))


# ---- state ------------------------------------------------------------------------------------------------------


@query("sink_page_contents", "SELECT document_id, page_num, id FROM (SELECT *, row_number() OVER (PARTITION BY document_id, page_num ORDER BY created_at DESC NULLS LAST, id DESC NULLS LAST) AS r FROM page_contents) WHERE r = 1")
def sink_page_contents(s, d):
    return state.latest_rows(pages(s, d).select("document_id", "page_num", "id", "created_at"), ["document_id", "page_num"], ["created_at", "id"]).select("document_id", "page_num", "id")


@query("sink_metadata", "SELECT document_id, id FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY created_at DESC NULLS LAST, id DESC NULLS LAST) AS r FROM document_metadata) WHERE r = 1")
def sink_metadata(s, d):
    return state.latest_rows(meta(s, d).select("document_id", "id", "created_at"), ["document_id"], ["created_at", "id"]).select("document_id", "id")


@query("sink_asset", "SELECT document_id, ref_tag, max(id) AS id FROM document_assets GROUP BY ALL")
def sink_asset(s, d):
    return assets(s, d).groupBy("document_id", "ref_tag").agg(F.max("id").alias("id"))


@query("sink_log", "SELECT count(DISTINCT id) AS n FROM process_logs")
def sink_log(s, d):
    return logs(s, d).select("id").distinct().agg(F.count("*").alias("n"))


@query("update_status", """WITH e AS (SELECT DISTINCT id, document_id, step, result, message FROM process_logs WHERE document_id IS NOT NULL),
f AS (SELECT document_id, arg_max(result, id) AS result, arg_max(step, id) AS last_step, arg_max(message, id) FILTER (WHERE result = 'FAILURE') AS error_message, count(*) FILTER (WHERE result = 'FAILURE') AS failures, count(*) AS n_events FROM e GROUP BY document_id)
SELECT document_id, CASE WHEN result = 'FAILURE' THEN 'FAILED' WHEN last_step = 'INDEXING' AND result = 'SUCCESS' THEN 'INDEXED' WHEN last_step = 'SCAN' THEN 'NEW' ELSE 'ANALYZING' END AS status, last_step, error_message, failures, n_events FROM f""")
def update_status(s, d):
    return state.fold_events(logs(s, d).select("id", "document_id", "step", "result", "message"))


@query("increment_retry", "SELECT doc_id, coalesce(retry_count, 0) + (status = 'FAILED')::INTEGER AS retry_count FROM documents WHERE status IS NOT NULL")
def increment_retry(s, d):
    return docs(s, d).filter("status IS NOT NULL").select("doc_id", (F.coalesce("retry_count", F.lit(0)) + (F.col("status") == "FAILED").cast("int")).alias("retry_count"))


@query("reset_for_retry", "SELECT doc_id, CASE WHEN status IN ('FAILED', 'REVIEW_REQUIRED') THEN 'NEW' ELSE status END AS status, CASE WHEN NOT coalesce(status IN ('FAILED', 'REVIEW_REQUIRED'), false) THEN error_message END AS error_message FROM documents")
def reset_for_retry(s, d):
    return state.reset_for_retry(docs(s, d).select("doc_id", "status", "error_message", "failed_step")).select("doc_id", "status", "error_message")


@query("force_reset", "SELECT doc_id, 'ANALYZING' AS status, 0 AS retry_count FROM documents")
def force_reset(s, d):
    return state.force_reset(docs(s, d).select("doc_id", "status", "error_message", "failed_step", "retry_count", "external_doc_id", "ocr_quality_score")).select("doc_id", "status", "retry_count")


@query("claim", "SELECT doc_id, CASE WHEN status = 'NEW' THEN 'ANALYZING' ELSE status END AS status FROM documents")
def claim(s, d):
    return state.reset_status(docs(s, d).select("doc_id", "status"), "NEW", "ANALYZING")


@query("reset_all", "SELECT doc_id, CASE WHEN status NOT IN ('NEW', 'ANALYZING') THEN 'NEW' ELSE status END AS status, CASE WHEN NOT coalesce(status NOT IN ('NEW', 'ANALYZING'), false) THEN detected_languages END AS detected_languages FROM documents")
def reset_all(s, d):
    return state.reset_all(docs(s, d).select("doc_id", "status", "detected_languages", "retry_count", "source_type")).select("doc_id", "status", "detected_languages")


@query("reset_failed", "SELECT doc_id, CASE WHEN status = 'FAILED' THEN 'NEW' ELSE status END AS status, error_message FROM documents")
def reset_failed(s, d):
    return state.reset_status(docs(s, d).select("doc_id", "status", "error_message"), "FAILED")


@query("reset_stuck", "SELECT doc_id, CASE WHEN status = 'ANALYZING' THEN 'NEW' ELSE status END AS status FROM documents")
def reset_stuck(s, d):
    return state.reset_status(docs(s, d).select("doc_id", "status"), "ANALYZING")


@query("mark_indexed", "SELECT document_id, CAST(seq AS INTEGER) AS seq, status FROM (SELECT doc_id AS document_id, unnest(range(4)) AS seq, unnest(['PARSING_DONE', 'CHUNKING_DONE', 'EMBEDDING_DONE', 'INDEXED']) AS status FROM documents WHERE status = 'INDEXED')")
def mark_indexed(s, d):
    return state.mark_indexed(docs(s, d).filter(F.col("status") == "INDEXED"))


@query("delete_all", "SELECT id FROM page_contents WHERE document_id NOT IN (SELECT doc_id FROM documents WHERE status = 'FAILED')")
def delete_all(s, d):
    """Pages left after those of failed documents were deleted before a new run."""
    gone = docs(s, d).filter(F.col("status") == "FAILED").select(F.col("doc_id").alias("document_id"))
    return pages(s, d).select("id", "document_id").filter("document_id IS NOT NULL").join(gone, "document_id", "left_anti").select("id")


@query("outcome", "SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN status = 'FAILED' THEN 'failed' WHEN status = 'REVIEW_REQUIRED' THEN 'review' WHEN status = 'INDEXED' THEN 'indexed' ELSE 'open' END AS outcome FROM documents) GROUP BY outcome")
def outcome(s, d):
    x = F.col("status")
    return docs(s, d).select(F.when(x == "FAILED", "failed").when(x == "REVIEW_REQUIRED", "review").when(x == "INDEXED", "indexed").otherwise("open").alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n"))


@query("doc_detail", "SELECT d.doc_id, d.status, count(DISTINCT p.id) AS n_pages, count(DISTINCT a.id) AS n_assets FROM documents d LEFT JOIN page_contents p ON p.document_id = d.doc_id LEFT JOIN document_assets a ON a.document_id = d.doc_id GROUP BY ALL")
def doc_detail(s, d):
    p = pages(s, d).groupBy(F.col("document_id").alias("doc_id")).agg(F.count("*").alias("n_pages"))
    a = assets(s, d).groupBy(F.col("document_id").alias("doc_id")).agg(F.count("*").alias("n_assets"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return docs(s, d).select("doc_id", "status").join(p, "doc_id", "left").join(a, "doc_id", "left").select("doc_id", "status", zero("n_pages"), zero("n_assets"))
