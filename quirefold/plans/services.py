"""Queries of the stores' edges: calls to a service (a client that answers by fixed rules), retries, written reports, settings.

A cluster gives its own client; here the client is a rule, so that the SQL can say what must come out.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.operators import schema, viewer
from quirefold.plans import catalog
from quirefold.plans.catalog import docs, pages
from quirefold.plans.sqltext import strip
from quirefold.session import ensure_checkpoint_dir
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


def no_wait(seconds: float) -> None:
    """The waits between attempts are for real services."""


def make_uploader() -> Callable[[str, str], tuple[int, dict]]:
    """A client that refuses every seventh document, answers every eleventh without a document and fails twice on every fifth."""
    failures: dict[str, int] = {}

    def upload(doc_id: str, text: str) -> tuple[int, dict]:
        n = int(doc_id)
        if n % 7 == 0:
            return 403, {}
        if n % 11 == 0:
            return 200, {"success": False, "error": "empty"}
        if n % 5 == 0 and failures.get(doc_id, 0) < 2:
            failures[doc_id] = failures.get(doc_id, 0) + 1
            return 500, {}
        return 200, {"success": True, "documents": [{"id": doc_id, "location": f"custom-documents/doc-{doc_id}.json", "title": doc_id, "wordCount": len(text.split())}]}

    return upload


def _texts(s, d) -> DataFrame:
    return docs(s, d).filter("text IS NOT NULL").select("doc_id", "text")


def _uploaded(s, d) -> DataFrame:
    return files.upload_all(_texts(s, d), make_uploader, no_wait)


_UPLOADED = """SELECT doc_id, CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN NULL ELSE 'custom-documents/doc-' || doc_id || '.json' END AS location,
CASE WHEN doc_id % 7 = 0 THEN 'UPLOAD: gave up after 3 attempts: UPLOAD: forbidden' WHEN doc_id % 11 = 0 THEN 'UPLOAD: gave up after 3 attempts: UPLOAD: empty' END AS error FROM documents WHERE text IS NOT NULL"""


@query("http_upload", _UPLOADED)
def http_upload(s, d):
    return _uploaded(s, d)


@query("step_upload", f"SELECT doc_id, CASE WHEN error IS NULL THEN 'UPLOADED' ELSE 'FAILED' END AS status, CASE WHEN error IS NOT NULL THEN 'UPLOAD' END AS failed_step, location AS external_doc_id FROM ({_UPLOADED})")
def step_upload(s, d):
    """The state that uploading leaves: the location as the outer id, or the failed step."""
    failed = F.col("error").isNotNull()
    return _uploaded(s, d).select("doc_id", F.when(failed, "FAILED").otherwise("UPLOADED").alias("status"), F.when(failed, "UPLOAD").alias("failed_step"), F.col("location").alias("external_doc_id"))


@query("retry_exhausted", f"SELECT doc_id, error FROM ({_UPLOADED}) WHERE error IS NOT NULL")
def retry_exhausted(s, d):
    return _uploaded(s, d).filter("error IS NOT NULL").select("doc_id", "error")


def _embedded(uploaded: DataFrame) -> DataFrame:
    """(doc_id, status, error) of embedding uploaded documents: every third location is not in the workspace that the service answers with."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, location in zip(b.doc_id, b.location):
                held = [] if doc_id % 3 == 0 else [{"docpath": location}]
                answer = {"workspace": [{"documents": held}] if doc_id % 2 else {"documents": held}}
                try:
                    files.retry(lambda: files.check_embed(200, answer, location), "EMBED", no_wait)  # noqa: B023
                    rows.append((doc_id, "INDEXED", None))
                except files.ServiceError as e:
                    rows.append((doc_id, "FAILED", str(e)))
            yield pd.DataFrame(rows, columns=["doc_id", "status", "error"])

    return uploaded.filter("location IS NOT NULL").select("doc_id", "location").mapInPandas(run, "doc_id long, status string, error string")


_EMBEDDED = f"SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'FAILED' ELSE 'INDEXED' END AS status, CASE WHEN doc_id % 3 = 0 THEN 'EMBED: gave up after 3 attempts: EMBED: location not reflected' END AS error FROM ({_UPLOADED}) WHERE location IS NOT NULL"


@query("http_embed", _EMBEDDED)
def http_embed(s, d):
    return _embedded(_uploaded(s, d))


@query("step_embed", f"SELECT doc_id AS document_id, CAST(u.seq AS INTEGER) AS seq, ['PARSING_DONE', 'CHUNKING_DONE', 'EMBEDDING_DONE', 'INDEXED'][u.seq + 1] AS status FROM ({_EMBEDDED}), unnest(range(4)) u(seq) WHERE status = 'INDEXED'")
def step_embed(s, d):
    """The status events of the documents that were embedded."""
    from quirefold.operators import state

    return state.mark_indexed(_embedded(_uploaded(s, d)).filter("status = 'INDEXED'"))


@query("http_exists", "SELECT doc_id, doc_id % 4 <> 1 AS present FROM documents WHERE external_doc_id IS NOT NULL")
def http_exists(s, d):
    """Whether the outer id occurs in the service's nested listing; it lacks those of every fourth document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            listings = [json.dumps({"localFiles": {"items": [{"items": [] if i % 4 == 1 else [{"id": x}, {"id": "other"}]}]}}) for i, x in zip(b.doc_id, b.external_doc_id)]
            yield pd.DataFrame({"doc_id": b.doc_id, "present": [files.find_in_listing(t, x) for t, x in zip(listings, b.external_doc_id)]})

    return docs(s, d).filter("external_doc_id IS NOT NULL").select("doc_id", "external_doc_id").mapInPandas(run, "doc_id long, present boolean")


@query("llm_correct", f"SELECT doc_id, CASE WHEN length({strip('text')}) >= 80 AND NOT starts_with(text, 'W') THEN replace(text, ' the ', ' THE ') ELSE text END AS text FROM documents WHERE text IS NOT NULL")
def llm_correct(s, d):
    """Texts through a corrector that fails on texts with a W at their beginning, which keeps these texts."""

    def make() -> Callable[[str], str]:
        def correct(text: str) -> str:
            if text.startswith("W"):
                raise ValueError("no answer")
            return text.replace(" the ", " THE ")

        return correct

    return files.correct_texts(_texts(s, d), make)


@query("sink_csv", catalog.SQL["status_counts"].replace(", (SELECT count(*) FROM documents) AS of", ""))
def sink_csv(s, d):
    """The status report written as CSV to the shared folder and read back."""
    path = f"{ensure_checkpoint_dir(s)}/report.csv"
    files.sink_csv(docs(s, d).groupBy("status").agg(F.count("*").alias("n")), path)
    return s.read.option("header", True).schema("status string, n long").csv(path)


@query("sink_markdown", "SELECT line FROM (SELECT unnest(['| status | n |', '| --- | --- |']) AS line UNION ALL SELECT '| ' || coalesce(status, '') || ' | ' || count(*) || ' |' FROM documents GROUP BY status)")
def sink_markdown(s, d):
    """The status report as the lines of a Markdown table."""
    text = files.sink_markdown(docs(s, d).groupBy("status").agg(F.count("*").alias("n")))
    return s.createDataFrame([(x,) for x in text.split("\n")], "line string")


@query("md_table_parse", "SELECT id, CAST(greatest(len(string_split(coalesce(header_text, ''), chr(10))), len(string_split(coalesce(body_text, ''), chr(10)))) + 1 AS INTEGER) AS n_rows FROM page_contents")
def md_table_parse(s, d):
    """Rows of each page's header and body set side by side as a Markdown table and read again."""
    from quirefold.functions import columns as C

    made = pages(s, d).select("id", C.markdown_table([F.split(F.coalesce(c, F.lit("")), "\n") for c in ("header_text", "body_text")], ["header", "body"]).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b.id, "n_rows": [len(viewer.parse_markdown(t)) for t in b.text]})

    return made.mapInPandas(run, "id long, n_rows int")


@query("config_load", "SELECT * FROM (VALUES ('attempts', '5'), ('inbox', 'in'), ('ocr_languages', 'kor,jpn'), ('service', 'http://localhost:3001'), ('waits', '60,120'), ('workspace', '')) t(name, value)")
def config_load(s, d):
    """Settings: defaults, the file over them, the environment over both."""
    config = viewer.Config.load({"inbox": "in", "attempts": 4, "unknown": 1}, {"QUIREFOLD_ATTEMPTS": "5", "QUIREFOLD_OCR_LANGUAGES": "kor,jpn"})
    text = lambda v: ",".join(map(str, v)) if isinstance(v, tuple) else str(v)
    return s.createDataFrame([(n, text(getattr(config, n))) for n in config.__dataclass_fields__], "name string, value string")


@query("http_headers", "SELECT * FROM (VALUES ('Authorization', 'Bearer key'), ('Content-Type', 'application/json')) t(name, value)")
def http_headers(s, d):
    return s.createDataFrame(sorted(files.headers("key").items()), "name string, value string")


@query("http_ping", "SELECT doc_id, doc_id % 4 <> 0 AND doc_id % 5 <> 0 AS reached FROM documents")
def http_ping(s, d):
    """One call per document; every fourth fails and every fifth is refused."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id, "reached": [files.ping(lambda: 1 // (i % 4) * 0 + (403 if i % 5 == 0 else 200)) for i in b.doc_id]})  # noqa: B023

    return docs(s, d).select("doc_id").mapInPandas(run, "doc_id long, reached boolean")


@query("schema_init", f"SELECT table_name, column_name, CAST(ordinal_position - 1 AS INTEGER) AS position FROM information_schema.columns WHERE table_name IN ({', '.join(repr(n) for n in schema.TABLES)})")
def schema_init(s, d):
    """The columns of the store's empty tables, which are those of the stored ones."""
    rows = [(name, column, k) for name in schema.TABLES for k, column in enumerate(schema.create(s, name).columns)]
    return s.createDataFrame(rows, "table_name string, column_name string, position int")


_LATER = list(schema.VERSIONS[2][1])


@query("migrate", "SELECT doc_id, status, NULL::VARCHAR AS source_type, NULL::VARCHAR AS layout_type, NULL::VARCHAR AS detected_languages, false AS has_formula, NULL::VARCHAR AS ocr_strategy FROM documents")
def migrate(s, d):
    """The documents of the first version, brought up to the last."""
    return schema.migrate(docs(s, d).drop(*_LATER), 1).select("doc_id", "status", *_LATER)


@query("migration_versions", "SELECT 2 AS version, 'classification' AS description")
def migration_versions(s, d):
    """What is still to be applied after the first version."""
    return schema.pending(s.createDataFrame([(1,), (1,)], "version int"))
