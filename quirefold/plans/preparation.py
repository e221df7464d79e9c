"""The queries of the general preparation problems (2, 4, 6), each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.operators import orphans, packed, timestamps
from quirefold.plans.sqltimes import instants
from quirefold.session import table


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    workers = table(spark, d, "workers")
    logs = timestamps.with_instants(table(spark, d, "process_logs").select("id", "document_id", "logged_at", "worker"), {"logged_at": "row_us"}, workers)
    documents = timestamps.with_instants(table(spark, d, "documents").select("doc_id", "created_at", "worker"), {"created_at": "created_us"}, workers)
    children = orphans.child_tables({n: table(spark, d, n) for n in ("page_contents", "document_assets")}, logs)
    return orphans.orphan_rows(children, documents.select(F.col("doc_id").alias("document_id"), "created_us"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "row_id", "reason")


def p2_orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_counts(_orphans(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    workers = table(spark, d, "workers")
    documents = timestamps.normalised(table(spark, d, "documents"), "documents", "doc_id", ["created_at", "updated_at"], workers)
    logs = timestamps.normalised(table(spark, d, "process_logs"), "process_logs", "id", ["logged_at"], workers)
    return documents.unionByName(logs).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    values = packed.packed_fields(table(spark, d, "documents"), table(spark, d, "document_metadata"))
    return packed.split_packed(values).filter("n_items > 1").drop("n_items").distinct()


def p6_delimiters(spark: SparkSession, d: str) -> DataFrame:
    """The delimiters inferred for each source and field."""
    values = packed.packed_fields(table(spark, d, "documents"), table(spark, d, "document_metadata"))
    return packed.delimiter_scores(values).filter(F.col("score") >= packed.ACCEPT).select("field_name", "source", "delimiter", "n")


QUERIES = {"p2_found": p2_found, "p2_orphan_counts": p2_orphan_counts, "p4_found": p4_found, "p6_found": p6_found, "p6_delimiters": p6_delimiters}
_FIELDS = """SELECT 'documents' AS table_name, doc_id AS row_id, 'created_at' AS field_name, created_at AS text, worker FROM documents
UNION ALL SELECT 'documents', doc_id, 'updated_at', updated_at, worker FROM documents UNION ALL SELECT 'process_logs', id, 'logged_at', logged_at, worker FROM process_logs"""
_ORPHANS = f"""WITH {instants(_FIELDS)},
rows_of AS (SELECT 'page_contents' AS table_name, id AS row_id, document_id, epoch_us(created_at) AS row_us FROM page_contents UNION ALL SELECT 'document_assets', id, document_id, epoch_us(created_at) FROM document_assets
  UNION ALL SELECT 'process_logs', l.id, l.document_id, a.utc_us FROM process_logs l LEFT JOIN (SELECT DISTINCT row_id, utc_us FROM moments WHERE table_name = 'process_logs') a ON a.row_id = l.id),
parents AS (SELECT d.doc_id, a.utc_us FROM documents d LEFT JOIN moments a ON a.row_id = d.doc_id AND a.field_name = 'created_at'),
orphans AS (SELECT DISTINCT table_name, row_id, row_us, CASE WHEN p.doc_id IS NULL THEN 'absent' ELSE 'late' END AS reason FROM rows_of r LEFT JOIN parents p ON p.doc_id = r.document_id
  WHERE r.document_id IS NOT NULL AND (p.doc_id IS NULL OR p.utc_us > r.row_us + 86400000000))"""

SQL: dict[str, str] = {
    "p2_found": f"{_ORPHANS} SELECT table_name, row_id, reason FROM orphans",
    "p2_orphan_counts": f"{_ORPHANS} SELECT table_name, strftime(make_timestamp(row_us), '%Y-%m') AS month, reason, count(*) AS n_rows FROM orphans GROUP BY ALL",
    "p4_found": f"WITH {instants(_FIELDS)} SELECT DISTINCT table_name, row_id, field_name, utc_us FROM moments WHERE utc_us IS NOT NULL AND NOT regexp_matches(text, '{timestamps.CANONICAL}')",
}
