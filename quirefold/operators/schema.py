"""The stores' tables as declared schemas, and their versions: a table of an older version gets the columns it lacks.

Defined results: a column that is there already is left alone; versions are applied in order and each once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Table -> columns with their types. Fixed values.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, file_path string, file_name string, file_hash string, status string, source_type string, layout_type string, detected_languages string, "
    "has_formula boolean, ocr_strategy string, external_doc_id string, ocr_quality_score double, retry_count int, error_message string, failed_step string, created_at string, updated_at string, worker string",
    "process_logs": "id bigint, document_id bigint, step string, result string, message string, logged_at string, worker string",
    "page_contents": "id bigint, document_id bigint, page_num int, header_text string, footer_text string, body_text string, created_at timestamp",
    "document_assets": "id bigint, document_id bigint, file_path string, page_num int, asset_type string, seq_in_doc int, ref_tag string, bbox_x0 double, bbox_y0 double, bbox_x1 double, bbox_y1 double, image_data binary, ocr_text string, caption string, created_at timestamp",
    "document_metadata": "id bigint, document_id bigint, title string, authors string, affiliations string, abstract string, keywords string, created_at timestamp",
}
#: Version -> (description, columns of documents with type and value for older rows). Fixed values.
VERSIONS: dict[int, tuple[str, dict[str, tuple[str, object]]]] = {
    1: ("tables", {}),
    2: ("classification", {"source_type": ("string", None), "layout_type": ("string", None), "detected_languages": ("string", None), "has_formula": ("boolean", False), "ocr_strategy": ("string", None)}),
}


def create(spark: SparkSession, name: str) -> DataFrame:
    """An empty table of the store."""
    return spark.createDataFrame([], TABLES[name])


def pending(applied: DataFrame) -> DataFrame:
    """(version, description) of the versions that are not among ``applied`` (version), in order."""
    known = applied.sparkSession.createDataFrame([(v, text) for v, (text, _) in sorted(VERSIONS.items())], "version int, description string")
    return known.join(applied.select(F.col("version").cast("int").alias("version")).distinct(), "version", "left_anti").orderBy("version")


def migrate(documents: DataFrame, since: int) -> DataFrame:
    """``documents`` of version ``since`` with the columns of all later versions."""
    missing = {c: F.lit(value).cast(kind) for v, (_, columns) in sorted(VERSIONS.items()) if v > since for c, (kind, value) in columns.items() if c not in documents.columns}
    return documents.withColumns(missing)
