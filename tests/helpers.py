"""Small tables in the shape of the project's data."""

from __future__ import annotations

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, file_path string, file_name string, file_hash string, status string, source_type string, layout_type string, "
    "detected_languages string, has_formula boolean, ocr_strategy string, external_doc_id string, ocr_quality_score double, retry_count int, error_message string, failed_step string, created_at string, updated_at string, worker string",
    "process_logs": "id long, document_id long, step string, result string, message string, logged_at string, worker string",
    "page_contents": "id long, document_id long, page_num int, header_text string, footer_text string, body_text string, created_at timestamp",
    "document_assets": "id long, document_id long, file_path string, page_num int, asset_type string, seq_in_doc int, ref_tag string, bbox_x0 double, bbox_y0 double, bbox_x1 double, bbox_y1 double, image_data binary, ocr_text string, caption string, created_at timestamp",
    "document_metadata": "id long, document_id long, title string, authors string, affiliations string, abstract string, keywords string, created_at timestamp",
    "workers": "worker string, time_zone string, date_order string",
    "eval_items": "item_id long, lang string, instruction string, passage string, question string",
}
#: Columns with names that the operators use inside, added to every table to see that they do no harm.
CLASHING = ["key", "hash", "n", "head", "root", "zone", "spans", "salt", "known", "reason", "source_name", "item", "pos", "word", "line", "lines", "block", "component", "h", "ids", "page_id", "row_id", "title_", "clean"]


def names(table: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in SCHEMAS[table].split(",")]


def frame(spark, table: str, rows: list[dict]):
    columns = names(table)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], SCHEMAS[table])


def write_tables(spark, folder, clash: bool = False, **tables) -> str:
    """Write the given rows (and empty tables for the rest) as a data folder."""
    from pyspark.sql import functions as F

    for name in SCHEMAS:
        df = frame(spark, name, tables.get(name, []))
        if clash:
            df = df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def null_rows() -> dict[str, list[dict]]:
    """A row of nulls for every table."""
    return {name: [{}] for name in SCHEMAS}


def plain(rows) -> list[tuple]:
    return sorted(tuple(r) for r in rows)
