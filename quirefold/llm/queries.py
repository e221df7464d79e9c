"""The queries of the text problems, each over its whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.llm import boilerplate, encoding, languages, leakage, mojibake, names, scans
from quirefold.operators import packed
from quirefold.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.found(*(table(spark, d, t) for t in ("page_contents", "document_assets", "documents", "document_metadata")))


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every scanned text as continuous paragraphs."""
    return scans.repaired(*(table(spark, d, t) for t in ("page_contents", "document_assets", "documents", "document_metadata")))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    return languages.segments(documents, table(spark, d, "page_contents"), languages.train(documents), mojibake.train_dictionaries(documents))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.mislabelled(table(spark, d, "documents"), table(spark, d, "page_contents"), _segments(spark, d))


def p3_languages(spark: SparkSession, d: str) -> DataFrame:
    """The languages of each document with confidence, letters and segments."""
    return languages.document_languages(table(spark, d, "documents"), _segments(spark, d))


def p3_segments(spark: SparkSession, d: str) -> DataFrame:
    """The language of each segment with its confidence."""
    return _segments(spark, d)


def _spellings(spark: SparkSession, d: str) -> DataFrame:
    fields = packed.packed_fields(table(spark, d, "documents"), table(spark, d, "document_metadata")).filter(F.col("field_name").isin("authors", "affiliations"))
    kind = F.when(F.col("field_name") == "authors", "author").otherwise("affiliation").alias("kind")
    return packed.split_packed(fields).groupBy(kind, F.col("item").alias("name")).agg(F.count("*").alias("n"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return names.spelling_pairs(names.link(_spellings(spark, d)))


def p5_clusters(spark: SparkSession, d: str) -> DataFrame:
    """One row per spelling with the cluster it belongs to."""
    return names.link(_spellings(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.found(table(spark, d, "page_contents"), table(spark, d, "documents"))


def p7_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.cleaned(table(spark, d, "page_contents"), table(spark, d, "documents"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode_texts(table(spark, d, "documents"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts that the ids decode to."""
    return encoding.decode_texts(p8_ids(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def _repaired(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    return mojibake.repaired(documents, mojibake.train_dictionaries(documents))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d).select("doc_id").distinct()


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d)


QUERIES = {
    "p1_found": p1_found,
    "p1_repaired": p1_repaired,
    "p3_found": p3_found,
    "p3_languages": p3_languages,
    "p3_segments": p3_segments,
    "p5_found": p5_found,
    "p5_clusters": p5_clusters,
    "p7_found": p7_found,
    "p7_cleaned": p7_cleaned,
    "p8_ids": p8_ids,
    "p8_decoded": p8_decoded,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p10_restored": p10_restored,
}
SQL: dict[str, str] = {"p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
