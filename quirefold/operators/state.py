"""Document state as tables: an append-only event log folded into the current row, conditional rewrites, upserts, scans.

Mutations of the surveyed store become pure functions of DataFrames; nothing is updated in place.

Defined results: null keys never match; of equal events the larger id wins; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values.
STATUSES = (
    "NEW", "ANALYZING", "TEXT_EXTRACTED", "OCR_DONE", "REVIEW_REQUIRED", "TEXT_READY", "UPLOAD_REQUESTED",
    "UPLOADED", "PARSING_DONE", "CHUNKING_DONE", "EMBEDDING_DONE", "INDEXED", "FAILED",
)
RETRYABLE = ("FAILED", "REVIEW_REQUIRED")
INDEXING = ("PARSING_DONE", "CHUNKING_DONE", "EMBEDDING_DONE", "INDEXED")


def scan_classify(files: DataFrame, known: DataFrame) -> DataFrame:
    """(path, hash, action) of scanned ``files`` (path, hash) against ``known`` (path, hash): error, skip, requeue or register.

    Of new files with equal content the first path registers.
    """
    mine = known.groupBy("path").agg(F.max("hash").alias("old"))
    seen = known.filter(F.col("hash").isNotNull()).select("hash").distinct().withColumn("seen", F.lit(True))
    joined = files.join(mine, "path", "left").join(seen, "hash", "left")
    fresh = F.col("old").isNull() & F.col("seen").isNull() & F.col("hash").isNotNull()
    # least new path per content: an aggregation, so a content with many copies is no hot window
    firsts = joined.filter(fresh).groupBy("hash").agg(F.min("path").alias("first"))
    action = (
        F.when(F.col("hash").isNull(), "error")
        .when(F.col("old") == F.col("hash"), "skip")
        .when(F.col("old").isNotNull(), "requeue")
        .when(F.col("seen").isNotNull(), "skip")
        .when(F.col("path") == F.col("first"), "register")
        .otherwise("skip")
    )
    return joined.join(firsts, "hash", "left").select("path", "hash", action.alias("action"))


def latest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (upsert on the key)."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order]))
    return df.withColumn("_r", rank).filter("_r = 1").drop("_r")


def register(files: DataFrame, documents: DataFrame) -> DataFrame:
    """The files whose path is not registered yet, as NEW rows."""
    return files.join(documents.select("file_path"), "file_path", "left_anti").withColumn("status", F.lit("NEW")).withColumn("retry_count", F.lit(0))


def fold_events(events: DataFrame) -> DataFrame:
    """(document_id, status, last_step, error_message, failures, n_events) after all events (id, document_id, step, result, message)."""
    failed = F.col("result") == "FAILURE"
    pick = lambda c, when: F.max_by(F.when(when, c), F.when(when, F.col("id")))
    done = F.max_by("step", "id")
    folded = events.filter(F.col("document_id").isNotNull()).dropDuplicates(["id"]).groupBy("document_id").agg(
        F.max_by("result", "id").alias("result"), done.alias("last_step"), pick(F.col("message"), failed & F.col("message").isNotNull()).alias("error_message"), F.count_if(failed).alias("failures"), F.count("*").alias("n_events")
    )
    status = F.when(F.col("result") == "FAILURE", "FAILED").when((F.col("last_step") == "INDEXING") & (F.col("result") == "SUCCESS"), "INDEXED").when(F.col("last_step") == "SCAN", "NEW").otherwise("ANALYZING")
    return folded.select("document_id", status.alias("status"), "last_step", "error_message", "failures", "n_events")


def reset_for_retry(documents: DataFrame) -> DataFrame:
    """FAILED and REVIEW_REQUIRED back to NEW, with their errors cleared."""
    hit = F.col("status").isin(*RETRYABLE)
    return documents.withColumns({"error_message": F.when(~F.coalesce(hit, F.lit(False)), F.col("error_message")), "failed_step": F.when(~F.coalesce(hit, F.lit(False)), F.col("failed_step")), "status": F.when(hit, "NEW").otherwise(F.col("status"))})


def reset_all(documents: DataFrame) -> DataFrame:
    """All but NEW and ANALYZING back to NEW without results; detected languages are cleared."""
    hit = ~F.col("status").isin("NEW", "ANALYZING")
    gone = ("source_type", "layout_type", "detected_languages", "ocr_strategy", "external_doc_id", "ocr_quality_score", "error_message", "failed_step")
    changed = {c: F.when(~F.coalesce(hit, F.lit(False)), F.col(c)) for c in gone if c in documents.columns}
    return documents.withColumns(changed | {"retry_count": F.when(hit, 0).otherwise(F.col("retry_count")), "status": F.when(hit, "NEW").otherwise(F.col("status"))})


def force_reset(documents: DataFrame) -> DataFrame:
    """Any status to ANALYZING, without results, errors and retries."""
    gone = ("external_doc_id", "ocr_quality_score", "error_message", "failed_step")
    kinds = dict(documents.dtypes)
    return documents.withColumns({c: F.lit(None).cast(kinds[c]) for c in gone if c in kinds} | {"retry_count": F.lit(0), "status": F.lit("ANALYZING")})


def reset_status(documents: DataFrame, old: str, new: str = "NEW") -> DataFrame:
    """One status to another, all else kept (reset of failed or stuck rows, claiming)."""
    return documents.withColumn("status", F.when(F.col("status") == old, new).otherwise(F.col("status")))


def mark_indexed(documents: DataFrame) -> DataFrame:
    """(document_id, seq, status): the four status events of an indexed document, in order."""
    return documents.select(F.col("doc_id").alias("document_id"), F.posexplode(F.array(*[F.lit(s) for s in INDEXING])).alias("seq", "status"))
