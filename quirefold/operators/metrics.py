"""Reports over documents and logs: counts, rates, bins, elapsed times. All sums are exact (integers), callers divide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status sets of the rates, bounds of the quality bins, acceptance thresholds.
TEXT_SUCCESS = ("TEXT_READY", "UPLOAD_REQUESTED", "UPLOADED", "PARSING_DONE", "CHUNKING_DONE", "EMBEDDING_DONE", "INDEXED", "REVIEW_REQUIRED")
UPLOADED = ("UPLOADED", "PARSING_DONE", "CHUNKING_DONE", "EMBEDDING_DONE", "INDEXED")
BINS = (("<0.50", 0.0, 0.5), ("0.50-0.70", 0.5, 0.7), ("0.70-0.85", 0.7, 0.85), (">=0.85", 0.85, 1.01))


def score_e4(c: Column) -> Column:
    """A score of four digits as an integer, so that sums do not depend on their order."""
    return F.round(c * 10000).cast("bigint")


def counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n) of the values that are neither null nor empty."""
    return df.filter(F.col(column).isNotNull() & (F.col(column).cast("string") != "")).groupBy(column).agg(F.count("*").alias("n"))


def quality_stats(df: DataFrame) -> DataFrame:
    """n, sum and extremes of the scores in ten-thousandths, and how many reach .99; zeros without scores."""
    s = score_e4(F.col("ocr_quality_score"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return df.agg(F.count("ocr_quality_score").alias("n"), zero(F.sum(s)).alias("sum_e4"), zero(F.min(s)).alias("min_e4"), zero(F.max(s)).alias("max_e4"), F.count_if(s >= 9900).alias("n_99"))


def quality_bins(df: DataFrame) -> DataFrame:
    """(bin, n) of all bins, also the empty ones."""
    q = F.col("ocr_quality_score")
    rows = [F.struct(F.lit(name).alias("bin"), F.count_if((q >= low) & (q < high)).alias("n")) for name, low, high in BINS]
    return df.agg(F.array(*rows).alias("b")).select(F.inline("b"))


def success_rates(df: DataFrame) -> DataFrame:
    """total, text successes, uploads, indexed, failed and the upload denominator."""
    s = F.col("status")
    n = lambda *x: F.count_if(s.isin(*x))
    out = df.agg(F.count("*").alias("total"), n(*TEXT_SUCCESS).alias("text_success"), n(*UPLOADED).alias("uploaded"), n("INDEXED").alias("indexed"), n("FAILED").alias("failed"), n("REVIEW_REQUIRED").alias("review"))
    return out.withColumn("upload_of", F.greatest(F.col("text_success") - F.col("review"), F.lit(1)))


def elapsed(logs: DataFrame) -> DataFrame:
    """(document_id, elapsed_us): last successful INDEXING minus last successful ANALYZE of ``logs`` (document_id, step, result, at_us), at least 0; documents with both."""
    at = lambda step: F.max(F.when((F.col("step") == step) & (F.col("result") == "SUCCESS"), F.col("at_us")))
    both = logs.filter(F.col("document_id").isNotNull()).groupBy("document_id").agg(at("ANALYZE").alias("a"), at("INDEXING").alias("b"))
    return both.filter("a IS NOT NULL AND b IS NOT NULL").select("document_id", F.greatest(F.lit(0), F.col("b") - F.col("a")).alias("elapsed_us"))


def elapsed_stats(times: DataFrame) -> DataFrame:
    """Of the positive times: n, sum, largest, and how many lie within 180 and 300 seconds."""
    t = F.col("elapsed_us")
    return times.filter(t > 0).agg(F.count("*").alias("n"), F.coalesce(F.sum(t), F.lit(0)).alias("sum_us"), F.coalesce(F.max(t), F.lit(0)).alias("max_us"), F.count_if(t <= 180_000_000).alias("n_180"), F.count_if(t <= 300_000_000).alias("n_300"))


def criteria(rates: DataFrame, quality: DataFrame, multi: DataFrame, times: DataFrame) -> DataFrame:
    """(criterion, passed) of the acceptance list, from the one-row reports above."""
    one = rates.select("total", "text_success", "uploaded", "indexed", "failed", "upload_of").withColumn("k", F.lit(1))
    for df, names in ((quality, {"n": "qn", "sum_e4": "qs", "min_e4": "qmin"}), (multi, {"n": "mn", "min_e4": "mmin", "sum_e4": "ms"}), (times, {"n": "tn", "sum_us": "ts", "n_300": "t300"})):
        one = one.join(F.broadcast(df.select(*[F.col(a).alias(b) for a, b in names.items()], F.lit(1).alias("k"))), "k")  # one row each
    c = F.col
    checks = {
        "text rate >= 90 %": c("text_success") * 10 >= c("total") * 9, "upload rate >= 95 %": c("uploaded") * 100 >= c("upload_of") * 95, "indexed >= 85 %": c("indexed") * 100 >= c("total") * 85,
        "failed <= 5 %": c("failed") * 100 <= c("total") * 5, "mean time <= 300 s": c("ts") <= c("tn") * 300_000_000, "mean quality >= 0.95": c("qs") >= c("qn") * 9500,
        "least multi-column quality >= 0.95": c("mmin") >= 9500, "mean multi-column quality >= 0.95": c("ms") >= c("mn") * 9500, "all within 300 s": c("t300") == c("tn"),
    }
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("criterion"), v.alias("passed")) for k, v in checks.items()])))
