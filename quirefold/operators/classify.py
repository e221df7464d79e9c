"""Document classification and routing: source, layout vote, languages, formula density, extraction strategy, gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.functions import text as T

#: Characters a page from which a document counts as digital. Fixed value.
DIGITAL_CHARS = 50
#: Strategy -> (languages, page segmentation, engine mode); DEFAULT holds for unknown ones. Fixed values.
STRATEGY_PARAMS = [
    ("DIGITAL_EXTRACT", None, None, None), ("DIGITAL_EXTRACT_MULTI", None, None, None), ("DOCX_EXTRACT", None, None, None), ("PPTX_EXTRACT", None, None, None),
    ("OCR_ENG", "eng", 6, 1), ("OCR_KOR_ENG", "kor+eng", 6, 1), ("OCR_JPN", "kor+eng+jpn", 6, 1), ("OCR_MULTI_COL", "kor+eng", 6, None),
    ("OCR_FORMULA", "kor+eng", 6, 1), ("OCR_MULTI_FORMULA", "kor+eng", 6, 1),
]
DEFAULT_STRATEGY = "OCR_KOR_ENG"
#: Non-space characters and score below which a text goes to review. Fixed values.
MIN_CHARS, MIN_SCORE = 50, 0.5


def source_type(avg_chars: Column) -> Column:
    return F.when(avg_chars >= DIGITAL_CHARS, "DIGITAL").otherwise("SCANNED")


def select_strategy(source: Column, layout: Column, languages: Column, formula: Column) -> Column:
    """The first rule that holds; ``languages`` is an array of three-letter codes."""
    multi, has = layout == "MULTI_COLUMN", lambda code: F.array_contains(languages, code)
    return (
        F.when(source == "DOCX", "DOCX_EXTRACT")
        .when(source == "PPTX", "PPTX_EXTRACT")
        .when((source == "DIGITAL") & multi, "DIGITAL_EXTRACT_MULTI")
        .when(source == "DIGITAL", "DIGITAL_EXTRACT")
        .when(multi & formula & ~has("kor"), "OCR_MULTI_FORMULA")
        .when(formula & ~has("kor"), "OCR_FORMULA")
        .when(multi, "OCR_MULTI_COL")
        .when(has("jpn"), "OCR_JPN")
        .when(has("kor"), "OCR_KOR_ENG")
        .otherwise("OCR_ENG")
    )


def strategy_table(spark: SparkSession) -> DataFrame:
    """The fixed parameter table, one row per strategy."""
    return spark.createDataFrame(STRATEGY_PARAMS, "strategy string, lang string, psm int, oem int")


def strategy_params(df: DataFrame, strategy: str) -> DataFrame:
    """``df`` with lang, psm, oem of its strategy column; unknown strategies get the default's."""
    known = strategy_table(df.sparkSession)
    names = [r[0] for r in STRATEGY_PARAMS]
    key = F.when(F.col(strategy).isin(*names), F.col(strategy)).otherwise(DEFAULT_STRATEGY)
    return df.withColumn("_key", key).join(F.broadcast(known.withColumnRenamed("strategy", "_key")), "_key", "left").drop("_key")  # ten rows


def tess_config(psm: Column, oem: Column) -> Column:
    return F.concat_ws(" ", F.when(psm.isNotNull(), F.format_string("--psm %d", psm)), F.when(oem.isNotNull(), F.format_string("--oem %d", oem)))


def profile_str(source: Column, layout: Column, languages: Column, formula: Column, pages: Column) -> Column:
    mark = F.when(formula, "수식 있음").otherwise("수식 없음")
    return F.format_string("[%s] [%s] 언어:%s | %s | %d페이지", source, layout, F.array_join(languages, ","), mark, pages)


def gate(cleaned: Column, score: Column) -> Column:
    """Struct status, reason, char_count (non-space), line_count (non-blank) of a cleaned text."""
    chars = F.length(F.regexp_replace(cleaned, T.SPACE, ""))
    lines = F.size(F.filter(F.split(cleaned, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"), lambda x: T.strip(x) != ""))
    reason = F.when(chars < MIN_CHARS, "length").when(score < MIN_SCORE, "quality")
    return F.struct(F.when(reason.isNotNull(), "REVIEW_REQUIRED").otherwise("TEXT_READY").alias("status"), reason.alias("reason"), chars.alias("char_count"), lines.alias("line_count"))
