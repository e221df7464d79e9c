"""Scalar text functions as built-in Column expressions: they stay in code generation and take nulls to nulls.

Patterns are written so that they mean the same in Java regex and RE2, since the SQL checks use them too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and patterns of the document pipeline.
VALID = r"[가-힣\x{3040}-\x{30FF}A-Za-z0-9\s\x1C-\x1F\x{85}\p{Z}.,!?;:()\-'\"\x{B7}]"
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]"
HANGUL = r"[가-힣\x{1100}-\x{11FF}\x{3130}-\x{318F}]"
KANA = r"[\x{3040}-\x{309F}\x{30A0}-\x{30FF}]"
LATIN = r"[A-Za-z]"
MATH = r"[\x{2200}-\x{22FF}\x{2A00}-\x{2AFF}\x{0370}-\x{03FF}]"
LETTER = r"[\p{L}\p{N}_]"
LIST_ITEM = r"(?i)^(?:[-*–—•·]|\(?[0-9]{1,3}[.)]\)?|[A-Za-z][.)]|[ivxlcdm]+[.)])\s+\S"
TOC_ENTRY = r"^(?:[0-9][0-9.]*|[Aa]nnex\s+[A-Z])\s+\S"
CAPTION = r"(?i)^(?:figure|fig\.?|table|appendix|algorithm|chart|equation)\s*[0-9]+(?:[-.][0-9]+)*(?::|\.(?:[^0-9]|$)|[–—]|\s+[.:–—])"
FIGURE_CAPTION = r"(?i)^(?:그림|figure|fig\.?)\s*[0-9]+(?:[-.][0-9]+)*(?::|\.(?:[^0-9]|$)|\s+[.:])"
TABLE_CAPTION = r"(?i)^(?:표|table)\s*[0-9]+(?:[-.][0-9]+)*(?::|\.(?:[^0-9]|$)|\s+[.:])"
INDEX_ONLY = r"(?i)^(?:표|table|그림|figure|fig\.?)\s*[0-9][0-9.\-]*\.?\s*$"
REF_TAG = r"\[(?:TABLE|FIGURE)_[0-9]{3}\]"
NOISE_LINE = r"^[^\p{L}\p{N}_\x{3040}-\x{30FF}]{1,3}$"
LANG_SHARE, FORMULA_SHARE = 0.03, 0.008
#: Misread Korean phrases and their right forms, applied in this order. Fixed values.
OCR_FIXES = [
    ("끈 노이만", "폰 노이만"), ("전락 기술", "전략 기술"), ("세그만트", "세그먼트"), ("헬스레어", "헬스케어"), ("헬스웨어", "헬스케어"),
    ("스마트포", "스마트폰"), ("옛지", "엣지"), ("가드너", "가트너"), ("용용적", "응용적"), ("학신적", "혁신적"), ("학신올", "혁신을"),
    ("확기적", "획기적"), ("파악하엿", "파악하였"), ("활용월", "활용될"), ("소비률", "소비를"),
]
#: Syllables with a final consonant: each run of 28 code points from U+AC00 starts with one that has none.
CLOSED = "[" + "".join(f"{chr(c + 1)}-{chr(c + 27)}" for c in range(0xAC00, 0xD7A4, 28)) + "]"


def strip(c: Column) -> Column:
    """White space of any kind removed at both ends."""
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def quality_counts(c: Column) -> tuple[Column, Column]:
    """(valid characters, characters) of a text; (0, 0) if it is blank."""
    blank = strip(c) == ""
    return F.when(blank, 0).otherwise(F.regexp_count(c, F.lit(VALID))), F.when(blank, 0).otherwise(F.length(c))


def quality_score(c: Column) -> Column:
    """Share of valid characters, rounded to four digits; 0.0 for blank texts."""
    valid, n = quality_counts(c)
    return F.when(n == 0, 0.0).otherwise(F.round(valid / n, 4))


def meets_quality(c: Column) -> Column:
    valid, n = quality_counts(c)
    return (F.length(c) >= 50) & (valid * 2 >= n) & (n > 0)


def ctrl_strip(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, "")


def newline_norm(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def space_norm(c: Column) -> Column:
    """Ideographic and no-break spaces and tabs as spaces; byte-order marks removed."""
    return F.translate(c, "　 \t﻿", "   ")


def dehyphen(c: Column) -> Column:
    return F.regexp_replace(c, rf"({LETTER})-\n({LETTER})", "$1$2")


def collapse_blank(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\n{4,}", "\n\n\n"))


def formula_text(c: Column) -> Column:
    """Whether mathematical characters make up the threshold share; false for empty texts."""
    return F.coalesce(F.regexp_count(c, F.lit(MATH)) >= F.length(c) * FORMULA_SHARE, F.lit(False)) & (F.length(c) > 0)


def detect_langs(c: Column, file_name: Column) -> Column:
    """kor, jpn, eng by the share of their characters; very short texts by the file name; eng if none."""
    n = F.greatest(F.length(c), F.lit(1))
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) >= n * LANG_SHARE
    parts = F.array_compact(F.array(F.when(share(HANGUL), "kor"), F.when(share(KANA), "jpn"), F.when(share(LATIN), "eng")))
    short = F.when(F.coalesce(file_name, F.lit("")).rlike(HANGUL), F.array(F.lit("kor"), F.lit("eng"))).otherwise(F.array(F.lit("eng")))
    return F.when(F.length(F.coalesce(c, F.lit(""))) < 20, short).when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("eng")))


def josa_fix(c: Column) -> Column:
    """The particles 올 and 름 after a closed syllable at the end of a word, as 을 and 를."""
    tail = r"([\s.,;:!?]|\z)"
    return F.regexp_replace(F.regexp_replace(c, f"({CLOSED})올{tail}", "$1을$2"), f"({CLOSED})름{tail}", "$1를$2")


def ocr_dict_fix(c: Column) -> Column:
    for wrong, right in OCR_FIXES:
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return josa_fix(c)


def html_fallback(c: Column, require_marker: bool = True) -> Column:
    """The text of a page saved by a word processor; empty if its marks are missing."""
    marked = c.rlike(r"(?i)mso-|Microsoft\s+Word") | c.contains("WordDocument")
    t = F.regexp_replace(c, r"(?is)<(style|script)\b[^>]*>.*?</(?:style|script)>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"')):
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = strip(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"\n{3,}", "\n\n"))
    return F.when(marked, t).otherwise("") if require_marker else t


def luminance(color: Column) -> Column:
    """Of a gray, RGB or CMYK colour given as an array; null for none and other sizes."""
    at = lambda i: F.get(color, F.lit(i))
    rgb = lambda r, g, b: r * 0.299 + g * 0.587 + b * 0.114
    open_ = 1.0 - at(3)
    return F.when(F.size(color) == 1, at(0)).when(F.size(color) == 3, rgb(at(0), at(1), at(2))).when(F.size(color) == 4, rgb((1.0 - at(0)) * open_, (1.0 - at(1)) * open_, (1.0 - at(2)) * open_))


def json_list(c: Column) -> Column:
    """A JSON list of texts; empty if it is none."""
    whole = F.when(F.try_parse_json(c).isNotNull(), c)  # a list whose end is missing is none
    return F.coalesce(F.from_json(whole, "array<string>"), F.array().cast("array<string>"))
