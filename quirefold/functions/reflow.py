"""Line re-flow: hard line breaks inside paragraphs joined, lists, captions, headings and contents lines kept.

``reflow`` is one fold (``aggregate``) over the lines of a text; whether a line joins depends on the line built so far,
which a window cannot see.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirefold.functions import text as T

SENTENCE_END = r"[.!?][\"']?$"
UPPER_OR_DIGIT = r"^(?:\p{Lu}|\p{Nd})"
LOWER = r"^\p{Ll}"
OPENING = r"^[(\[\"'%/±]"


def words(c: Column) -> Column:
    """Number of blank-separated words of a stripped line."""
    return F.when(c == "", 0).otherwise(F.size(F.split(c, rf"{T.SPACE}+")))


def is_list_item(line: Column) -> Column:
    return line.rlike(T.LIST_ITEM)


def is_toc_entry(line: Column) -> Column:
    return line.rlike(T.TOC_ENTRY)


def is_caption_en(line: Column) -> Column:
    return line.rlike(T.CAPTION)


def is_short_heading(line: Column, following: Column) -> Column:
    """A short line without closing punctuation before a clearly longer one."""
    return (
        (line != "") & ~is_list_item(line) & ~is_caption_en(line) & (F.length(line) <= 60) & (words(line) <= 10)
        & ~line.rlike(r"[.?!,;]\z") & (F.length(following) >= F.greatest(F.length(line) + 10, F.lit(32)))
    )


def keep_linebreak(line: Column, following: Column) -> Column:
    return (
        (line == "") | (following == "") | is_list_item(line) | is_list_item(following) | is_caption_en(line) | is_caption_en(following)
        | is_short_heading(line, following) | (line.endswith(":") & (is_list_item(following) | (F.length(following) <= 32))) | (is_toc_entry(line) & is_toc_entry(following))
    )


def merge_softwrap(line: Column, following: Column) -> Column:
    """Ordered rules: the first that holds decides."""
    return (
        F.when((line == "") | (following == ""), False)
        .when(line.endswith("-"), True)
        .when(line.rlike(SENTENCE_END) & following.rlike(UPPER_OR_DIGIT), False)
        .when(following.rlike(LOWER) | following.rlike(OPENING), True)
        .when(F.length(line) >= 45, True)
        .when((words(line) >= 6) & (words(following) >= 3), True)
        .otherwise(False)
    )


def reflow(c: Column) -> Column:
    """``c`` with its paragraphs re-flowed; null for null, empty for blank texts."""
    text = T.strip(T.newline_norm(c))
    lines = F.transform(F.split(text, "\n"), lambda x: T.strip(F.regexp_replace(x, " {2,}", " ")))
    raw = F.split(text, "\n")
    items = F.zip_with(lines, raw, lambda line, r: F.struct(line.alias("line"), (r == "").alias("gap")))
    # done: what is finished; now: the line being built; gaps: empty lines since the last line that counted
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("now"), F.lit(0).alias("gaps"))

    def step(a: Column, x: Column) -> Column:
        line = x["line"]
        skip = (line == "") | line.rlike(T.NOISE_LINE)
        state = lambda done, now, gaps: F.struct(done.alias("done"), now.alias("now"), gaps.alias("gaps"))
        zero, empty = F.lit(0), F.lit("")
        mark = F.when(a["gaps"] >= 2, "\n\n\n").otherwise("\n\n")
        ended = F.concat(a["done"], a["now"], mark)  # the block before a run of empty lines
        glued = F.when(a["now"].endswith("-"), F.concat(F.regexp_replace(a["now"], r"-\z", ""), line)).otherwise(F.concat(a["now"], F.lit(" "), line))
        return (
            F.when(x["gap"], state(a["done"], a["now"], a["gaps"] + 1))
            .when(a["gaps"] > 0, state(ended, F.when(skip, empty).otherwise(line), zero))
            .when(skip, a)
            .when(a["now"] == "", state(a["done"], line, zero))
            .when(keep_linebreak(a["now"], line) | ~merge_softwrap(a["now"], line), state(F.concat(a["done"], a["now"], F.lit("\n")), line, zero))
            .otherwise(state(a["done"], glued, zero))
        )

    folded = F.aggregate(items, start, step, lambda a: F.concat(a["done"], a["now"]))
    return F.when(text == "", F.lit("")).otherwise(folded)


def clean_text(c: Column) -> Column:
    """The whole cleaning chain, in its fixed order."""
    spaced = T.space_norm(T.newline_norm(T.ctrl_strip(c)))
    return T.collapse_blank(reflow(T.dehyphen(spaced)))
