"""Texts of columns, captions and rows put together: Column expressions over whole page texts, with the same steps in SQL.

A text's parts are what stands between empty lines. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirefold.functions import text as T

#: Words after which a sentence goes on, and marks after which it does not. Fixed values.
MID_SENTENCE = (
    "a an the and or nor but yet so in of to at by for on as from with into onto upon over under is are was were be been being "
    "that which who whom whose when where this these those its their our your not also both either neither than such using shown "
    "given based called used mentioned described defined"
).split()
ENDED, FINISHED = r"[.?!;]\z", r"[.?!;:。！？]\z"
ABBREVIATION = r"^\([A-Z][A-Z0-9]{1,10}\)"
LAST_WORD = rf"([^{T.SPACE[1:-1]}]+)\z"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{T.SPACE}+", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{T.SPACE}+\z", "")


def parts(c: Column) -> Column:
    return F.filter(F.split(T.strip(c), "\n\n"), lambda x: T.strip(x) != "")


def stack(*texts: Column) -> Column:
    return F.array_join(F.filter(F.array(*texts), lambda x: x != ""), "\n\n")


def is_caption(c: Column) -> Column:
    """Whether a stripped line begins like the caption of a figure or a table."""
    return c.rlike(T.FIGURE_CAPTION) | c.rlike(T.TABLE_CAPTION)


def _leading(flags: Column) -> Column:
    """How many flags are set before the first that is not."""
    at = F.array_position(flags, F.lit(False))
    return F.when(at == 0, F.size(flags)).otherwise(at - 1).cast("int")


def join_columns(left: Column, right: Column) -> Column:
    """The right column's text after the left's. A sentence that runs over the break is mended; captions at the head of the right column follow it."""

    def mended(x: Column) -> Column:
        # x: the parts of both sides, the captions that open the right side, the last and the first part that meet
        goes_on = x.head.rlike(T_LOWER) | x.head.rlike(ABBREVIATION) | ((x.n > 0) & F.regexp_replace(F.lower(F.regexp_extract(x.tail, LAST_WORD, 1)), r"[.,;:?!]+\z", "").isin(*MID_SENTENCE))
        glued = F.when(x.tail.endswith("-"), F.concat(F.regexp_replace(x.tail, r"-\z", ""), x.head)).otherwise(F.concat(x.tail, F.lit(" "), x.head))
        before = F.concat(F.slice(x.ls, 1, F.size(x.ls) - 1), F.array(glued))
        after = F.concat(F.slice(x.rs, 1, x.n), F.slice(x.rs, x.n + 2, F.size(x.rs)))
        met = (F.size(x.ls) > 0) & (F.size(x.rs) > 0) & ~x.tail.rlike(ENDED) & goes_on
        return F.when(met, stack(F.array_join(before, "\n\n"), F.array_join(after, "\n\n"))).otherwise(stack(T.strip(left), T.strip(right)))

    def facing(x: Column) -> Column:
        captions = F.transform(x.rs, lambda p: is_caption(T.strip(p)))
        n = F.greatest(F.array_position(captions, F.lit(False)) - 1, F.lit(0)).cast("int")
        return let(n, lambda k: let(F.struct(x.ls.alias("ls"), x.rs.alias("rs"), k.alias("n"), F.coalesce(rstrip(F.try_element_at(x.ls, F.lit(-1))), F.lit("")).alias("tail"), F.coalesce(lstrip(F.get(x.rs, k)), F.lit("")).alias("head")), mended))

    return let(F.struct(parts(left).alias("ls"), parts(right).alias("rs")), facing)


def connect_columns(left: Column, right: Column) -> Column:
    """Struct of both columns' texts (left, right), the sentence that runs over the break mended at the end of the left one."""

    def mended(x: Column) -> Column:
        tail, head = rstrip(F.try_element_at(x.ls, F.lit(-1))), lstrip(F.get(x.rs, F.lit(0)))
        met = (F.size(x.ls) > 0) & (F.size(x.rs) > 0) & ~tail.rlike(ENDED) & head.rlike(T_LOWER)
        glued = F.when(tail.endswith("-"), F.concat(F.regexp_replace(tail, r"-\z", ""), head)).otherwise(F.concat(tail, F.lit(" "), head))
        joined = F.array_join(F.concat(F.slice(x.ls, 1, F.size(x.ls) - 1), F.array(glued)), "\n\n")
        rest = F.array_join(F.slice(x.rs, 2, F.size(x.rs)), "\n\n")
        return F.when(met, F.struct(joined.alias("left"), rest.alias("right"))).otherwise(F.struct(left.alias("left"), right.alias("right")))

    return let(F.struct(parts(left).alias("ls"), parts(right).alias("rs")), mended)


def insert_after(c: Column, pattern: str, tag: Column) -> Column:
    """A text with a line for ``tag`` after the first line that matches; unchanged if none does."""
    at = lambda lines: F.array_position(F.transform(lines, lambda x: T.strip(x).rlike(pattern)), F.lit(True)).cast("int")
    return let(F.split(c, "\n"), lambda lines: F.when(at(lines) == 0, c).otherwise(F.array_join(F.concat(F.slice(lines, 1, at(lines)), F.array(tag), F.slice(lines, at(lines) + 1, F.size(lines))), "\n")))


T_LOWER = r"^\p{Ll}"


def join_columns_captions(left: Column, right: Column) -> Column:
    """``join_columns`` of what lies between: captions at the foot of the left, and captions, tags and cut lines at the head of the right, come after the left's own text."""

    def around(x: Column) -> Column:
        keep = F.size(x.ls) - _leading(F.reverse(F.transform(x.ls, lambda p: is_caption(T.strip(p)))))
        aside = _leading(F.transform(x.rs, lambda p: is_caption(T.strip(p)) | T.strip(p).endswith("…") | T.strip(p).rlike("^" + T.REF_TAG)))
        return let(F.struct(x.ls.alias("ls"), x.rs.alias("rs"), keep.alias("keep"), aside.alias("aside")), placed)

    def placed(x: Column) -> Column:
        own, rest = F.slice(x.ls, 1, x.keep), F.slice(x.rs, x.aside + 1, F.size(x.rs))
        between = F.concat(F.slice(x.ls, x.keep + 1, F.size(x.ls)), F.slice(x.rs, 1, x.aside))
        joined = let(F.struct(F.array_join(own, "\n\n").alias("l"), F.array_join(rest, "\n\n").alias("r")), lambda y: parts(join_columns(y.l, y.r)))
        plain = (F.size(x.ls) == 0) | (F.size(x.rs) == 0) | ((x.keep == F.size(x.ls)) & (x.aside == 0))
        mixed = let(joined, lambda j: F.array_join(F.concat(F.slice(j, 1, x.keep), between, F.slice(j, x.keep + 1, F.size(j) + 1)), "\n\n"))
        return F.when(plain, join_columns(left, right)).otherwise(mixed)

    return let(F.struct(parts(left).alias("ls"), parts(right).alias("rs")), around)


def join_zones(above: Column, tag: Column, below: Column) -> Column:
    """A tag between two texts; inside an unfinished sentence it stays in its line."""

    def placed(x: Column) -> Column:
        inside = (x.b != "") & ~x.b.rlike(FINISHED) & x.a.rlike(T_LOWER) & (T.strip(above) != "") & (T.strip(below) != "")
        one = F.concat(rstrip(above), F.lit(" "), tag, F.lit(" "), lstrip(below))
        return F.when(inside, T.strip(one)).otherwise(stack(T.strip(above), tag, T.strip(below)))

    return let(F.struct(F.regexp_extract(rstrip(above), r"([^\n]*)\z", 1).alias("b"), F.regexp_extract(lstrip(below), r"\A([^\n]*)", 1).alias("a")), placed)


def strip_captions(c: Column) -> Column:
    """A text without its caption lines; a sentence that a caption cut in two is mended. One fold over the lines."""
    start = F.struct(F.lit("").alias("done"), F.lit(None).cast("string").alias("now"), F.lit(False).alias("cut"))

    def step(a: Column, line: Column) -> Column:
        state = lambda done, now, cut: F.struct(done.alias("done"), now.alias("now"), cut.alias("cut"))
        mends = a.cut & (T.strip(line) != "") & (rstrip(F.coalesce(a.now, F.lit(""))) != "") & ~rstrip(a.now).rlike(FINISHED) & lstrip(line).rlike(T_LOWER)
        pushed = F.when(a.now.isNull(), a.done).otherwise(F.concat(a.done, a.now, F.lit("\n")))
        return (
            F.when(is_caption(T.strip(line)), state(a.done, a.now, F.lit(True)))
            .when(mends, state(a.done, F.concat(rstrip(a.now), F.lit(" "), lstrip(line)), F.lit(False)))
            .otherwise(state(pushed, line, a.cut & (T.strip(line) == "")))
        )

    return F.aggregate(F.split(c, "\n"), start, step, lambda a: F.concat(a.done, F.coalesce(a.now, F.lit(""))))


def paragraphs_reflow(c: Column) -> Column:
    """Each paragraph as one line; a hyphen at a line end glues."""
    bare = F.filter(F.split(T.strip(c), rf"\n{T.SPACE}*\n"), lambda p: T.strip(p) != "")
    return F.array_join(F.transform(bare, lambda p: F.regexp_replace(F.regexp_replace(T.strip(p), rf"-\n{T.SPACE}*", ""), rf"{T.SPACE}*\n{T.SPACE}*", " ")), "\n\n")


def wrap(c: Column, width: int = 33) -> Column:
    """A text in lines of at most ``width`` characters, broken at blanks where possible; longer words are cut."""
    words = F.filter(F.split(c, rf"{T.SPACE}+"), lambda w: w != "")
    pieces = F.flatten(F.transform(words, lambda w: F.regexp_extract_all(w, F.lit(rf"(?s)(.{{1,{width}}})"), 1)))
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("now"))

    def step(a: Column, w: Column) -> Column:
        full = F.length(a.now) + 1 + F.length(w) > width
        return F.when(a.now == "", F.struct(a.done.alias("done"), w.alias("now"))).when(full, F.struct(F.concat(a.done, a.now, F.lit("\n")).alias("done"), w.alias("now"))).otherwise(F.struct(a.done.alias("done"), F.concat(a.now, F.lit(" "), w).alias("now")))

    return F.aggregate(pieces, start, step, lambda a: F.concat(a.done, a.now))


def align_rows(rows: Column, words: Column) -> Column:
    """The ``words`` (an array) handed out to the ``rows`` (an array of texts) in proportion to the rows' own words; the last row that has words takes the rest."""

    def handed(x: Column) -> Column:
        total = F.aggregate(x.sizes, F.lit(0), lambda a, n: a + n)
        last = F.size(x.sizes) - F.array_position(F.reverse(F.transform(x.sizes, lambda n: n > 0)), F.lit(True)).cast("int")
        share = lambda n: F.greatest(F.lit(1), F.bround(n / total * F.size(words)).cast("int"))
        takes = F.transform(x.sizes, lambda n, i: F.when(n == 0, 0).when(i == last, F.size(words)).otherwise(share(n)))
        return let(takes, lambda t: F.transform(t, lambda n, i: F.array_join(F.slice(words, F.aggregate(F.slice(t, 1, i), F.lit(0), lambda a, b: a + b) + 1, n), " ")))

    sizes = F.transform(rows, lambda r: F.when(T.strip(r) == "", 0).otherwise(F.size(F.split(T.strip(r), rf"{T.SPACE}+"))))
    return let(F.struct(sizes.alias("sizes")), handed)


def markdown_table(columns: list[Column], titles: list[str]) -> Column:
    """Arrays of lines side by side as a Markdown table."""
    rows = F.greatest(*[F.size(c) for c in columns]) if len(columns) > 1 else F.size(columns[0])
    cell = lambda c, i: F.coalesce(F.replace(F.get(c, i), F.lit("|"), F.lit("\\|")), F.lit(""))
    body = F.transform(F.when(rows > 0, F.sequence(F.lit(0), rows - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c, i) for c in columns]), F.lit(" |")))
    head = F.array(F.lit("| " + " | ".join(titles) + " |"), F.lit("|" + " --- |" * len(titles)))
    return F.array_join(F.concat(head, body), "\n")
