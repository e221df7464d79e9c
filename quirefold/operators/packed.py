"""Problem 6: several values packed in one text, as one row per value with its position.

The delimiters that count are inferred per source and field: every candidate is scored on the values that hold it
outside quotes, by how often it is the one that cuts the value into most pieces (piece-count consistency) and by the
share of regular pieces it makes (piece type), pooled with the field's overall score so that small sources lean on the
rest. Each value is then split by the inferred delimiters, lists in brackets and numbered lists by their own syntax.

Defined results: null, empty and blank values and empty lists hold no value; empty slots take no position; a field with
one value holds one; quoting, brackets, numbering and outer blanks are removed, escapes and doubled quotes resolved; a
list whose end is missing is read as far as it goes; repeated rows are each split; other columns are ignored.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirefold.session import bounded_broadcast, cut

#: Candidate delimiters by field kind, fixed values; "/" needs blanks around it unless the pieces are codes.
CANDIDATES = {
    "code": ["\n", ";", "|", "\t", ",", "/", "+", " ", "·", "、", "，", "；"],
    "name": ["\n", ";", "|", "\t", ",", " / ", " and ", "&", "·", "、", "，", "；"],
    "organisation": ["\n", ";", "|", "\t", ",", " / ", "·", "、", "，", "；"],
    "phrase": ["\n", ";", "|", "\t", ",", " / ", "/", "·", "、", "，", "；"],
}
#: The kinds of piece in the fields of this project.
KINDS = {"detected_languages": "code", "authors": "name", "affiliations": "organisation", "keywords": "phrase"}
#: A candidate counts in a source if its pooled score reaches this.
ACCEPT = 0.25
#: Weight of the field's overall score in a source's score, in values.
POOL = 50.0

_PARTICLE = {"van", "von", "de", "der", "den", "da", "di", "del", "la", "le", "du"}
_NUMBERED = re.compile(r"(?:^|(?<=[\s;,|]))(?:\[(\d{1,3})\]|\((\d{1,3})\)|(\d{1,3})\))\s+")
_QUOTED = re.compile(r'"(?:[^"\\]|""|\\.)*"')
_INITIALS = re.compile(r"(?:[^\W\d_]\.?[\s-]?){1,4}$")
_HOLD = "\ue000"


def _literal_list(text: str) -> list[str] | None:
    """The items of a JSON or Python list, also of one whose end is missing; None if it is none."""
    for end in ("", "]", '"]', "']"):
        for load in (json.loads, ast.literal_eval):
            try:
                value = load(text + end)
            except (ValueError, SyntaxError, MemoryError, RecursionError):
                continue
            if isinstance(value, (list, tuple, set)):
                return ["" if x is None else str(x) for x in value]
    return None


def _unquote(piece: str) -> str:
    piece = piece.strip()
    for quote in ('"', "'"):
        if len(piece) > 1 and piece[0] == quote and piece[-1] == quote:
            piece = re.sub(r"\\(.)", r"\1", piece[1:-1].replace(quote * 2, quote)).strip()
            break
    return piece


def _numbered(text: str) -> list[str] | None:
    """The items of a list numbered 1, 2, 3 ... in brackets; None if it is none."""
    marks = [m for m in _NUMBERED.finditer(text)]
    if not marks or marks[0].start() != 0:
        return None
    items, want, begin = [], 1, None
    for m in marks:
        if int(m[1] or m[2] or m[3]) == want:
            if begin is not None:
                items.append(text[begin : m.start()])
            begin, want = m.end(), want + 1
    return [x.strip().rstrip(";,|").strip() for x in [*items, text[begin:]]] if begin is not None else None


def _hide(text: str) -> tuple[str, list[str]]:
    """``text`` with each quoted stretch that fills a slot replaced by one mark, and the stretches."""
    kept: list[str] = []
    if _HOLD in text:
        return text, [_HOLD] * text.count(_HOLD)

    def hide(m: re.Match) -> str:
        kept.append(m[0])
        return _HOLD

    return _QUOTED.sub(hide, text), kept


def _cut(hidden: str, delimiter: str) -> list[str]:
    if delimiter == " and ":
        return re.split(r",?\s+and\s+", hidden)
    if delimiter == " ":
        return hidden.split()
    return hidden.split(delimiter)


def _regular(piece: str, kind: str) -> bool:
    """Whether a piece has the type of a whole value: a letter code, a name of two parts or more, an organisation, a phrase."""
    words = piece.replace(_HOLD, '"x y"').split()
    if not words:
        return True
    if kind == "code":
        return len(words) == 1 and (_HOLD in piece or bool(re.fullmatch(r"[^\W\d_]{2,3}", words[0])))
    if kind in ("name", "organisation"):
        return _HOLD in piece or (len(words) > 1 and not _INITIALS.fullmatch(piece.strip()))
    return True


def _join_names(pieces: list[str]) -> list[str]:
    """Join a surname with the given names or initials after its comma."""
    out: list[str] = []
    k = 0
    while k < len(pieces):
        a = pieces[k].strip()
        b = pieces[k + 1].strip() if k + 1 < len(pieces) else ""
        family = [w for w in a.split() if w.lower() not in _PARTICLE]
        given = b.split()
        alone = len(family) == 1 and not a.endswith(".") and _HOLD not in a
        if alone and b and _HOLD not in b and (len(given) == 1 or all(len(w.strip(".")) <= 2 for w in given[1:])):
            out.append(f"{a}, {b}")
            k += 2
        else:
            out.append(pieces[k])
            k += 1
    return out


def _join_places(pieces: list[str]) -> list[str]:
    """Join an organisation with the single-word place after its comma."""
    out: list[str] = []
    for p in pieces:
        word = p.strip()
        if out and word and len(word.split()) == 1 and _HOLD not in word and _HOLD not in out[-1] and len(out[-1].split()) > 1:
            out[-1] = f"{out[-1].rstrip()}, {word}"
        else:
            out.append(p)
    return out


def split_value(text: str | None, kind: str, accepted: set[str] | None = None) -> list[str]:
    """The values that ``text`` holds; ``accepted`` are the delimiters that count, all candidates by default."""
    if text is None or not (text := text.strip()):
        return []
    if text[0] == "[" and (items := _literal_list(text)) is not None:
        return [x.strip() for x in items if x.strip()]
    if (items := _numbered(text)) is not None:
        return [y for x in items if (y := _unquote(x))]
    hidden, kept = _hide(text)
    pieces = [hidden]
    for delimiter in CANDIDATES[kind]:
        if accepted is not None and delimiter not in accepted or delimiter == "/" and kind == "phrase" and accepted is None:
            continue
        new: list[str] = []
        for p in pieces:
            cut = _cut(p, delimiter) if delimiter.strip(" ") in p or delimiter == " " else [p]
            if delimiter == "," and len(cut) > 1 and kind == "name":
                cut = _join_names([re.sub(r"^\s*and\s+", "", c) for c in cut])
            elif delimiter == "," and len(cut) > 1 and kind == "organisation":
                cut = _join_places(cut)
            new += cut
        pieces = new
    out, at = [], iter(kept)
    for p in pieces:
        whole = re.sub(_HOLD, lambda _: next(at), p)
        if value := _unquote(whole):
            out.append(value)
    return out


def _score(text: str | None, kind: str) -> list[tuple[str, float]]:
    """(candidate, score) of each candidate in one value without list syntax."""
    if text is None or not (text := text.strip()) or text[0] == "[" or _numbered(text) is not None:
        return []
    hidden, _ = _hide(text)
    join = {"name": _join_names, "organisation": _join_places}.get(kind, lambda c: c)
    cuts = {d: [c for c in _cut(hidden, d) if c.strip()] for d in CANDIDATES[kind] if (d if d in (" ", " and ") else d.strip(" ")) in hidden}
    cuts = {d: c for d, c in ((d, join(c) if d == "," else c) for d, c in cuts.items()) if len(c) > 1}
    if kind == "phrase" and " / " in cuts:
        cuts.pop("/", None)
    most = max((len(c) for c in cuts.values()), default=0)
    out = []
    for d, c in cuts.items():
        regular = sum(_regular(x, kind) for x in c) / len(c)
        out.append((d, regular if len(c) == most and most > (d == "/" and kind == "phrase") * 2 else 0.0))
    return out


def delimiter_scores(values: DataFrame) -> DataFrame:
    """(field_name, source, delimiter, score, n) of ``values`` (field_name, source, text): pooled scores per source."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(f, s, d, x) for f, s, t in zip(b.field_name, b.source, b.text) for d, x in _score(t, KINDS[f])]
            yield pd.DataFrame(rows, columns=["field_name", "source", "delimiter", "score"])

    each = values.select("field_name", F.coalesce("source", F.lit("")).alias("source"), "text").mapInPandas(run, "field_name string, source string, delimiter string, score double")
    by_source = each.groupBy("field_name", "source", "delimiter").agg(F.sum("score").alias("total"), F.count("*").alias("n"))
    # a window over the few rows of the aggregate, so that the values are scored once
    field = W.partitionBy("field_name", "delimiter")
    overall = F.sum("total").over(field) / F.sum("n").over(field)
    pooled = (F.col("total") + POOL * overall) / (F.col("n") + POOL)
    return by_source.select("field_name", "source", "delimiter", pooled.alias("score"), "n")


def split_packed(values: DataFrame) -> DataFrame:
    """(table_name, row_id, field_name, pos, item, n_items) of ``values`` (table_name, row_id, field_name, source, text), with the delimiters inferred per source."""
    accepted = cut(
        delimiter_scores(values).filter(F.col("score") >= ACCEPT).groupBy("field_name", "source").agg(F.collect_set("delimiter").alias("accepted"))
    )  # a set of at most a dozen candidates per source and field
    # one row per source and field: sent around after a check of their number, so that a source with many values is no hot key
    joined = values.withColumn("source", F.coalesce("source", F.lit(""))).join(bounded_broadcast(accepted), ["field_name", "source"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for table, row, field, text, delimiters in zip(b.table_name, b.row_id, b.field_name, b.text, b.accepted):
                items = split_value(text, KINDS[field], set() if delimiters is None else set(delimiters))
                out += [(table, row, field, pos, item, len(items)) for pos, item in enumerate(items)]
            yield pd.DataFrame(out, columns=["table_name", "row_id", "field_name", "pos", "item", "n_items"])

    schema = "table_name string, row_id long, field_name string, pos int, item string, n_items int"
    return joined.select("table_name", "row_id", "field_name", "text", "accepted").mapInPandas(run, schema)


def packed_fields(documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """The packed fields of both tables as (table_name, row_id, field_name, source, text)."""
    languages = documents.select(F.lit("documents").alias("table_name"), F.col("doc_id").alias("row_id"), F.lit("detected_languages").alias("field_name"), "source", F.col("detected_languages").alias("text"))
    sources = documents.select(F.col("doc_id").alias("document_id"), "source")
    fields = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in ("authors", "affiliations", "keywords")])
    meta = (
        metadata.select("id", "document_id", "authors", "affiliations", "keywords")
        .join(sources, "document_id", "left")
        .select(F.lit("document_metadata").alias("table_name"), F.col("id").alias("row_id"), "source", F.inline(fields))
        .select("table_name", "row_id", "field_name", "source", "text")
    )
    return languages.unionByName(meta)
