"""SQL snippets shared by the oracle strings: the same patterns as the Column functions, in DuckDB's dialect."""

from __future__ import annotations

from quirefold.functions import text as T


def q(pattern: str) -> str:
    """A SQL string literal."""
    return "'" + pattern.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"regexp_replace({c}, {q(rf'\A{T.SPACE}+|{T.SPACE}+\z')}, '', 'g')"


def lstrip(c: str) -> str:
    return f"regexp_replace({c}, {q(rf'\A{T.SPACE}+')}, '')"


def rstrip(c: str) -> str:
    return f"regexp_replace({c}, {q(rf'{T.SPACE}+\z')}, '')"


def count(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, {q(pattern)}))"


def match(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {q(pattern)})"


def sub(c: str, pattern: str, new: str) -> str:
    return f"regexp_replace({c}, {q(pattern)}, {new}, 'g')"


def newline_norm(c: str) -> str:
    return sub(c, r"\r\n?", "chr(10)")


#: Lines of the stored pages, stripped, with the line that follows.
LINES = f"""
page_lines AS (
  SELECT id, CAST(u.i AS INTEGER) AS line_no, {strip("parts[u.i + 1]")} AS line, coalesce({strip("parts[u.i + 2]")}, '') AS following
  FROM (SELECT id, string_split({newline_norm("body_text")}, chr(10)) AS parts FROM page_contents WHERE body_text IS NOT NULL), unnest(range(len(parts))) u(i))
"""

#: Word boxes laid out from the documents' texts: eight words a line in two columns, fifty lines a page of 600 x 800 points.
WORDS = r"""
split_texts AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \n\t\r]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
words AS (
  SELECT doc_id, CAST((u.i // 8) // 50 AS INTEGER) AS page_num, CAST(u.i AS INTEGER) AS word_no, w[u.i + 1] AS text,
         CAST(40 + (u.i % 8) * 60 + CASE WHEN u.i % 8 >= 4 THEN 70 ELSE 0 END AS DOUBLE) AS x0,
         CAST(40 + (u.i % 8) * 60 + CASE WHEN u.i % 8 >= 4 THEN 70 ELSE 0 END + least(6 * length(w[u.i + 1]), 55) AS DOUBLE) AS x1,
         CAST(60 + 14 * ((u.i // 8) % 50) AS DOUBLE) AS top, CAST(70 + 14 * ((u.i // 8) % 50) AS DOUBLE) AS bottom
  FROM split_texts, unnest(range(len(w))) u(i))
"""
WIDTH, HEIGHT = 600.0, 800.0
LINE = "round_even(top / 3, 0) * 3"
