"""Queries of the sources, image kernels and streaming operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.operators import images, timestamps
from quirefold.plans import boxes
from quirefold.plans.catalog import docs, logs, pages
from quirefold.plans.sqltext import HEIGHT, WIDTH, WORDS, q
from quirefold.plans.sqltimes import instants
from quirefold.session import table
from quirefold.sources import office
from quirefold.streaming.logs import windowed_counts

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def _packed(df: DataFrame, kind: str) -> DataFrame:
    """(path, content): each text as a file of its kind, a paragraph or slide per line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lines = [t.split("\n") for t in b.text]
            made = [office.make_docx(x) if kind == "docx" else office.make_pptx([[y] for y in x]) for x in lines]
            yield pd.DataFrame({"path": [f"{i}.{kind}" for i in b.id], "content": made})

    return df.mapInPandas(run, "path string, content binary")


_BAD = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"
_EDGE = r"\A[\s\x0B\x{85}\p{Z}]+|[\s\x0B\x{85}\p{Z}]+\z"
_LINES = f"list_transform(string_split(regexp_replace(regexp_replace(text, {q(_BAD)}, '', 'g'), '\\r\\n?', chr(10), 'g'), chr(10)), lambda x: regexp_replace(x, {q(_EDGE)}, '', 'g'))"


def _clean(df: DataFrame) -> DataFrame:
    text = F.regexp_replace(F.regexp_replace("text", _BAD, ""), "\r\n?", "\n")
    return df.select("id", text.alias("text"))


@query("docx_source", f"SELECT doc_id || '.docx' AS path, array_to_string(list_filter({_LINES}, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM documents WHERE text IS NOT NULL")
def docx_source(s, d):
    """All texts written as documents and read back."""
    made = _packed(_clean(docs(s, d).filter("text IS NOT NULL").select(F.col("doc_id").alias("id"), "text")), "docx")
    return office.read_office(made).select("path", "text")


@query("pptx_source", f"SELECT path, CAST(k AS INTEGER) AS page_num, t AS text FROM (SELECT id || '.pptx' AS path, unnest(range(len(p))) AS k, unnest(p) AS t FROM (SELECT id, {_LINES.replace('text', 'body_text', 1)} AS p FROM page_contents WHERE body_text IS NOT NULL))")
def pptx_source(s, d):
    """All pages written as presentations, a slide per line, and read back."""
    made = _packed(_clean(pages(s, d).filter("body_text IS NOT NULL").select("id", F.col("body_text").alias("text"))), "pptx")
    return office.read_office(made).select("path", "page_num", "text")


def _page_images(s, d) -> DataFrame:
    """Pages of word boxes drawn at a quarter of their size."""

    def draw(key: tuple, page: pd.DataFrame) -> pd.DataFrame:
        image = images.render(page, int(WIDTH), int(HEIGHT), 0.25)
        return pd.DataFrame([(*key, *image.shape, image.tobytes())], columns=["doc_id", "page_num", "h", "w", "data"])

    return boxes.words(s, d).groupBy("doc_id", "page_num").applyInPandas(draw, "doc_id long, page_num int, h int, w int, data binary")  # the words of one page


_INK = f"SELECT doc_id, page_num, CAST(sum((greatest(trunc(bottom / 4), trunc(top / 4) + 1) - trunc(top / 4)) * (trunc(x1 / 4) - trunc(x0 / 4))) AS BIGINT) AS dark FROM words GROUP BY ALL"


@query("page_render", f"WITH {WORDS} {_INK.replace('page_num,', f'page_num, {int(HEIGHT / 4)} AS h, {int(WIDTH / 4)} AS w,', 1)}")
def page_render(s, d):
    """Size and dark pixels of each page drawn at a quarter of its size."""
    return images.map_images(_page_images(s, d), lambda x: (x < 128).sum(), "dark").join(_page_images(s, d).select("doc_id", "page_num", "h", "w"), ["doc_id", "page_num"]).withColumn("dark", F.col("dark").cast("long"))


@query("binarise", f"WITH {WORDS} {_INK}")
def binarise(s, d):
    """Dark pixels of each page after its own threshold."""
    return images.map_images(_page_images(s, d), lambda x: (x <= images.otsu(x)).sum(), "dark").withColumn("dark", F.col("dark").cast("long"))


@query("layout_scanned")
def layout_scanned(s, d):
    return images.map_images(_page_images(s, d), images.is_multi_column, "multi")


@query("split_page")
def split_page(s, d):
    return images.map_images(_page_images(s, d), images.split_column, "split_x")


@query("formula_scanned")
def formula_scanned(s, d):
    return images.map_images(_page_images(s, d), images.horizontal_rules, "rules")


@query("log_windows", f"WITH {instants('SELECT DISTINCT id, step, result, logged_at AS text, worker FROM process_logs')} SELECT time_bucket(INTERVAL 1 hour, make_timestamp(utc_us)) AS start, time_bucket(INTERVAL 1 hour, make_timestamp(utc_us)) + INTERVAL 1 hour AS \"end\", step, result, count(DISTINCT id) AS n FROM moments WHERE utc_us IS NOT NULL GROUP BY ALL")
def log_windows(s, d):
    """Log events per hour, step and result; the same function runs on a stream."""
    at = timestamps.with_instants(logs(s, d).select("id", "step", "result", "logged_at", "worker"), {"logged_at": "us"}, table(s, d, "workers"))
    return windowed_counts(at.filter("us IS NOT NULL").withColumn("at", F.timestamp_micros("us")))


@query("event_windows", "SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(s, d):
    e = table(s, d, "events").select(F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select("w.start", "event_type", "n")
