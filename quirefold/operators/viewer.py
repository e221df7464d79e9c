"""Small text tools of the viewer and of engine comparison, and extraction by strategy with injected engines."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import attrgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.operators import layout, pages


def parse_markdown(text: str) -> list[list[str]]:
    """The cells of the Markdown table rows in ``text``, without the rule below the head."""
    rows = [[c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", line.strip().strip("|"))] for line in text.split("\n") if line.strip().startswith("|")]
    return [r for r in rows if not all(re.fullmatch(r":?-+:?", c) for c in r)]


def words_one_line(words: DataFrame) -> DataFrame:
    """(doc_id, page_num, text): lines by five points, words by x, lines joined by a bar."""
    line = F.rint(F.col("top") / 5) * 5
    in_line = F.array_sort(F.collect_list(F.struct("x0", "word_no", "text")))  # the words of one line
    lines = words.groupBy("doc_id", "page_num", line.alias("line")).agg(F.array_join(F.transform(in_line, lambda w: w["text"]), " ").alias("t"))
    ordered = F.array_sort(F.collect_list(F.struct("line", "t")))  # the lines of one page
    return lines.groupBy("doc_id", "page_num").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), " | ").alias("text"))


#: What the viewer writes above a header and a footer, and for a page without text. Fixed values.
HEADER, FOOTER, NO_TEXT = "[헤더]", "[푸터]", "(추출된 텍스트 없음)"


def page_view(words: DataFrame, height: float) -> DataFrame:
    """(doc_id, page_num, text) of every page that has a word: the words of its header, its paragraphs, the words of its footer."""
    page = ["doc_id", "page_num"]
    zoned = words.withColumn("zone", layout.zone(F.col("top"), F.lit(height)))
    part = lambda name: zoned.filter(F.col("zone") == name)
    header, footer = (words_one_line(part(n)).withColumnRenamed("text", n) for n in ("header", "footer"))
    main = layout.paragraph_text(layout.lines(part("main"))).withColumnRenamed("text", "main")
    full = words.select(*page).distinct().join(main, page, "left").join(header, page, "left").join(footer, page, "left")
    marked = lambda mark, c: F.concat(F.lit(mark + "\n"), F.col(c))
    return full.select(*page, F.concat_ws("\n\n", marked(HEADER, "header"), F.coalesce("main", F.lit(NO_TEXT)), marked(FOOTER, "footer")).alias("text"))


def page_text(boxes: list[pages.Box], height: float) -> str:
    """The text that ``page_view`` gives for a page whose words are at hand, in their order."""
    zones: dict[str, list] = {"header": [], "main": [], "footer": []}
    for b in boxes:
        zones["header" if b.top < height * 0.08 else "footer" if b.top > height * 0.93 else "main"].append(b)

    def one_line(some: list[pages.Box]) -> str:
        lines: dict[float, list] = {}
        for b in sorted(some, key=attrgetter("x0")):
            lines.setdefault(round(b.top / 5), []).append(b.text)
        return " | ".join(" ".join(lines[k]) for k in sorted(lines))

    marked = [f"{mark}\n{one_line(zones[z])}" if zones[z] else None for mark, z in ((HEADER, "header"), (FOOTER, "footer"))]
    main = pages.to_paragraphs(zones["main"], merged=False) if zones["main"] else NO_TEXT
    return "\n\n".join(x for x in (marked[0], main, marked[1]) if x is not None)


def extract_by_strategy(df: DataFrame, engines: dict[str, Callable[[bytes], str]], default: str = "OCR_KOR_ENG") -> DataFrame:
    """(doc_id, strategy, text, error) of ``df`` (doc_id, strategy, content): each strategy's rows go to its engine only.

    A CASE would run every engine on every row, so the rows are split by strategy and put together again.
    """
    key = F.when(F.col("strategy").isin(*engines), F.col("strategy")).otherwise(default)
    keyed = df.select("doc_id", "strategy", "content", key.alias("engine"))

    def part(name: str, engine: Callable[[bytes], str]) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = []
                for i, s, content in zip(b.doc_id, b.strategy, b.content):
                    try:
                        rows.append((i, s, engine(bytes(content)), None))
                    except Exception as e:  # the row carries its error
                        rows.append((i, s, "", f"{type(e).__name__}: {e}"[:200]))
                yield pd.DataFrame(rows, columns=["doc_id", "strategy", "text", "error"])

        return keyed.filter(F.col("engine") == name).mapInPandas(run, "doc_id long, strategy string, text string, error string")

    return reduce(DataFrame.unionByName, [part(n, e) for n, e in engines.items()])


@dataclass(frozen=True)
class Config:
    """Settings with defaults; environment values come first. ``problems`` lists what does not fit."""

    inbox: str = "inbox"
    workspace: str = ""
    service: str = "http://localhost:3001"
    attempts: int = 3
    waits: tuple[int, ...] = (60, 120)
    ocr_languages: tuple[str, ...] = field(default=("kor", "eng"))

    @classmethod
    def load(cls, settings: dict, environ: dict[str, str], prefix: str = "QUIREFOLD_") -> Config:
        known = cls.__dataclass_fields__
        values = {k: v for k, v in settings.items() if k in known and v is not None}
        for name in known:
            if (v := environ.get(prefix + name.upper())) is not None:
                kind = type(getattr(cls(), name))
                values[name] = tuple(v.split(",")) if kind is tuple else kind(v)
        return cls(**values)

    def problems(self) -> list[str]:
        return [m for bad, m in ((not self.inbox, "inbox is empty"), (not self.workspace, "workspace is not set"), (self.attempts < 1, "attempts must be at least 1")) if bad]
