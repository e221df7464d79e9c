"""Word boxes to text: lines, columns, gaps, paragraphs. Everything is local to a page (doc_id, page_num).

``words``: doc_id, page_num, word_no, text, x0, x1, top, bottom (points, y downwards). Line keys, coverage and gaps are
aggregations and windows; the ordered folds run per page as array functions or over sorted partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PAGE = ["doc_id", "page_num"]
#: Bins over the page width and those in which a column gap may lie; fixed values.
BINS, GAP_FROM, GAP_TO = 200, 70, 129
LINE_PT, MERGE_PT = 3.0, 9.0
#: Bins whose cover by a line is held in one number.
MASK = 50


def line_key(top: Column) -> Column:
    """The line a box belongs to: its top rounded (half to even) to three points."""
    return F.rint(top / LINE_PT) * LINE_PT


def zone(top: Column, height: Column) -> Column:
    return F.when(top < height * 0.08, "header").when(top > height * 0.93, "footer").otherwise("main")


def column_side(x0: Column, x1: Column, gap: Column) -> Column:
    return F.when((x0 + x1) / 2 < gap, "left").otherwise("right")


def asset_side(x0: Column, x1: Column, gap: Column) -> Column:
    return F.when(x1 <= gap + 5, "left").when(x0 >= gap - 5, "right").otherwise("span")


def bin_index(x: Column, width: Column) -> Column:
    return F.least(F.greatest((x / width * BINS).cast("int"), F.lit(0)), F.lit(BINS - 1))


def lines(words: DataFrame) -> DataFrame:
    """One row per page and line: its words in x order joined (no blank where they touch), its edges and its number."""
    keyed = words.withColumn("line", line_key(F.col("top")))
    boxes = F.array_sort(F.collect_list(F.struct("x0", "word_no", "x1", "text")))  # the words of one line
    joined = F.aggregate("boxes", F.struct(F.lit("").alias("t"), F.lit(None).cast("double").alias("e")), lambda a, b: F.struct(F.concat(a["t"], F.when(a["e"].isNull() | (b["x0"] - a["e"] < 1.0), "").otherwise(" "), b["text"]).alias("t"), b["x1"].alias("e")), lambda a: a["t"])
    grouped = keyed.groupBy(*PAGE, "line").agg(boxes.alias("boxes"), F.min("top").alias("top"), F.max("bottom").alias("bottom"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.count("*").alias("n_words"))
    return grouped.withColumn("text", joined).drop("boxes")


def group_lines(words: DataFrame) -> DataFrame:
    """doc_id, page_num, word_no, line_no: lines by key, with words that continue the line just above (raised or lowered text) moved into it."""

    def grouped(page: pd.DataFrame) -> list[tuple]:
        merged: list[tuple[float, list]] = []
        for k, group in page.groupby("k", sort=True):
            boxes = list(group.itertuples())
            if merged and k - merged[-1][0] < MERGE_PT:
                last = merged[-1][1]
                near = [b for b in boxes if any(-1.0 <= b.x0 - p.x1 <= 1.5 for p in last)]
                rest = [b for b in boxes if b not in near]
                last.extend(near)
                if rest:
                    merged.append((k, rest))
            else:
                merged.append((k, boxes))
        return [(b.doc_id, b.page_num, b.word_no, n) for n, (_, boxes) in enumerate(merged) for b in boxes]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None  # the page whose words may go on in the next batch
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            if b.empty:
                continue
            first = (b[PAGE] == b[PAGE].iloc[-1]).all(axis=1).idxmax()
            held = b.iloc[first:]
            rows = [r for _, page in b.iloc[:first].groupby(PAGE, sort=False) for r in grouped(page)]
            yield pd.DataFrame(rows, columns=[*PAGE, "word_no", "line_no"])
        if held is not None:
            yield pd.DataFrame(grouped(held), columns=[*PAGE, "word_no", "line_no"])

    # the words of a page lie together in one partition, so that a batch serves many pages
    keyed = words.select(*PAGE, "word_no", "x0", "x1", line_key(F.col("top")).alias("k")).repartition(*PAGE).sortWithinPartitions(*PAGE, "k", "x0", "word_no")
    return keyed.mapInPandas(run, "doc_id long, page_num int, word_no int, line_no int")


def line_coverage(words: DataFrame, width: float) -> DataFrame:
    """doc_id, page_num, bin, n_cover, n_lines: the lines that cover each x bin of a page."""
    w = F.lit(width)
    # one shuffle by page serves the lines, the bins and the join; bins are made distinct inside each line
    keyed = words.select(*PAGE, line_key(F.col("top")).alias("line"), F.sequence(bin_index(F.col("x0"), w), bin_index(F.col("x1"), w)).alias("bins")).repartition(*PAGE)
    lines = keyed.groupBy(*PAGE, "line").agg(F.array_distinct(F.flatten(F.collect_list("bins"))).alias("bins"))  # the words of one line
    cover = lines.select(*PAGE, F.explode("bins").alias("bin")).groupBy(*PAGE, "bin").agg(F.count("*").alias("n_cover"))
    total = lines.groupBy(*PAGE).agg(F.count("*").alias("n_lines"))
    return cover.join(total, PAGE)


def with_value(rows: DataFrame, pages: DataFrame, value: str, how: str = "left") -> DataFrame:
    """``rows`` (doc_id, page_num, ...) with the ``value`` that ``pages`` has for their page, once at most; ``inner``: those that have one only.

    Rows that are partitioned by document stay where they are, unsorted: each document's values are joined as one map.
    """
    there = pages.filter(F.col("doc_id").isNotNull() & F.col("page_num").isNotNull() & F.col(value).isNotNull())
    held = there.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("page_num", value))).alias("_values"))  # the pages of one document
    joined = rows.join(held.hint("shuffle_hash"), "doc_id", how).withColumn(value, F.try_element_at("_values", F.col("page_num"))).drop("_values")
    return joined.filter(F.col(value).isNotNull()) if how == "inner" else joined


def _line_masks(words: DataFrame, width: float) -> DataFrame:
    """doc_id, page_num, line, m0 to m3: the x bins that a line covers, ``MASK`` of them as the lowest bits of each number."""
    ends = [bin_index(F.col(x), F.lit(width)) for x in ("x0", "x1")]
    there = F.col("x0").isNotNull() & F.col("x1").isNotNull()  # a box without edges covers nothing
    keyed = words.select(*PAGE, line_key(F.col("top")).alias("line"), F.when(there, F.least(*ends)).alias("low"), F.when(there, F.greatest(*ends) + 1).alias("high"))
    below = lambda c, k: f"shiftleft(1L, greatest(least({c} - {k * MASK}, {MASK}), 0))"
    return keyed.groupBy(*PAGE, "line").agg(*[F.coalesce(F.bit_or(F.expr(f"{below('high', k)} - {below('low', k)}")), F.lit(0).cast("long")).alias(f"m{k}") for k in range(BINS // MASK)])


def _gap_runs(covered: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run_start, run_len) of each page, from the number of its lines that cover each bin; run_len is 0 where no bin is thin."""
    middle = covered[:, GAP_FROM : GAP_TO + 1]
    side_mean = (covered.sum(axis=1) - middle.sum(axis=1)) / (n_lines * (BINS - middle.shape[1]))
    thin = (middle / n_lines[:, None] < np.minimum(0.25, side_mean * 0.30)[:, None]) & (side_mean > 0.10)[:, None]
    run, best, end = (np.zeros(len(thin), np.int64) for _ in range(3))
    for k in range(thin.shape[1]):
        run = np.where(thin[:, k], run + 1, 0)
        longer = run > best  # the first of the longest ones stays
        best, end = np.where(longer, run, best), np.where(longer, k + 1, end)
    return GAP_FROM + end - best, best


def _runs_of_masks(lines: pa.Array) -> pa.Array:
    """The run of each page's lists of line masks."""
    starts, lengths = [], []
    for at in range(0, len(lines), 1000):  # so many pages of bits in memory
        part = lines.slice(at, 1000)
        n_lines = part.value_lengths().to_numpy()
        masks = np.stack([f.to_numpy() for f in part.flatten().flatten()], axis=1)
        bits = np.unpackbits(np.ascontiguousarray(masks).view(np.uint8), axis=1, bitorder="little").reshape(len(masks), -1, 64)[:, :, :MASK]
        start, length = _gap_runs(np.add.reduceat(bits.reshape(len(masks), BINS), np.cumsum(n_lines) - n_lines, axis=0, dtype=np.int64), n_lines)
        starts.append(start)
        lengths.append(length)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(starts) if starts else [], pa.int32()), pa.array(np.concatenate(lengths) if lengths else [], pa.int64())], names=["run_start", "run_len"])


def column_gap(words: DataFrame, width: float) -> DataFrame:
    """doc_id, page_num, run_start, run_len, gap_x: the first longest run of thin bins in the middle of each page that has one of three bins or more.

    A bin is thin below min(.25, .30 x the mean coverage at the sides); pages with a side mean of .10 or less are left out.
    """
    lines = _line_masks(words.filter(F.col("doc_id").isNotNull() & F.col("page_num").isNotNull()), width)
    pages = lines.groupBy(*PAGE).agg(F.collect_list(F.struct(*[f"m{k}" for k in range(BINS // MASK)])).alias("masks"))  # the lines of one page
    runs = F.arrow_udf(_runs_of_masks, "struct<run_start: int, run_len: long>")
    first = pages.select(*PAGE, F.inline(F.array(runs("masks")))).filter("run_len >= 3")  # a generator keeps it from being run for each use
    return first.select(*PAGE, "run_start", "run_len", ((F.col("run_start") * 2 + F.col("run_len")) / 2 / BINS * width).alias("gap_x"))


def page_columns(pages: list[list], width: float, height: float) -> list[tuple[float | None, float | None]]:
    """(gap_x, body_y) of each page's boxes, by the rules of ``column_gap`` and ``body_start``, for pages that are at hand."""
    sizes = [len(p) for p in pages]
    x0, x1, top = (np.array([getattr(b, c) for p in pages for b in p], np.float64) for c in ("x0", "x1", "top"))
    page = np.repeat(np.arange(len(pages)), sizes)
    key = np.rint(top / LINE_PT) * LINE_PT
    found = [(None, None)] * len(pages)
    if not len(page):
        return found
    order = np.lexsort((key, page))
    fresh = np.concatenate(([True], (np.diff(page[order]) != 0) | (np.diff(key[order]) != 0)))
    line = np.empty(len(page), np.int64)
    line[order] = np.cumsum(fresh) - 1
    line_page, line_key = page[order][fresh], key[order][fresh]
    ends = np.sort(np.clip(np.trunc(np.stack((x0, x1)) / width * BINS), 0, BINS - 1).astype(np.int64), axis=0)
    edges = np.zeros((len(line_key), BINS + 1), np.int32)
    np.add.at(edges, (line, ends[0]), 1)
    np.add.at(edges, (line, ends[1] + 1), -1)
    bits = np.cumsum(edges[:, :BINS], axis=1) > 0
    first = np.flatnonzero(np.concatenate(([True], np.diff(line_page) != 0)))
    run_start, run_len = _gap_runs(np.add.reduceat(bits, first, axis=0, dtype=np.int64), np.diff(np.append(first, len(line_page))))
    gap = np.full(len(pages), np.nan)
    gap[line_page[first]] = np.where(run_len >= 3, (run_start * 2 + run_len) / 2 / BINS * width, np.nan)
    left = (x0 + x1) / 2 < gap[page]
    n_left, n_right = (np.bincount(line, x, len(line_key)) for x in (left, ~left))
    lines = zip(line_page.tolist(), line_key.tolist(), ((n_left >= 2) & (n_right >= 2)).tolist())
    for n, rows in groupby(lines, key=itemgetter(0)):
        if not np.isnan(gap[n]):
            found[n] = float(gap[n]), _body_start([r[1:] for r in rows], height)
    return found


def _body_start(lines: list[tuple[float, bool]], height: float) -> float | None:
    """The first of three (key, two words on each side) in a row, as ``body_start`` finds it."""
    run, begin, last = 0, None, None
    for key, ok in lines:
        if key >= height * 0.1:
            run = 0 if not ok else run + 1 if run and key - last <= 30 else 1
            begin, last = key if run == 1 else begin, key
            if run == 3:
                return begin
    return None


def layout_vote(gaps: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, n_pages, n_multi, layout_type over the first five pages of ``pages`` (doc_id, page_num, n_words, n_lines) with enough words and lines."""
    fit = pages.filter((F.col("page_num") < 5) & (F.col("n_words") >= 6) & (F.col("n_lines") >= 10))
    flagged = fit.join(gaps.select(*PAGE, F.lit(1).alias("multi")), PAGE, "left")
    votes = flagged.groupBy("doc_id").agg(F.count("*").alias("n_pages"), F.sum(F.coalesce("multi", F.lit(0))).alias("n_multi"))
    need = F.greatest(F.lit(1), F.expr("n_pages * 2 div 3"))
    return votes.withColumn("layout_type", F.when(F.col("n_multi") >= need, "MULTI_COLUMN").otherwise("SINGLE_COLUMN"))


def line_gaps(page_lines: DataFrame) -> DataFrame:
    """``page_lines`` with gap: the distance to the next line of the page, null for the last."""
    w = W.partitionBy(*PAGE).orderBy("line")
    below = F.lead("top").over(w)
    return page_lines.withColumn("gap", F.when(below.isNotNull(), F.greatest(below - F.col("bottom"), F.lit(0.0))))


def upper_median(values: Column) -> Column:
    """The element at n // 2 of the sorted array of values."""
    return F.element_at(F.array_sort(values), F.expr("1") + (F.size(values) / 2).cast("int"))


def paragraph_text(page_lines: DataFrame) -> DataFrame:
    """doc_id, page_num, text: lines joined with one, two or three line ends by the size of the gap between them."""
    gaps = line_gaps(page_lines)
    mid = gaps.filter("gap > 0").groupBy(*PAGE).agg(upper_median(F.collect_list("gap")).alias("g"))  # the gaps of one page
    para, wide = F.greatest(F.col("g") * 1.35, F.col("g") + 1), None
    wide = F.greatest(F.col("g") * 2.1, para + 3)
    end = F.when(F.col("gap").isNull(), "").when(F.col("g").isNull(), "\n").when(F.col("gap") >= wide, "\n\n\n").when(F.col("gap") >= para, "\n\n").otherwise("\n")
    ordered = F.array_sort(F.collect_list(F.struct("line", F.concat("text", end).alias("t"))))  # the lines of one page
    return gaps.join(mid, PAGE, "left").groupBy(*PAGE).agg(ordered.alias("parts")).select(*PAGE, F.array_join(F.transform("parts", lambda p: p["t"]), "").alias("text"))


def two_sided(words: DataFrame, gaps: DataFrame) -> DataFrame:
    """doc_id, page_num, line, n_left, n_right, both: the words of each line on the sides of the page's gap."""
    sided = with_value(words, gaps, "gap_x", "inner").withColumn("left", (F.col("x0") + F.col("x1")) / 2 < F.col("gap_x"))
    return sided.groupBy(*PAGE, line_key(F.col("top")).alias("line")).agg(F.count_if("left").alias("n_left"), F.count_if(~F.col("left")).alias("n_right")).withColumn("both", (F.col("n_left") > 0) & (F.col("n_right") > 0))


def body_start(sides: DataFrame, height: float) -> DataFrame:
    """doc_id, page_num, body_y: the first of three lines in a row with two words on each side, below the top tenth; a jump of more than 30 points begins anew."""
    w = W.partitionBy(*PAGE).orderBy("line")
    below = sides.filter(F.col("line") >= height * 0.1).withColumn("ok", (F.col("n_left") >= 2) & (F.col("n_right") >= 2))
    last_ok, last_line = F.lag("ok").over(w), F.lag("line").over(w)
    begun = below.withColumn("fresh", (~F.col("ok")) | last_ok.isNull() | ~last_ok | (F.col("line") - last_line > 30))
    islands = begun.withColumn("island", F.sum(F.col("fresh").cast("int")).over(w)).filter("ok")
    return islands.groupBy(*PAGE, "island").agg(F.min("line").alias("body_y"), F.count("*").alias("n")).filter("n >= 3").groupBy(*PAGE).agg(F.min("body_y").alias("body_y"))


def footnote_start(page_lines: DataFrame, height: float) -> DataFrame:
    """doc_id, page_num, foot_y: the first line in the lower half after a jump of more than 35 points."""
    w = W.partitionBy(*PAGE).orderBy("line")
    jump = page_lines.withColumn("jump", F.col("line") - F.lag("line").over(w))
    return jump.filter((F.col("line") > height * 0.5) & (F.col("jump") > 35)).groupBy(*PAGE).agg(F.min("line").alias("foot_y"))


def overlap(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Area shared by two boxes over the area of the first; 0 if that is empty."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    area = (a[2] - a[0]) * (a[3] - a[1])
    return F.when(area > 0, w * h / area).otherwise(0.0)


def words_not_in_assets(words: DataFrame, assets: DataFrame) -> DataFrame:
    """The words whose centre lies in no asset box (two points of margin) of their page."""
    x, y = (F.col("w.x0") + F.col("w.x1")) / 2, (F.col("w.top") + F.col("w.bottom")) / 2
    on = (F.col("w.doc_id") == F.col("a.document_id")) & (F.col("w.page_num") == F.col("a.page_num")) & x.between(F.col("a.bbox_x0") - 2, F.col("a.bbox_x1") + 2) & y.between(F.col("a.bbox_y0") - 2, F.col("a.bbox_y1") + 2)
    return words.alias("w").join(assets.alias("a"), on, "left_anti")


def figures_not_in_tables(figures: DataFrame, tables: DataFrame, share: float = 0.4) -> DataFrame:
    """The figures that lie in no table of their page by more than ``share`` of their area."""
    box = lambda n: tuple(F.col(f"{n}.bbox_{c}") for c in ("x0", "y0", "x1", "y1"))
    on = (F.col("f.document_id") == F.col("t.document_id")) & (F.col("f.page_num") == F.col("t.page_num")) & (overlap(box("f"), box("t")) > share)
    return figures.alias("f").join(tables.alias("t"), on, "left_anti")


def asset_zones(assets: DataFrame) -> DataFrame:
    """document_id, page_num, zone_no, y_from, y_to: the bands above, between and below the assets of a page, in order."""
    w = W.partitionBy("document_id", "page_num").orderBy("bbox_y0", "id")
    above = assets.select("document_id", "page_num", (F.row_number().over(w) - 1).alias("zone_no"), F.coalesce(F.lag("bbox_y1").over(w), F.lit(0.0)).alias("y_from"), (F.col("bbox_y0") - 2).alias("y_to"))
    last = assets.withColumn("r", F.row_number().over(W.partitionBy("document_id", "page_num").orderBy(F.desc("bbox_y0"), F.desc("id")))).filter("r = 1")
    n = assets.groupBy("document_id", "page_num").agg(F.count("*").alias("zone_no"))
    below = last.join(n, ["document_id", "page_num"]).select("document_id", "page_num", F.col("zone_no").cast("int").alias("zone_no"), F.col("bbox_y1").alias("y_from"), F.lit(float("inf")).alias("y_to"))
    return above.unionByName(below)
