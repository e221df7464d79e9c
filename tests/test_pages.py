import random

import numpy as np
import pandas as pd
import pytest
from quirefold.operators import images, layout
from pyspark.sql import functions as F
from quirefold.functions import columns as C
from quirefold.operators.pages import Asset, Box, academic_header, caption_refs, compose_pages, inject_scanned, join_zones, page_text_with_assets, to_lines, to_paragraphs


def line(text, top, x=50.0):
    out = []
    for w in text.split():
        out.append(Box(w, x, x + 6 * len(w), float(top), top + 10.0))
        x += 6 * len(w) + 5
    return out


def test_paragraph_gaps():
    boxes = line("Line1", 100) + line("more", 114) + line("Para2", 160) + line("next", 174)
    assert to_paragraphs(boxes) == "Line1\nmore\n\n\nPara2\nnext"
    assert to_paragraphs([]) == ""


def test_raised_words_join_their_line():
    base = line("mass", 100)
    raised = [Box("2", base[-1].x1 + 0.5, base[-1].x1 + 5, 106.0, 112.0)]
    assert [x.text() for x in to_lines(base + raised)] == ["mass2"]
    assert len(to_lines(base + [Box("far", 400.0, 420.0, 106.0, 112.0)])) == 2


def test_columns(spark):
    cases = [
        ("The end is", "near the sea.\n\nNew part.", "The end is near the sea.\n\nNew part."),
        ("A bro-", "ken word.", "A broken word."),
        ("Done.", "next one", "Done.\n\nnext one"),
        ("as shown in the", "Figure 1. A map\n\nMap of it.", "as shown in the Map of it.\n\nFigure 1. A map"),
        ("the memory", "(HBM3) is fast", "the memory (HBM3) is fast"),
        ("", "only", "only"), ("only ", " ", "only"), ("", "", ""),
        ("First.\n\nit goes", "on and on", "First.\n\nit goes on and on"),
        ("it ends", "Figure 1. A map", "it ends\n\nFigure 1. A map"),
    ]
    df = spark.createDataFrame(cases, "l string, r string, want string")
    assert [(r.l, r.got) for r in df.select("l", "want", C.join_columns(F.col("l"), F.col("r")).alias("got")).collect() if r.got != r.want] == []
    cases = [
        ("Words that\n\nTable 2. Sizes", "[FIGURE_000]\n\ngo on.", "Words that go on.\n\nTable 2. Sizes\n\n[FIGURE_000]"),
        ("Words that", "go on.", "Words that go on."), ("Table 1. x", "Figure 2. y", "Table 1. x\n\nFigure 2. y"), ("", "cut…", "cut…"),
        ("One.", "[TABLE_001]\n\nTwo.", "One.\n\n[TABLE_001]\n\nTwo."),
    ]
    df = spark.createDataFrame(cases, "l string, r string, want string")
    assert [(r.l, r.got) for r in df.select("l", "want", C.join_columns_captions(F.col("l"), F.col("r")).alias("got")).collect() if r.got != r.want] == []


def composed(spark, boxes, gap, start, **more):
    """A page of boxes through the composition of pages."""
    rows = [(1, 0, k, b.text, b.x0, b.x1, b.top, b.bottom) for k, b in enumerate(boxes)]
    words = spark.createDataFrame(rows, "doc_id long, page_num int, word_no int, text string, x0 double, x1 double, top double, bottom double")
    gaps = spark.createDataFrame([(1, 0, gap)] if gap else [], "doc_id long, page_num int, gap_x double")
    starts = spark.createDataFrame([(1, 0, start)] if start else [], "doc_id long, page_num int, body_y double")
    return compose_pages(words, gaps, starts, height=800.0, **more).first().text


def test_two_columns_read_left_first(spark):
    boxes = line("Wide title over the whole page here", 40, 150.0)
    for k in range(4):
        boxes += line(f"left{k} left word", 100 + 14 * k) + line(f"right{k} right word", 100 + 14 * k, 350.0)
    text = composed(spark, boxes, 310.0, 99.0)
    assert text.index("Wide") < text.index("left3") < text.index("right0")
    for text in (composed(spark, boxes, 310.0, None), composed(spark, boxes, 310.0, 99.0, captions=True)):
        assert text.index("left3") < text.index("right0")
    assert composed(spark, line("One column", 40), None, None) == "One column"


def test_footnotes_of_the_left_column_come_last(spark):
    boxes = line("left text goes", 410) + line("right text goes", 410, 350.0) + line("on here", 424, 350.0) + line("1 a note", 600)
    assert composed(spark, boxes, 310.0, 400.0) == "left text goes\n\nright text goes\non here\n\n1 a note" or composed(spark, boxes, 310.0, 400.0).endswith("on here\n\n1 a note")
    assert composed(spark, boxes, 310.0, 400.0, captions=True).index("1 a note") < composed(spark, boxes, 310.0, 400.0, captions=True).index("right")


def test_assets_in_pages():
    boxes = line("Above the", 100) + line("inside", 205) + line("picture it goes on.", 300) + line("beside", 240, 500.0)
    text = page_text_with_assets(boxes, [Asset("[FIGURE_000]", 40.0, 200.0, 200.0, 280.0)])
    assert text == "Above the [FIGURE_000] picture it goes on."  # what lies beside the asset is in no band
    assert page_text_with_assets([], [Asset("[B]", 0, 50, 1, 60), Asset("[A]", 0, 10, 1, 20)]) == "[A]\n[B]"
    assert join_zones([("text", "One."), ("asset", "[T]"), ("text", "Two")]) == "One.\n\n[T]\n\nTwo"
    assert join_zones([]) == ""


def test_tags():
    assert inject_scanned("Text.\nFigure 1. A map\nmore", [("[FIGURE_000]", "FIGURE", 10.0, 800.0)]) == "Text.\nFigure 1. A map [FIGURE_000]\nmore"
    assert inject_scanned("", [("[B]", "TABLE", 9.0, 10.0), ("[A]", "TABLE", 1.0, 10.0)]) == "[A]\n[B]"
    texts, found = caption_refs(["One.\nTable 3: x\nTwo.", "a half\nFigure 2. y\nsentence."], 4, 0)
    assert texts == ["One.\n[TABLE_000]\nTwo.", "a half sentence. [FIGURE_004]"]
    assert found == [(0, "TABLE", 0, "Table 3: x"), (1, "FIGURE", 4, "Figure 2. y")]
    assert caption_refs(["[TABLE_001]\nTable 1. x"], 0, 0)[0] == ["[TABLE_001]\nTable 1. x"]


def test_header_of_a_paper():
    chars = [("T", 20.0, 50.0, 10.0), ("i", 20.0, 50.0, 20.0)] + [("A", 12.0, 90.0, 10.0)] + [("b", 10.0, 200.0 + k, 10.0) for k in range(30)]
    assert academic_header(chars, 800.0)["title"] == "Ti" and academic_header([], 1.0)["title"] == ""


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_group_lines_in_spark_equals_the_page_function(spark, batch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    random.seed(2)
    rows = [(d, p, k, f"w{k}", float(random.randrange(0, 500)), 0.0, float(random.randrange(0, 300)), 0.0) for d in range(3) for p in range(2) for k in range(60)]
    rows = [(d, p, k, t, x0, x0 + 20, top, top + 10) for d, p, k, t, x0, _, top, _ in rows]
    words = spark.createDataFrame(rows, "doc_id long, page_num int, word_no int, text string, x0 double, x1 double, top double, bottom double")
    got = {(r.doc_id, r.page_num, r.word_no): r.line_no for r in layout.group_lines(words).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for d in range(3):
        for p in range(2):
            boxes = {k: Box(t, x0, x1, top, bottom) for dd, pp, k, t, x0, x1, top, bottom in rows if (dd, pp) == (d, p)}
            want = {id(b): n for n, x in enumerate(to_lines(list(boxes.values()))) for b in x.boxes}
            assert {k: got[d, p, k] for k in boxes} == {k: want[id(b)] for k, b in boxes.items()}


def test_image_kernels():
    blank = np.full((600, 800), 255, np.uint8)
    bars = blank.copy()
    bars[50:550, 30:260] = 0
    bars[50:550, 540:770] = 0
    assert not images.is_multi_column(blank) and images.split_column(blank) is None and images.horizontal_rules(blank) == 0
    assert images.is_multi_column(bars) and 260 <= images.split_column(bars) <= 540
    strokes = np.full((400, 600), 255, np.uint8)
    for y in (100, 200, 300):
        strokes[y : y + 2, 100:400] = 0
    assert images.horizontal_rules(strokes) == 3
    assert images.formula_mask(strokes)[100, 200] and not images.formula_mask(strokes)[399, 10]
    assert images.mask_or(np.array([True, False]), np.array([False, False])).tolist() == [True, False]
    assert images.crop(bars, 10, 20, 30, 50).shape == (30, 20)
    assert images.render(pd.DataFrame({"x0": [0.0], "x1": [50.0], "top": [0.0], "bottom": [10.0]}), 100, 100, 1.0)[5, 10] == 20


def test_viewer_tools(spark):
    from quirefold.operators import viewer as V

    def one(c):
        return spark.range(1).select(c).first()[0]

    assert one(C.strip_captions(F.lit("A sentence is\nFigure 1. A map\ngoing on."))) == "A sentence is going on."
    assert one(C.strip_captions(F.lit("Done.\nTable 2: x\nNext"))) == "Done.\nNext"
    assert one(C.paragraphs_reflow(F.lit("a bro-\nken\nline\n\n\nnext"))) == "a broken line\n\nnext"
    assert one(C.wrap(F.lit("aa bb cc dddddddd"), 5)) == "aa bb\ncc\nddddd\nddd" and one(C.wrap(F.lit(""))) == ""
    assert one(C.align_rows(F.array(*map(F.lit, ["a b", "", "c d"])), F.array(*map(F.lit, "wxyz!")))) == ["w x", "", "y z !"]
    table = one(C.markdown_table([F.array(F.lit("a|b"), F.lit("c")), F.array(F.lit("d"))], ["x", "y"]))
    assert V.parse_markdown(table) == [["x", "y"], ["a|b", "d"], ["c", ""]]
    df = spark.createDataFrame([(1, "A", b"x"), (2, "?", b"y"), (3, "A", b"bad")], "doc_id long, strategy string, content binary")

    def engine(content):
        if content == b"bad":
            raise ValueError("no")
        return content.decode().upper()

    rows = V.extract_by_strategy(df, {"A": engine, "B": lambda c: "b"}, "B").collect()
    assert {r.doc_id: (r.text, r.error is None) for r in rows} == {1: ("X", True), 2: ("b", True), 3: ("", False)}
    config = V.Config.load({"inbox": "in", "junk": 1}, {"QUIREFOLD_ATTEMPTS": "5"})
    assert config.inbox == "in" and config.attempts == 5 and config.problems() == ["workspace is not set"]
