import pytest
from pyspark.sql import functions as F
from quirefold.functions import reflow as R
from quirefold.functions import text as T

LONG = "This sentence is long enough that its line was broken by the page"
CASES = [
    # soft breaks join: long lines, lower case or an opening mark after the break, many words
    (f"{LONG}\nwidth and not by the writer.", f"{LONG} width and not by the writer."),
    ("Short line\nwhich goes on", "Short line which goes on"),
    ("Short line\n(in brackets)", "Short line (in brackets)"),
    ("one two three four five six\nSeven eight nine", "one two three four five six Seven eight nine"),
    ("one two three\nSeven eight nine", "one two three\nSeven eight nine"),
    # a hyphen at the end of a line glues, whatever follows
    ("multi-\nline", "multiline"),
    ("Multi-\nLine", "MultiLine"),
    # a finished sentence before a capital or a digit stays alone
    ("It ends here.\nNext one", "It ends here.\nNext one"),
    ('It ends here."\n7 days later', 'It ends here."\n7 days later'),
    ("It ends here.\nand goes on", "It ends here. and goes on"),
    # lists, contents lines and captions keep their lines
    ("- one\n- two", "- one\n- two"),
    ("1) one\n2) two", "1) one\n2) two"),
    ("some words here\n- then a list item", "some words here\n- then a list item"),
    ("a) first\nsecond", "a) first\nsecond"),
    ("2.1 Scope and purpose\n2.2 Terms", "2.1 Scope and purpose\n2.2 Terms"),
    ("Annex A Forms\nAnnex B Tables", "Annex A Forms\nAnnex B Tables"),
    ("Figure 1. A map\nof the place", "Figure 1. A map\nof the place"),
    ("see it in\nTable 2: Sizes", "see it in\nTable 2: Sizes"),
    # a short heading before a clearly longer line stays alone; with closing punctuation it is none
    ("Results\nthe measured values follow the curve of the model well", "Results\nthe measured values follow the curve of the model well"),
    ("Results,\nthe measured values follow the curve of the model well", "Results, the measured values follow the curve of the model well"),
    # a colon before a short line keeps it apart
    ("as follows:\nshort one", "as follows:\nshort one"),
    # runs of empty lines: one or none more than one
    ("One.\n\nTwo.", "One.\n\nTwo."),
    ("One.\n\n\nTwo.", "One.\n\n\nTwo."),
    ("One long line.\n\n\n\n\nTwo.", "One long line.\n\n\nTwo."),
    # blanks, line ends of every kind, lines of stray marks
    ("  two   blanks  \nhere  ", "two blanks here"),
    ("one\r\ntwo\rthree", "one two three"),
    ("one\n@#\ntwo", "one two"),
    ("one\n \ntwo", "one two"),
    ("가나다라 마바사\n아자차", "가나다라 마바사\n아자차"),
    ("", ""), (" \n ", ""), (None, None),
]


@pytest.mark.parametrize("text,want", CASES)
def test_reflow(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(R.reflow(F.col("t"))).first()[0] == want


def test_reflow_of_a_very_long_line(spark):
    assert spark.range(1).select(F.length(R.reflow(F.lit("a " * 20000)))).first()[0] == 39999


def test_joined_text_is_stable(spark):
    """A text whose lines were joined has nothing left to join but what was kept apart."""
    joined = f"{LONG} width.\n\n- one\n- two\n\nFigure 1. A map\n\nResults\nthe measured values follow the curve of the model well"
    assert spark.range(1).select(R.reflow(F.lit(joined))).first()[0] == joined


def test_null_and_cleaning(spark):
    row = spark.createDataFrame([(None, "A\x00b c﻿ multi-\nline\r\n\n\n\n\nEnd", "비교올 하고 기름 값")], "n string, t string, k string").select(R.clean_text(F.col("n")), R.clean_text(F.col("t")), T.josa_fix(F.col("k"))).first()
    assert row[0] is None
    assert row[1] == "Ab c multiline\n\n\nEnd"
    assert row[2] == "비교올 하고 기름 값"


def test_scores(spark):
    got = spark.createDataFrame([("abc 가나",), ("",), ("   ",), ("@@@@",)], "t string").select(T.quality_score(F.col("t"))).collect()
    assert [r[0] for r in got] == [1.0, 0.0, 0.0, 0.0]
    codes = spark.createDataFrame([("안녕하세요 " * 10, "x.pdf"), ("hi", "가.pdf"), ("", "a.pdf"), ("これは文です " * 9 + "word " * 9, "x"), ("1 2 3 4 5 6 7 8 9 0 1 2", "x")], "t string, f string").select(T.detect_langs(F.col("t"), F.col("f"))).collect()
    assert [r[0] for r in codes] == [["kor"], ["kor", "eng"], ["eng"], ["jpn", "eng"], ["eng"]]
