from helpers import plain, write_tables
from quirefold.llm import scans
from quirefold.llm.queries import QUERIES
from quirefold.llm.scans import Page, Reader, is_page_number, is_running_header, readings, slug_of

CLEAN = "The portable sensor improves the reading. A cross-sectional estimate follows the harbour measurement. " * 5 + "측정값을 계측기를 " * 5


def test_page_numbers():
    for line in ("3", "p. 4", "- 1 -", "– 12 –", "Page 2 of 9", "PAGE 3", "pg 7", "2 / 7", "[5]", "3 쪽", " 8 \r"):
        assert is_page_number(line), line
    for line in ("", "1999 was", "[FIGURE_001]", "3.5 The sensor", "p.", "12345 67890", "Figure 3."):
        assert not is_page_number(line), line


def test_running_headers():
    title = "The linear sensor and the threshold of Kivolis"
    for line in (title, "3   " + title, title.upper() + "   12", "The linear sensor and ...", "The 1inear sens0r and the thresh0ld of Kivolis", "The linear sensor and the\r"):
        assert is_running_header(line, title, None), line
    for line in ("2.1 The linear sensor and the threshold of Kivolis", "The linear", "The sensor", title + " (reprint)", "Other title of a thing"):
        assert not is_running_header(line, title, None), line
    slug = slug_of("the_linear_sensor_and_the.PDF")
    assert is_running_header(title, None, slug) and not is_running_header("The linear harbour and the sea", None, slug)


def test_readings_hold_the_printed_word():
    for read, printed in (("f1ltre", "filtre"), ("tiinnel", "tunnel"), ("measurernent", "measurement"), ("보정올", "보정을"), ("6oundary", "boundary"), ("c0nsistcnt", "consistent"), ("procluced", "produced"), ("s6rie", "série")):
        assert printed in {x for x, *_ in readings(read)}, read


def test_viterbi_takes_the_pair_that_the_corpus_has():
    rows = [("fan", "tan", 0.01, 50, 0, False), ("fan", "fau", 0.01, 50, 0, False)]
    reader = Reader(rows, {("sun", "tan"): 40})
    assert reader.decode(["sun", "fan"]) == ["sun", "tan"]
    assert reader.contested() == {"tan", "fau"}


def test_breaks_pass_over_noise():
    page = Page("a sen-\n3\nsor works\nnext li¬\nne and un-\n", None, None)
    assert [(k, a, b) for k, a, b, _ in page.breaks] == [(0, "sen", "sor"), (3, "li", "ne")]
    assert Reader([]).repair(page) == "a sensor works next line and un-"


def test_query(spark, tmp_path):
    docs = [{"doc_id": 1, "text": CLEAN, "source_type": "SCANNED", "file_name": "the_linear_sensor.pdf"}, {"doc_id": 2, "text": CLEAN}]
    body = "The linear sensor of Kivolis\nThe portab1e sensor im-\np. 3\nproves the rea-\nding. A cross-\nsectional estimate follows the\nharbour rneasurement.\r\n측정값올 보인다.\nUnknovvnword stays."
    pages = [{"id": 5, "document_id": 1, "page_num": 0, "body_text": body}]
    assets = [{"id": 6, "document_id": 1, "ocr_text": "reading | 18.O4 | 9l.33 | 44\nharb0ur  59.S"}]
    meta = [{"id": 1, "document_id": 1, "title": "The linear sensor of Kivolis"}]
    folder = write_tables(spark, tmp_path, clash=True, documents=docs, page_contents=pages * 2, document_assets=assets, document_metadata=meta)
    p, a = ("page_contents", 5), ("document_assets", 6)
    assert plain(QUERIES["p1_found"](spark, folder).collect()) == sorted([
        (*p, "hyphenation", "improves"), (*p, "hyphenation", "reading"), (*p, "hyphenation", "cross-sectional"), (*p, "misread", "portable"), (*p, "misread", "measurement"),
        (*p, "misread", "측정값을"), (*p, "running_header", "0"), (*p, "page_number", "2"), (*a, "misread", "18.04"), (*a, "misread", "91.33"), (*a, "misread", "harbour"), (*a, "misread", "59.5"),
    ])
    text = {r.row_id: r.text for r in QUERIES["p1_repaired"](spark, folder).collect()}[5]
    assert text.startswith("The portable sensor improves the reading. A cross-sectional estimate follows the harbour measurement. 측정값을 보인다.")


def test_a_long_lexicon_gives_the_same_rows(spark, tmp_path, monkeypatch):
    near = "The sun tan oil. A sun tan oil. The fau oil. A fau oil. The harbour and the linear sensor and 1l and 1l. " * 3
    docs = [{"doc_id": 1, "text": CLEAN + near, "file_name": "the_linear_sensor.pdf"}, {"doc_id": 2, "text": CLEAN + near}]
    body = "The portab1e sun fan oil im-\np. 3\nproves the rea-\nding of cross-\nsectional rneas-\nurernent and the\nharb0ur 1l 18.O4 sens0r.\n\nA c1oss-\nsecti0nal fau oil and meas-\nurement."
    pages = [{"id": 5, "document_id": 1, "page_num": 0, "body_text": body}, {"id": None, "document_id": 2, "page_num": 0, "body_text": body}]
    assets = [{"id": 6, "document_id": 1, "ocr_text": "reading 18.O4 9l.33 1l harb0ur 59.S"}]
    folder = write_tables(spark, tmp_path, clash=True, documents=docs, page_contents=pages * 2, document_assets=assets)
    rows = lambda name: sorted(map(str, QUERIES[name](spark, folder).collect()))
    sent = [rows(name) for name in ("p1_found", "p1_repaired")]
    assert any("cross-sectional" in r for r in sent[0]) and any("measurement" in r for r in sent[0])
    for size in (3, 0):
        monkeypatch.setattr(scans, "LEXICON", size)
        assert [rows(name) for name in ("p1_found", "p1_repaired")] == sent


def test_a_pair_seen_once_decides(spark, tmp_path, monkeypatch):
    clean = "A red dam. The blue elam. " + "Dam. Elam. " * 10
    docs = [{"doc_id": 1, "text": clean, "file_name": "the_linear_sensor.pdf"}]
    pages = [{"id": k, "document_id": 1, "page_num": k, "body_text": f"{colour} clam"} for k, colour in enumerate(("red", "blue"))]
    folder = write_tables(spark, tmp_path, documents=docs, page_contents=pages)
    right = [("page_contents", 0, "misread", "dam"), ("page_contents", 1, "misread", "elam")]
    assert plain(QUERIES["p1_found"](spark, folder).collect()) == right
    monkeypatch.setattr(scans, "PAIRS", 0)
    assert plain(QUERIES["p1_found"](spark, folder).collect()) == right


def test_long_words_and_long_lines():
    long = "x" * 40 + "f1ltre" + "y" * 40
    assert "x" * 40 + "filtre" + "y" * 40 in {x for x, *_ in readings(long)}
    assert len(readings("l" * 3000)) <= 3 * 3000  # more places than a word has: one misreading only
    assert is_page_number("-" * 300 + " 12 " + "-" * 300) and not is_page_number(" " * 20000 + "1 x")
    title = "The linear sensor and the threshold of Kivolis " * 12
    assert is_running_header(title.strip(), title, None)


def test_confusion_rates_follow_the_scans(spark):
    """A confusion that the scans show often gets a higher probability; their mean stays."""
    counts = spark.createDataFrame([("tone", 100, 400, False), ("hat", 100, 400, False), ("tonc", 0, 90, False), ("bat", 0, 1, False)], "word string, clean long, dirty long, asked boolean")
    likely = spark.createDataFrame([("tonc", "tone", 0, -1, 500, 0, 90), ("bat", "hat", 10, -1, 500, 0, 1)], "word string, printed string, first int, second int, n long, own long, dirty long")
    rates = scans.confusion_rates(counts, likely)
    assert scans.CONFUSIONS[0] == ("c", "e") and scans.CONFUSIONS[10] == ("b", "h")
    assert rates[0] > 3 * rates[10] and len(rates) == len(scans.CONFUSIONS)
    assert all(scans.PRIOR * scans.BOUNDS[0] <= r <= scans.PRIOR * scans.BOUNDS[1] for r in rates)
    assert scans.confusion_rates(counts.limit(0), likely.limit(0)) == [scans.PRIOR] * len(scans.CONFUSIONS)


def test_two_misreadings_in_words_of_any_length(spark):
    """A word with more places than ``PLACES`` gets its candidates too, the same ones that listing all of them would give."""
    printed = "illicit" * 30 + "zebra"
    read = printed.replace("l", "1", 1).replace("ze", "zc")
    assert scans.is_crowded(read)
    texts = spark.createDataFrame([(f"{printed} a", True, False)] * 3 + [(f"{read} b", False, True)], "text string, clean boolean, scanned boolean")
    rows = [r for r in scans.lexicon(texts).collect() if r.word == read]
    assert [r.printed for r in rows] == [printed]
    for word in ("clin1e", "rnorn", "vvii1", "1lcl"):
        for x, *numbers in scans.readings(word):
            assert scans.reading(word, x) == tuple(numbers), (word, x)
        assert scans.reading(word, word) is None and scans.reading(word, "other") is None
