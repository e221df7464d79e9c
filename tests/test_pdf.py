import zlib

import pytest
from quirefold.sources import pdf
from quirefold.sources.pdf import Page, Word

PLAIN = rb"""%PDF-1.4
1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj
2 0 obj << /Type /Pages /Kids [3 0 R 6 0 R] /Count 2 /MediaBox [0 0 612 792] >> endobj
3 0 obj << /Type /Page /Parent 2 0 R /Contents [4 0 R] /Resources << /Font << /F1 5 0 R >> >> >> endobj
4 0 obj << /Length 9 >> stream
BT /F1 12 Tf 14 TL 72 720 Td (Hello \(big\) w\157rld) Tj T* [(A) 120 (B) -300 (C)] TJ 0 -14 Td <6E65787420> Tj (line) ' ET
endstream endobj
5 0 obj << /Type /Font /Subtype /Type1 /BaseFont /Plain /FirstChar 65 /Widths [1000 250] >> endobj
6 0 obj << /Type /Page /Parent 2 0 R /Resources << >> >> endobj
"""


def test_what_is_written_is_read():
    pages = [Page(600.0, 800.0, [Word("Hello", 40.0, 70.0, 60.0, 70.0), Word("세계의🧪", 100.0, 155.0, 60.0, 70.0), Word("(a)\\b<c>", 200.0, 248.0, 74.0, 84.0)]), Page(600.0, 800.0), Page(300.0, 400.0, [Word("end", 1.0, 19.0, 5.0, 15.0)])]
    assert pdf.read_pdf(pdf.make_pdf(pages)) == pages


def test_text_operators_and_fonts():
    first, second = pdf.read_pdf(PLAIN)
    assert [(w.text, w.top) for w in first.words] == [("Hello", 60.0), ("(big)", 60.0), ("world", 60.0), ("AB", 74.0), ("C", 74.0), ("next", 88.0), ("line", 102.0)]
    assert (first.words[3].x0, first.words[3].x1) == (72.0, 72.0 + 12 - 1.44 + 3)  # the widths of the font, moved by the array's number
    assert second.words == [] and (second.width, second.height) == (612.0, 792.0)


def test_objects_in_a_compressed_stream():
    inner = b"1 0 2 34 << /Type /Catalog /Pages 2 0 R >>  << /Type /Pages /Kids [3 0 R] /Count 1 /MediaBox [0 0 100 100] >>"
    at = inner.index(b"<<")
    second = inner.index(b"<<", at + 2)
    head = b"1 0 2 %d " % (second - at)
    data = zlib.compress(head + inner[at:])
    raw = b"%%PDF-1.5\n9 0 obj << /Type /ObjStm /N 2 /First %d /Filter /FlateDecode /Length %d >> stream\n%s\nendstream endobj\n" % (len(head), len(data), data)
    raw += b"3 0 obj << /Type /Page /Contents 4 0 R >> endobj 4 0 obj << >> stream\nBT 10 50 Td (x) Tj ET\nendstream endobj"
    page = pdf.read_pdf(raw)[0]
    assert page.width == 100.0 and [w.text for w in page.words] == ["x"]


@pytest.mark.parametrize("content,error", [(b"", "no PDF"), (b"PK..", "no PDF"), (b"%PDF-1.4 /Encrypt", "encrypted")])
def test_files_that_cannot_be_read(spark, content, error):
    df = spark.createDataFrame([("a", content), ("b", pdf.make_pdf([Page(9.0, 9.0, [Word("w", 1.0, 2.0, 1.0, 2.0)])]))], "path string, content binary")
    rows = {r.path: r for r in pdf.read_words(df).collect()}
    assert error in rows["a"].error and rows["a"].text is None and rows["b"].text == "w"


def test_an_injected_reader(spark):
    df = spark.createDataFrame([("a", b"one two")], "path string, content binary")
    rows = pdf.read_words(df, lambda content: [Page(10.0, 10.0, [Word(t, 0.0, 1.0, 0.0, 1.0) for t in content.decode().split()])]).collect()
    assert [(r.page_num, r.word_no, r.text) for r in rows] == [(0, 0, "one"), (0, 1, "two")]


def test_tables_and_strings_are_shared_by_files():
    """The table of a file's font has 65,536 codes; only those that occur are looked up, once for all files that have it."""
    files = [pdf.make_pdf([Page(600.0, 800.0, [Word(t, 40.0, 70.0, 60.0, 70.0)])]) for t in ("one", "둘🧪", "one")]
    tables = [next(iter(d.fonts.values())).table for d in (pdf.Document(f) for f in files) if d.read()]
    assert tables[0] is tables[1] is tables[2] and len(tables[0].known) < 100


@pytest.mark.parametrize("shown", [b"(a b) Tj", b"<0041> Tj", b"<00410042> Tj 0 Tw", b"[<0041> 100 <0042>] TJ"])
def test_strings_and_operators_give_the_same_words(monkeypatch, shown):
    """The short way for strings at places is taken for those only, and gives what following the operators gives."""
    raw = pdf.make_pdf([Page(600.0, 800.0, [Word("Hello", 40.0, 70.0, 60.0, 70.0), Word("세계의🧪", 100.0, 155.0, 60.0, 70.0)])])
    streams = [pdf.Document(raw).stream(b) for b in pdf.Document(raw).objects.values() if b"stream" in b]
    stream = next(x for x in streams if x.startswith(b"BT")) + b"\nBT /F1 10 Tf 90 Tz 1 0 0 1 7 9 Tm " + shown + b" ET"
    fonts = {b"F1": pdf._Font(pdf._Table(b"beginbfrange <0000> <FFFF> <0000> endbfrange"), 2, {}, 500.0)}
    pages = []
    for whole in (False, True):
        if whole:
            monkeypatch.setattr(pdf, "_show_strings", lambda *a: None)
        pdf._show(stream, fonts, page := Page(600.0, 800.0), 0.0, 800.0)
        pages.append(page)
    assert pages[0] == pages[1] and [w.text for w in page.words[:2]] == ["Hello", "세계의🧪"]


def test_pages_at_hand_have_the_gaps_and_starts_of_the_frames(spark):
    import random

    from quirefold.operators import layout

    rng, rows, pages = random.Random(4), [], []
    for doc in range(80):
        split, pitch, words = rng.choice((250.0, 300.0, 340.0)), rng.choice((4.5, 14.0, 31.5)), []
        for k in range(rng.randint(1, 200)):
            x0 = rng.choice((rng.uniform(0, split - 60), rng.uniform(split, 600)))
            words.append(Word("w", x0, x0 + rng.uniform(0, 50), rng.randint(0, 20) * pitch, 0.0))
        pages.append(words)
        rows += [(doc, 0, k, w.text, w.x0, w.x1, w.top, w.bottom) for k, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, page_num int, word_no int, text string, x0 double, x1 double, top double, bottom double")
    gaps = layout.column_gap(df, 612.0)
    starts = {r.doc_id: r.body_y for r in layout.body_start(layout.two_sided(df, gaps), 300.0).collect()}
    want = {r.doc_id: (r.gap_x, starts.get(r.doc_id)) for r in gaps.collect()}
    got = layout.page_columns([*pages, []], 612.0, 300.0)
    assert [want.get(k, (None, None)) for k in range(80)] + [(None, None)] == got and len(starts) > 5


def test_files_are_read_once_and_boxes_stay(spark, tmp_path):
    """Pages with and without words, assets, documents or numbers, each once; no shuffle but those of texts, assets and contents."""
    from helpers import write_tables

    from quirefold.plans import documents

    text = " ".join(f"w{k}" for k in range(900))
    asset = {"asset_type": "TABLE", "bbox_x0": 40.0, "bbox_x1": 300.0, "bbox_y0": 300.0, "bbox_y1": 350.0}
    held = [asset | {"id": k, "document_id": doc, "page_num": page, "ref_tag": f"[TABLE_00{k}]"} for k, (doc, page) in enumerate([(1, 0), (1, 1), (5, 0), (None, 0), (None, None), (1, 7)])]
    d = write_tables(spark, tmp_path, documents=[{"doc_id": 1, "text": text}, {"doc_id": 2, "text": "one two"}, {"doc_id": 2, "text": "three"}, {"doc_id": None, "text": "lost words"}, {"doc_id": 3, "text": " "}, {"doc_id": 4}], document_assets=held)
    rows = {(r.doc_id, r.page_num): (r.text, r.n_assets) for r in documents.QUERIES["process_digital"](spark, d).collect()}
    assert {k: n for k, (_, n) in rows.items()} == {(1, 0): 1, (1, 1): 1, (1, 2): 0, (1, 7): 1, (2, 0): 0, (5, 0): 1, (None, 0): 0, (None, None): 0}
    assert rows[5, 0][0] == "[TABLE_002]" and rows[None, None][0] == "[TABLE_004]" and "three" in rows[2, 0][0] and "lost words" in rows[None, 0][0] and "[TABLE_003]" in rows[None, 0][0] and "[TABLE_000]" in rows[1, 0][0]
    pages = documents.QUERIES["digital_page_driver"](spark, d)
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Scan ExistingRDD" not in plan
    assert {(r.doc_id, r.page_num) for r in pages.collect()} == {(1, 0), (1, 1), (1, 2), (2, 0), (None, 0)}
