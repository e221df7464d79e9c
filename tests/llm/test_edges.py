"""Every query over empty tables, rows of nulls, repeated rows, very long texts and columns with clashing names."""

import pytest
from helpers import null_rows, write_tables
from quirefold.llm.queries import QUERIES

LONG = ("The sensor near Kivolis was installed in 1999 and slightly confirms the gauge. " * 4000).strip()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    assert QUERIES[name](spark, write_tables(spark, tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_null_rows(spark, tmp_path, name):
    rows = QUERIES[name](spark, write_tables(spark, tmp_path, clash=True, **null_rows())).collect()
    if name == "p8_ids":
        assert [(r.doc_id, r.ids) for r in rows] == [(None, [])]
    elif name == "p8_decoded":
        assert [(r.doc_id, r.text) for r in rows] == [(None, "")]
    elif name == "p7_cleaned":
        assert len(rows) == 1 and rows[0].body_text is None
    else:
        assert rows == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_long_empty_and_repeated_rows(spark, tmp_path, name):
    docs = [{"doc_id": k, "text": t, "lang": "en", "source": "s", "file_name": "a_b_c.pdf", "detected_languages": "eng"} for k, t in enumerate(["", "  ", "x", LONG, LONG + " naïve"])]
    pages = [{"id": k, "document_id": k, "page_num": 0, "header_text": h, "footer_text": "", "body_text": b} for k, (h, b) in enumerate([("", ""), (None, "\n\n"), ("h", LONG.replace(". ", ".\n")), ("x" * 200_000, LONG)])]
    assets = [{"id": k, "document_id": k, "ocr_text": t} for k, t in enumerate(["", None, LONG])]
    meta = [{"id": 1, "document_id": 3, "title": "", "authors": ";".join(f"Ada B{'o' * (k % 7)}n{k}" for k in range(300)), "affiliations": '""'}]
    items = [{"item_id": 1, "passage": " ".join(LONG.split()[:40])}, {"item_id": 2, "passage": ""}]
    folder = write_tables(spark, tmp_path, clash=True, documents=docs * 2, page_contents=pages * 2, document_assets=assets * 2, document_metadata=meta * 2, eval_items=items * 2)
    rows = QUERIES[name](spark, folder).collect()
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
    if name == "p9_found":
        assert sorted(tuple(r) for r in rows) == [(3, 1), (4, 1)]
    if name == "p8_ids":
        assert len(rows) == 10 and [r.ids for r in rows if r.doc_id == 0] == [[], []]
